"""Challenges: progress, surrounding activity, profiles and claimed credits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy

# Output names that users of the tables rely on (the first one as spelled there).
BEFORE = "LearnActivityBerforeChallenge"
PROFILE_NAMES = {"Share": "KnowledgeShare"}


_KEYS = ["OpenId", "ChallengeId"]
_LAST = {"last": "max"}


def _matched(events: DataFrame) -> DataFrame:
    """Assignments and ends of challenges from one scan of the log; an end has in
    ``last`` the assignment with the largest id among those strictly earlier."""
    status = F.when(F.col("EventType") == taxonomy.CHALLENGE_EXPIRED, "Expired").when(
        F.col("EventType") == taxonomy.CHALLENGE_COMPLETED, "Completed")
    at = F.col("Timestamp")
    rows = rel.event_scan(
        events,
        [taxonomy.CHALLENGE_ASSIGNED, taxonomy.CHALLENGE_EXPIRED, taxonomy.CHALLENGE_COMPLETED],
    ).select(
        "OpenId", F.col("ExtraInfo1").alias("ChallengeId"), at.alias("at"),
        F.when(
            status.isNotNull(), F.struct(F.lit(False).alias("closed"), status.alias("Status"))
        ).alias("_row"),
        F.when(status.isNull(), F.struct(F.col("ChangedId").alias("id"), at.alias("time"))).alias("last"),
    )
    dealt = rel.slot_rows(rows, _KEYS, _LAST)
    return rel.slot_totals(dealt, _KEYS, _LAST, events=True).select(
        *[F.col(f"_slot.{k}").alias(k) for k in _KEYS], "at", "_row", "_own_last", "last")


def _ends(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("_row").isNotNull()).select(
        *_KEYS, F.col("_row.Status").alias("Status"),
        F.col("last.time").alias("TimeChallengeAssigned"), F.col("at").alias("DateTimeEnded"),
        F.col("last.id").alias("LastChallengeEventChangedId"),
    )


def challenge_ends(events: DataFrame) -> DataFrame:
    """Expired and completed challenges with the assignment they belong to:
    the one with the largest event id among those strictly earlier in time."""
    return _ends(_matched(events)).distinct()


def challenge_progress(events: DataFrame) -> DataFrame:
    """Ended challenges plus assignments that no end refers to.

    Event ids must be unique.  The log is scanned once: assignments that ends
    refer to are found from the same dealt rows as the ends.
    """
    matched = _matched(events)
    used = _ends(matched).select(
        F.col("LastChallengeEventChangedId").cast("string").alias("_used")
    ).where(F.col("_used").isNotNull()).distinct()
    ended = F.col("_row").isNotNull()
    rows = matched.withColumn("_assignment", F.col("_own_last.id").cast("string"))
    return (
        rel.left_join_sparse_key(rows, used, "_assignment", "_used", [*_KEYS, "at"])
        .where(ended | F.col("_used").isNull())
        .select(
            *_KEYS, F.coalesce("_row.Status", F.lit("Currently Active")).alias("Status"),
            F.when(ended, F.col("last.time")).otherwise(F.col("at")).alias("TimeChallengeAssigned"),
            F.when(ended, F.col("at")).alias("DateTimeEnded"),
            F.when(ended, F.col("last.id")).alias("LastChallengeEventChangedId"),
        )
        .distinct()
    )


def challenge_progress_output(
    progress: DataFrame, users: DataFrame, *, internal: str
) -> DataFrame:
    """Challenge progress of external users with days and hours taken."""
    start, end = F.col("TimeChallengeAssigned"), F.col("DateTimeEnded")
    return rel.keep_external(progress, users, internal).select(
        *progress.columns,
        F.to_date(start).alias("DateChallengeAssigned"),
        F.to_date(end).alias("DateEnded"),
        dates.hour_diff(start, end).alias("TimeDiff"),
    )


def _category_counts(categories: Mapping[str, Iterable[str]], suffix: str) -> list[Column]:
    return [
        rel.count_if(rel.one_of("EventType", types)).alias(f"{name}{suffix}")
        for name, types in categories.items()
    ]


def _all_types(categories: Mapping[str, Iterable[str]]) -> list[str]:
    return sorted({t for types in categories.values() for t in types})


def challenge_activity(
    progress: DataFrame,
    events: DataFrame,
    *,
    categories: Mapping[str, Iterable[str]],
    between: tuple[dt.datetime, dt.datetime],
    days: int = 30,
) -> DataFrame:
    """Events per category in the closed ``days`` after each assignment.

    ``progress`` is the output of :func:`challenge_progress_output`.  All
    categories are counted together from running totals per user, so an active
    user with many challenges costs their sum and not their product.
    """
    names = [f"{c}Activity" for c in categories]
    per_instant = (
        rel.event_scan(events, _all_types(categories), between=between)
        .groupBy("OpenId", F.col("Timestamp").alias("at"))
        .agg(*_category_counts(categories, "Activity"))
    )
    start = F.col("TimeChallengeAssigned")
    span = rel.Span(start, dates.plus_days(start, days))
    return rel.sum_in_spans(progress, per_instant, ["OpenId"], names, {"": span}).select(
        "OpenId", "ChallengeId", "Status", "TimeChallengeAssigned", "DateTimeEnded",
        "LastChallengeEventChangedId",
        F.col("DateChallengeAssigned").alias("DateAssigned"),
        "DateEnded", "TimeDiff", *names,
    )


def challenge_user_profile(
    events: DataFrame,
    users: DataFrame,
    company: DataFrame,
    gamification: DataFrame,
    *,
    categories: Mapping[str, Iterable[str]],
    as_of: dt.datetime,
    after: dt.datetime,
) -> DataFrame:
    """Distinct challenges per kind, recent activity and profile, per user."""
    named = {PROFILE_NAMES.get(c, c): types for c, types in categories.items()}
    challenges = (
        rel.event_scan(events, taxonomy.CHALLENGE_EVENTS, after=after)
        .select("OpenId", "EventType", "ExtraInfo1")
        .distinct()
        .groupBy("OpenId")
        .agg(
            *[
                rel.count_if(F.col("EventType") == type_).alias(name)
                for name, type_ in (
                    ("CountChallengeAssigned", taxonomy.CHALLENGE_ASSIGNED),
                    ("CountChallengeCompleted", taxonomy.CHALLENGE_COMPLETED),
                    ("CountChallengeExpired", taxonomy.CHALLENGE_EXPIRED),
                    ("CountChallengeCreditsClaimed", taxonomy.CHALLENGE_CLAIMED),
                )
            ]
        )
        .withColumn(
            "CountCurrentlyActive",
            F.col("CountChallengeAssigned")
            - F.col("CountChallengeCompleted")
            - F.col("CountChallengeExpired"),
        )
    )
    recent = (
        rel.event_scan(events, _all_types(categories), after=as_of - dt.timedelta(days=30))
        .groupBy("OpenId")
        .agg(*_category_counts(named, "ActivityLast30Days"))
    )
    companies = company.select("CompanyId", "DisplayName", "CompanyType")
    points = gamification.select(
        "OpenId", "HighestCert", F.col("Level").alias("MxLevel"),
        F.col("Total_points").alias("GamificationPoints_Total"),
    )
    profile = (
        users.select("OpenId", "CompanyId", "SignupDate", "Country")
        .join(companies, "CompanyId", "left")
        .drop("CompanyId")
        .join(points, "OpenId", "left")
    )
    names = [f"{c}ActivityLast30Days" for c in named]
    return (
        challenges.join(profile, "OpenId", "left")
        .join(recent, "OpenId", "left")
        .select(
            *challenges.columns, "SignupDate", "Country", "DisplayName", "CompanyType",
            *[F.coalesce(n, F.lit(0)).alias(n) for n in names],
            "HighestCert", "MxLevel", "GamificationPoints_Total",
        )
    )


def credits_claimed(events: DataFrame, users: DataFrame, *, internal: str) -> DataFrame:
    """Completions (distinct in time) and claims per external user and challenge."""
    keys = ["OpenId", F.col("ExtraInfo1").alias("ChallengeId")]
    completed = (
        rel.event_scan(events, [taxonomy.CHALLENGE_COMPLETED])
        .select(*keys, "Timestamp")
        .distinct()
        .groupBy("OpenId", "ChallengeId")
        .agg(F.count("ChallengeId").alias("CountCompletedChallenge"))
    )
    claimed = (
        rel.event_scan(events, [taxonomy.CHALLENGE_CLAIMED])
        .groupBy(*keys)
        .agg(F.count("ExtraInfo1").alias("CountCreditsClaimed"))
    )
    external = rel.external_users(users, internal)
    return (
        completed.join(claimed, ["OpenId", "ChallengeId"], "left")
        .join(external, "OpenId", "inner")
        .select(
            "OpenId", "ChallengeId", "CountCompletedChallenge",
            F.coalesce("CountCreditsClaimed", F.lit(0)).alias("CountCreditsClaimed"),
        )
    )


def credits_claimed_raw(events: DataFrame) -> DataFrame:
    """Every claim event."""
    return rel.event_scan(events, [taxonomy.CHALLENGE_CLAIMED]).select(
        "OpenId", F.col("ExtraInfo1").alias("ChallengeId"), "Timestamp"
    )


def before_after_activity(
    events: DataFrame,
    users: DataFrame,
    *,
    challenge_prefix: str,
    internal: str,
    as_of: dt.date | dt.datetime,
    learn_types: Iterable[str] = taxonomy.LECTURES,
    after: dt.datetime,
    days: int = 30,
) -> DataFrame:
    """Learning events in the ``days`` before and after a challenge assignment.

    Counts events on days strictly inside +-``days`` of the assignment day,
    split at the assignment instant; an event at that very instant is in
    neither.  Only users who signed up more than ``days`` before, and
    assignments older than ``days``, take part.
    """
    zone_free = "timestamp_ntz"
    challenge = rel.event_scan(events, taxonomy.CHALLENGE_EVENTS, after=after)
    assigned = (
        challenge.where(
            (F.col("EventType") == taxonomy.CHALLENGE_ASSIGNED)
            & F.lower("ExtraInfo1").startswith(challenge_prefix.lower())
        )
        .select(
            "OpenId", F.col("ExtraInfo1").alias("ChallengeID"), "Timestamp",
            F.to_date("Timestamp").alias("DateAssigned"),
        )
        .distinct()
    )
    people = users.where(text.lacks(F.col("CompanyId"), internal)).select(
        "OpenId", "CompanyId", "SignupDate"
    )
    today = dates.as_instant(as_of)
    base = assigned.join(people, "OpenId", "inner").where(
        (dates.plus_days(F.col("SignupDate"), days) < F.col("DateAssigned"))
        & (F.col("DateAssigned") < dates.plus_days(today, -days))
    )
    per_instant = (
        rel.event_scan(events, learn_types)
        .groupBy("OpenId", F.col("Timestamp").alias("at"))
        .agg(F.count(F.lit(1)).alias("LearnActivity"))
    )
    moment = F.col("Timestamp")
    first_day = F.date_add("DateAssigned", 1 - days).cast(zone_free)
    last_day = F.date_add("DateAssigned", days).cast(zone_free)
    learned = rel.sum_in_spans(
        base, per_instant, ["OpenId"], ["LearnActivity"],
        {
            "Before": rel.Span(first_day, moment, True, False),
            "After": rel.Span(moment, last_day, False, False),
        },
    )
    claims = (
        challenge.where(F.col("EventType") == taxonomy.CHALLENGE_CLAIMED)
        .groupBy("OpenId", F.col("ExtraInfo1").alias("ChallengeID"))
        .agg(F.count("OpenId").alias("CountCreditsClaimed"))
    )
    before, after = F.col("BeforeLearnActivity"), F.col("AfterLearnActivity")
    return learned.join(claims, ["OpenId", "ChallengeID"], "left").select(
        "OpenId", "ChallengeID", "Timestamp", "DateAssigned", "CompanyId", "SignupDate",
        F.coalesce("CountCreditsClaimed", F.lit(0)).alias("CountCreditsClaimed"),
        before.alias(BEFORE),
        after.alias("LearnActivityAfterChallenge"),
        (after - before).alias("DiffLearnActivity"),
    )
