"""Activation, second-month retention and invites per user."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy


def initiative_events(
    events: DataFrame,
    *,
    types: Iterable[str] = taxonomy.INITIATIVE_EVENTS,
    after: dt.date,
) -> DataFrame:
    """The reduced event log that the initiative tables are built on."""
    return rel.event_scan(events, types, after=after)


def growth_events(
    events: DataFrame, *, types: Iterable[str], after: dt.date
) -> DataFrame:
    """Events that count for the growth metrics."""
    return rel.event_scan(events, types, after=after)


def growth_users(users: DataFrame, *, internal: str) -> DataFrame:
    """External users with signup day and the retention window.

    The window runs from 30 to 60 days after signup and keeps the time of day,
    so the midnight of day 30 is inside only for a signup at midnight.
    """
    return users.where(
        text.lacks(F.col("CompanyId"), internal) & text.not_blank(F.col("OpenId"))
    ).select(
        F.col("OpenId").alias("UserId"),
        "CompanyId",
        "email",
        F.to_date("OldSignupDate").alias("SignupDate"),
        dates.plus_days(F.col("OldSignupDate"), 30).alias("LowerBoundary"),
        dates.plus_days(F.col("OldSignupDate"), 60).alias("UpperBoundary"),
    )


_USER_COLUMNS = ["UserId", "CompanyType", "SignupDate", "LowerBoundary", "UpperBoundary"]
_INVITE_COLUMNS = [
    "NumberInvitesToNonMembers", "NumberInvitesToNonMembersWithinFirst30Days",
]


def _base(users: DataFrame, company: DataFrame) -> DataFrame:
    return rel.with_company_type(users, company).select(*_USER_COLUMNS)


# The three steps below each join per-user facts to rows keyed on the user and
# group by the columns of those rows.  Grouping keys contain the join key, so a
# chain of steps shuffles the user rows once, and repeated user rows collapse.


def _add_activation(
    rows: DataFrame, events: DataFrame, types: Iterable[str], days: int
) -> DataFrame:
    first = rel.first_event(events, types, "FirstDateOfEvent").withColumnRenamed(
        "OpenId", "UserId"
    )
    elapsed = dates.day_diff(F.col("SignupDate"), F.col("FirstDateOfEvent"))
    return (
        rows.join(first, "UserId", "left")
        .withColumn("ActivatedWithin30days", rel.flag(elapsed <= days))
        .distinct()
    )


def _window_days(days: Column) -> Column:
    """Distinct active days in the retention window, from the bitmaps of its months."""
    return rel.days_in_span(
        days, F.col("ActiveMonth"), F.col("LowerBoundary"), F.col("UpperBoundary")
    ).alias("DaysActiveInSecondMonth")


def _add_active_days(rows: DataFrame, events: DataFrame, types: Iterable[str]) -> DataFrame:
    months = rel.active_months(events, types).withColumnRenamed("OpenId", "DayUser")
    touched = (F.col("UserId") == F.col("DayUser")) & F.col("ActiveMonth").between(
        dates.month_start(F.col("LowerBoundary")), F.col("UpperBoundary")
    )
    return (
        rows.join(months, touched, "left").groupBy(*rows.columns).agg(_window_days(F.col("Days")))
    )


def _add_daily_facts(
    rows: DataFrame,
    events: DataFrame,
    activation_types: Iterable[str],
    retention_types: Iterable[str],
    days: int,
) -> DataFrame:
    """Activation and retention from one pass over the log: per user and month the
    first activation and the active days."""
    activated, retained = list(activation_types), list(retention_types)
    monthly = (
        rel.event_scan(events, sorted({*activated, *retained}))
        .where(F.col("OpenId").isNotNull())
        .groupBy(
            F.col("OpenId").alias("DayUser"),
            dates.month_start(F.col("Timestamp")).alias("ActiveMonth"),
        )
        .agg(
            F.min(F.when(rel.one_of("EventType", activated), F.col("Timestamp"))).alias("First"),
            rel.day_bits(
                F.when(rel.one_of("EventType", retained), F.col("Timestamp"))
            ).alias("Days"),
        )
    )
    elapsed = dates.day_diff(F.col("SignupDate"), F.min("First"))
    return (
        rows.join(monthly, F.col("UserId") == F.col("DayUser"), "left")
        .groupBy(*rows.columns)
        .agg(
            rel.flag(elapsed <= days).alias("ActivatedWithin30days"),
            _window_days(F.col("Days")),
        )
    )


def _invites_per_day(
    users: DataFrame, events: DataFrame, types: Iterable[str], internal: str
) -> DataFrame:
    """Invites to non-members per sender and day.

    Whether the receiver was a member depends on days only, so invites are
    first combined per (sender, receiver, day) and receivers per (e-mail,
    signup day).  After the e-mail join they shrink again to (sender, day).
    """
    invites = (
        rel.event_scan(events, types)
        .where(text.lacks(F.col("CompanyId"), internal) & text.not_blank(F.col("OpenId")))
        .groupBy(
            F.col("OpenId").alias("Sender"),
            F.col("ExtraInfo1").alias("email"),
            F.to_date("Timestamp").alias("InviteDay"),
        )
        .agg(F.count(F.lit(1)).alias("Invites"))
    )
    receivers = (
        users.where(F.col("email").isNotNull())
        .groupBy(F.col("email").alias("member"), F.col("SignupDate").alias("SignupDateReceiver"))
        .agg(F.count(F.lit(1)).alias("Receivers"))
    )
    non_member = (F.col("InviteDay") < F.col("SignupDateReceiver")) | (
        F.col("SignupDateReceiver").isNull() & F.col("InviteDay").isNotNull()
    )
    return (
        rel.left_join_sparse_key(invites, receivers, "email", "member", ["Sender", "InviteDay"])
        .where(non_member)
        .groupBy("Sender", "InviteDay")
        .agg(F.sum(F.col("Invites") * F.coalesce("Receivers", F.lit(1))).alias("Invites"))
    )


def _add_invites(rows: DataFrame, per_day: DataFrame, days: int) -> DataFrame:
    early = dates.day_diff(F.col("SignupDate"), F.col("InviteDay")) <= days
    sent = F.coalesce("Invites", F.lit(0))
    return (
        rows.join(per_day, F.col("UserId") == F.col("Sender"), "left")
        .groupBy(*rows.columns)
        .agg(
            F.sum(sent).alias(_INVITE_COLUMNS[0]),
            F.sum(F.when(early, sent).otherwise(0)).alias(_INVITE_COLUMNS[1]),
        )
    )


def activation(
    users: DataFrame,
    events: DataFrame,
    company: DataFrame,
    *,
    types: Iterable[str] = taxonomy.ACTIVATION,
    days: int = 30,
) -> DataFrame:
    """First activation event per user and whether it came within ``days``.

    An event before signup counts as activated; no event counts as 0.
    ``users`` is the output of :func:`growth_users`.
    """
    return _add_activation(_base(users, company), events, types, days).select(
        *_USER_COLUMNS, "ActivatedWithin30days", "FirstDateOfEvent"
    )


def retention_second_month(
    users: DataFrame, events: DataFrame, company: DataFrame, *, types: Iterable[str]
) -> DataFrame:
    """Distinct active days inside each user's closed retention window."""
    return _add_active_days(_base(users, company), events, types).withColumn(
        "Retained", rel.flag(F.col("DaysActiveInSecondMonth") > 0)
    )


def invites_sent(
    users: DataFrame,
    events: DataFrame,
    company: DataFrame,
    *,
    internal: str,
    types: Iterable[str] = taxonomy.INVITES,
    days: int = 30,
) -> DataFrame:
    """Invites to non-members per sender, in total and soon after signup.

    The receiver is a non-member when signing up on a later day, or unknown.
    Several users with the receiver's e-mail each count.  Users without invites
    are kept with 0.
    """
    rows = _base(users, company).select("UserId", "SignupDate", "CompanyType")
    per_day = _invites_per_day(users, events, types, internal)
    return _add_invites(rows, per_day, days).select(
        F.col("UserId").alias("OpenIdSender"),
        F.col("SignupDate").alias("SignupDateSender"),
        "CompanyType", *_INVITE_COLUMNS,
    )


def key_growth_metrics(
    users: DataFrame,
    events: DataFrame,
    company: DataFrame,
    *,
    internal: str,
    activation_types: Iterable[str] = taxonomy.ACTIVATION,
    invite_types: Iterable[str] = taxonomy.INVITES,
    retention_types: Iterable[str],
    days: int = 30,
) -> DataFrame:
    """Activation, retention and invites side by side, one row per user.

    Activation and retention come from one scan of the log, invites from a
    second one that needs the receiver as well.
    """
    rows = _add_daily_facts(
        _base(users, company), events, activation_types, retention_types, days
    )
    per_day = _invites_per_day(users, events, invite_types, internal)
    return _add_invites(rows, per_day, days).select(
        *_USER_COLUMNS,
        "ActivatedWithin30days",
        rel.flag(F.col("DaysActiveInSecondMonth") > 0).alias("Retained"),
        *_INVITE_COLUMNS,
    )


def invite_conversion(
    users: DataFrame,
    events: DataFrame,
    *,
    internal: str,
    as_of: dt.date | dt.datetime,
    types: Iterable[str] = taxonomy.INVITES,
    days: int = 30,
) -> DataFrame:
    """Each invite of the finished months with two conversion flags.

    ``InviteToNonMember``: the receiver is unknown or signed up later.
    ``InviteToNonMemberLeadingToSignup``: later, and within ``days``.
    """
    invites = (
        rel.event_scan(events, types)
        .where(text.lacks(F.col("CompanyId"), internal) & text.not_blank(F.col("OpenId")))
        .select(
            F.col("OpenId").alias("OpenIdSender"),
            F.col("ExtraInfo1").alias("EmailAddressRetriever"),
            F.col("Timestamp").alias("InviteDate"),
            F.col("EventType").alias("InviteType"),
            dates.month_start(F.col("Timestamp")).alias("MonthYear"),
        )
        .where(dates.month_finished(F.col("MonthYear"), as_of))
    )
    receivers = users.select(
        F.col("email").alias("_receiver"), F.col("OldSignupDate").alias("SignupDate")
    )
    later = F.col("InviteDate") < F.col("SignupDate")
    soon = dates.day_diff(F.col("InviteDate"), F.col("SignupDate")) <= days
    joined = rel.left_join_sparse_key(
        invites, receivers, "EmailAddressRetriever", "_receiver", ["OpenIdSender", "InviteDate"]
    )
    return joined.select(
        "OpenIdSender",
        "EmailAddressRetriever",
        "MonthYear",
        "InviteType",
        rel.flag(later | F.col("SignupDate").isNull()).alias("InviteToNonMember"),
        rel.flag(later & soon).alias("InviteToNonMemberLeadingToSignup"),
    )
