"""Existing users: retention, churn, type, certification and resurrection.

The monthly fact has a few rows per user and month.  Everything here is keyed
on the user, and a user has at most one row per calendar month (or day) by the
time a window or join sees it, so no user can overload a task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel


def _user_months(users_month: DataFrame, users: DataFrame, internal: str) -> DataFrame:
    """Months of known users, one row for what is told apart, with the signup."""
    counted = (F.col("ActiveMonth") == "Active") & text.lacks(F.col("CompanyId"), internal)
    signup = users.select(
        F.col("OpenId").alias("UserId"), F.col("OldSignupDate").alias("SignupDate")
    )
    # The join comes first: its partitioning on the user serves the grouping, the
    # window and the join with days, and a monthly fact hardly shrinks map-side.
    return (
        users_month.where(text.not_blank(F.col("UserId")))
        .join(signup, "UserId", "left")
        .groupBy(
            "UserId", "SignupDate", "MonthYear", "FirstActiveDateInMonth",
            "LastActiveDateInMonth", "ActiveDaysInMonth",
            F.coalesce(counted, F.lit(False)).alias("_counted"),
        )
        .agg(F.max(rel.flag(F.col("UserTypeMonth") == "Developer")).alias("IsDeveloper"))
    )


def _since_signup() -> Column:
    return F.when(
        F.col("LastActiveDateInMonth") >= F.col("SignupDate"), F.col("LastActiveDateInMonth")
    )


def _with_second_month(
    months: DataFrame, events: DataFrame, types: Iterable[str]
) -> DataFrame:
    """Counted months, which know ``LastActiveDateBeforeMonth``, with later activity."""
    spans = (
        months.where("_counted")
        .select(
            "UserId", "MonthYear",
            F.date_add("LastActiveDateInMonth", 30).alias("LowerBoundary"),
            F.date_add("LastActiveDateInMonth", 60).alias("UpperBoundary"),
            "SignupDate", "LastActiveDateInMonth", "ActiveDaysInMonth", "IsDeveloper",
            "LastActiveDateBeforeMonth",
        )
        .distinct()
    )
    active = rel.active_months(events, types).withColumnRenamed("OpenId", "DayUser")
    # A span touches two or three months and meets the bitmaps of those only.
    touched = spans.withColumn("SpanMonth", F.explode_outer(F.expr(
        "sequence(trunc(LowerBoundary, 'MM'), trunc(UpperBoundary, 'MM'), interval 1 month)"
    )))
    same = (F.col("UserId") == F.col("DayUser")) & (F.col("SpanMonth") == F.col("ActiveMonth"))
    later = rel.days_in_span(
        F.col("Days"), F.col("SpanMonth"), F.col("LowerBoundary"), F.col("UpperBoundary")
    )
    return (
        touched.join(active, same, "left")
        .groupBy(*spans.columns)
        .agg(later.alias("DaysActiveInSecondMonth"))
        .select(
            "UserId", "MonthYear", "LowerBoundary", "UpperBoundary", "SignupDate",
            "LastActiveDateInMonth", "ActiveDaysInMonth",
            rel.flag(
                dates.day_diff(F.col("SignupDate"), F.col("LastActiveDateInMonth")) > 30
            ).alias("ExistingUser"),
            "IsDeveloper", "DaysActiveInSecondMonth", "LastActiveDateBeforeMonth",
        )
    )


def monthly_existing_users(
    users_month: DataFrame,
    users: DataFrame,
    events: DataFrame,
    *,
    types: Iterable[str],
    internal: str,
) -> DataFrame:
    """Active external user-months with next-month activity.

    ``ExistingUser`` is 1 when the last active day lies more than 30 days after
    signup; ``DaysActiveInSecondMonth`` counts distinct active days from 30 to
    60 days after it.  ``LastActiveDateBeforeMonth`` is the latest active day
    on or after signup in any earlier month - of all months of the user, also
    inactive ones - found by a running maximum instead of a self-join.
    """
    earlier = (
        Window.partitionBy("UserId", "SignupDate")
        .orderBy(dates.month_index(F.col("MonthYear")))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    months = _user_months(users_month, users, internal).withColumn(
        "LastActiveDateBeforeMonth", F.max(_since_signup()).over(earlier)
    )
    return _with_second_month(months, events, types)


# What has to be known of a user's earlier months: a row per user and signup.
STATE = (
    "UserId string, SignupDate timestamp_ntz, LastActiveDate date, FirstExistingMonth date"
)


def existing_users_of_month(
    state: DataFrame,
    users_month: DataFrame,
    users: DataFrame,
    events: DataFrame,
    *,
    month: dt.date,
    types: Iterable[str],
    internal: str,
) -> DataFrame:
    """The rows of :func:`monthly_existing_users` for one month, from the state before it.

    Reads one month of the monthly fact and the log of the two months in which its
    windows lie, however long the history is.  The last active day of an active month
    must lie in that month.  Windows end 60 days after it: months whose windows are
    still open are computed again later, from the same state.
    """
    following = (month.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    start = dt.datetime(month.year, month.month, 1) + dt.timedelta(days=30)
    end = dt.datetime(following.year, following.month, 1) + dt.timedelta(days=60)
    before = state.select(
        "UserId", "SignupDate", F.col("LastActiveDate").alias("LastActiveDateBeforeMonth")
    )
    months = _user_months(
        users_month.where(F.col("MonthYear") == F.lit(month)), users, internal
    ).join(before, ["UserId", "SignupDate"], "left")
    near = events.where(
        (F.col("Timestamp") >= F.lit(start)) & (F.col("Timestamp") < F.lit(end))
    )
    return _with_second_month(months, near, types)


def state_after_month(
    state: DataFrame,
    existing: DataFrame,
    users_month: DataFrame,
    users: DataFrame,
    *,
    month: dt.date,
    internal: str,
) -> DataFrame:
    """The state with one more month; months are merged in order.

    ``existing`` are the rows of :func:`existing_users_of_month` of that month.
    """
    months = _user_months(
        users_month.where(F.col("MonthYear") == F.lit(month)), users, internal
    )
    nothing = F.lit(None).cast("date")
    seen = months.select(
        "UserId", "SignupDate", _since_signup().alias("LastActiveDate"),
        nothing.alias("FirstExistingMonth"),
    )
    first = existing.where("ExistingUser = 1").select(
        "UserId", "SignupDate", nothing.alias("LastActiveDate"),
        F.col("MonthYear").alias("FirstExistingMonth"),
    )
    return (
        state.unionByName(seen).unionByName(first)
        .groupBy("UserId", "SignupDate")
        .agg(
            F.max("LastActiveDate").alias("LastActiveDate"),
            F.min("FirstExistingMonth").alias("FirstExistingMonth"),
        )
    )


def existing_user_churn_flags(
    monthly: DataFrame, *, as_of: dt.date | dt.datetime
) -> DataFrame:
    """Existing users of the finished months with churn and retention flags.

    The two retention flags stay 0 until the month is more than two months
    before the reporting month.
    """
    gap = dates.month_diff(F.col("LastActiveDateBeforeMonth"), F.col("MonthYear"))
    mature = dates.month_diff(F.col("MonthYear"), dates.as_day(as_of)) > 2
    days = F.col("DaysActiveInSecondMonth")
    return (
        monthly.where(
            (F.col("ExistingUser") == 1) & dates.month_finished(F.col("MonthYear"), as_of)
        )
        .select(
            "UserId", "MonthYear", "LastActiveDateInMonth", "ActiveDaysInMonth",
            "LastActiveDateBeforeMonth",
            rel.flag(gap > 1).alias("IsChurner"),
            "ExistingUser", "IsDeveloper", "DaysActiveInSecondMonth",
            rel.flag(mature & (days > 0)).alias("ExistingUsersActiveInSecondMonth"),
            rel.flag(mature & (days == 0)).alias("ExistingUsersNotActiveInSecondMonth"),
        )
        .distinct()
    )


def existing_user_types(existing: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """New, resurrected or plain existing user, per user-month.

    With the ``state`` before it, ``existing`` holds a single month.
    """
    first_month = F.min("MonthYear").over(Window.partitionBy("UserId"))
    if state is not None:
        known = state.groupBy("UserId").agg(F.min("FirstExistingMonth").alias("_first"))
        existing = existing.join(known, "UserId", "left")
        first_month = F.coalesce("_first", "MonthYear")
    return existing.select(
        "UserId", "MonthYear", "LastActiveDateInMonth", "ActiveDaysInMonth",
        "LastActiveDateBeforeMonth", "IsDeveloper", "ExistingUsersActiveInSecondMonth",
        "DaysActiveInSecondMonth",
        F.when(F.col("MonthYear") == first_month, "New Existing User")
        .when(F.col("IsChurner") == 1, "Resurrected Existing User")
        .otherwise("Existing User")
        .alias("ExistingUserType"),
    )


# Certificate date column -> label, highest first.
CERTIFICATES = {
    "ExpertCertifiedDate": "ExpertCertified",
    "AdvancedCertifiedDate": "AdvancedCertified",
    "RapidCertifiedDate": "RapidCertified",
}


def _certification(condition: Callable[[Column], Column]) -> Column:
    label = F.lit("NotCertified")
    for column, name in reversed(CERTIFICATES.items()):
        label = F.when(condition(F.col(column)), name).otherwise(label)
    return label.alias("Certification")


def _certificates(users: DataFrame) -> DataFrame:
    return users.select(F.col("OpenId").alias("UserId"), *CERTIFICATES)


def existing_users_certified(existing: DataFrame, users: DataFrame) -> DataFrame:
    """User types with the highest certificate earned before the month."""
    typed = existing_user_types(existing)
    return typed.join(_certificates(users), "UserId", "left").select(
        *typed.columns, _certification(lambda earned: earned < F.col("MonthYear"))
    )


def existing_users_by_year(existing: DataFrame, users: DataFrame) -> DataFrame:
    """Per user and year: developer flag and highest certificate of that year."""
    yearly = existing.groupBy("UserId", F.year("MonthYear").alias("Year")).agg(
        F.max("IsDeveloper").alias("IsDeveloper")
    )
    return yearly.join(_certificates(users), "UserId", "left").select(
        "UserId", "IsDeveloper", "Year",
        _certification(lambda earned: F.year(earned) == F.col("Year")),
    )


def resurrection(
    users_month: DataFrame,
    users: DataFrame,
    *,
    as_of: dt.date | dt.datetime,
    internal: str,
) -> DataFrame:
    """Churned existing users per finished month, and whether they came back.

    The report covers every known month of every external user.  Only months
    at least two after the last activity can be churned, so each gap between
    two user-months is unfolded from the later of those bounds up to the next
    user-month (or the last finished month); users are never crossed with the
    calendar.  A current churner was last active 2-12 months ago, an older one
    earlier.  ``MonthYear`` must be the first of the month.
    """
    known = users_month.where(
        text.not_blank(F.col("UserId")) & F.col("MonthYear").isNotNull()
    )
    signup = users.where(F.col("OldSignupDate").isNotNull()).select(
        F.col("OpenId").alias("UserId"), F.col("OldSignupDate").alias("SignupDate")
    )
    per_month = known.join(signup, "UserId").groupBy("UserId", "SignupDate", "MonthYear").agg(
        F.max("LastActiveDateInMonth").alias("Last"),
        F.max(rel.flag(F.col("ActiveMonth") == "Active")).alias("Active"),
        F.max(rel.flag(text.lacks(F.col("CompanyId"), internal))).alias("External"),
    )
    user = Window.partitionBy("UserId", "SignupDate")
    ordered = user.orderBy("MonthYear")
    since_signup = F.when(F.col("Last") >= F.col("SignupDate"), F.col("Last"))
    last_finished = F.add_months(dates.month_start(dates.as_day(as_of)), -1)
    gaps = (
        per_month.select(
            "UserId", "SignupDate", "MonthYear",
            F.max(since_signup)
            .over(ordered.rowsBetween(Window.unboundedPreceding, 0))
            .alias("LastActiveDate"),
            F.lead("MonthYear").over(ordered).alias("NextMonth"),
            F.lead("Active").over(ordered).alias("NextActive"),
            F.max("External").over(user).alias("External"),
        )
        .where(
            (F.col("External") == 1)
            & (dates.day_diff(F.col("SignupDate"), F.col("LastActiveDate")) > 30)
        )
        .withColumn(
            "First",
            F.greatest(
                F.add_months("MonthYear", 1),
                F.add_months(dates.month_start(F.col("LastActiveDate")), 2),
            ),
        )
        .withColumn("Final", F.least(F.coalesce("NextMonth", last_finished), last_finished))
        .where(F.col("First") <= F.col("Final"))
    )
    gap = dates.month_diff(F.col("LastActiveDate"), F.col("Month"))
    active = rel.flag((F.col("Month") == F.col("NextMonth")) & (F.col("NextActive") == 1))
    current = rel.flag(gap <= 12)
    older = rel.flag(gap > 12)
    churned = (
        gaps.select(
            "*", F.explode(F.expr("sequence(First, Final, interval 1 month)")).alias("Month")
        )
        .select(
            F.col("Month").alias("MonthYear"), "UserId", "SignupDate",
            current.alias("IsCurrentChurner"),
            older.alias("IsNonCurrentChurner"),
            F.lit(1).alias("IsExistingUser"),
            active.alias("Resurrected"),
            current.alias("ExistingChurners"),
            (current * active).alias("CurrentChurnersResurrected"),
            (older * active).alias("NonCurrentChurnersResurrected"),
        )
    )
    # The known months are few, and each has very many users.
    return rel.semi_join_spread(churned, users_month, "MonthYear", "UserId").drop("SignupDate")
