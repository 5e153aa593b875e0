"""Activity of new users in the weeks after signup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy

# Column suffix -> first and last day after signup.  The third span is named
# "1To15" but ends on day 14; the name is kept for compatibility.
SPANS = {
    "ActiveFirstDay{0}": (0, 0),
    "ActiveDays1To8DaysAfterSignup{0}": (1, 8),
    "ActiveDays1To15DaysAfterSignup{0}": (1, 14),
    "ActiveDays1To30DaysAfterSignup{0}": (1, 30),
}
TOTAL_SPANS = {
    "ActiveDays1To30DaysAfterSignup": (1, 30),
    "ActiveDays30To60DaysAfterSignup": (30, 60),
}
LAST_DAY = max(high for _, high in [*SPANS.values(), *TOTAL_SPANS.values()])

_USER_COLUMNS = [
    "UserId", "CompanyId", "DisplayName", "CompanyType", "Country", "Source",
    "MonthYear", "SignupDate", "FirstActivationDate", "Activated",
]


def onboarding_users(
    users: DataFrame,
    events: DataFrame,
    company: DataFrame,
    *,
    internal: str,
    activation_types: Iterable[str] = taxonomy.ACTIVATION,
    invite_reasons: Iterable[str] = taxonomy.INVITE_REASONS,
    days: int = 30,
) -> DataFrame:
    """External users with signup source, company and early activation."""
    base = users.where(
        text.not_blank(F.col("OpenId")) & text.lacks(F.col("CompanyId"), internal)
    ).select(
        "OpenId", "CompanyId", "Country",
        F.to_date("OldSignupDate").alias("SignupDate"),
        dates.month_start(F.col("OldSignupDate")).alias("MonthYear"),
    )
    reasons = (
        rel.event_scan(events, [taxonomy.SIGNUP_COMPLETED])
        .where(text.not_blank(F.col("OpenId")))
        .groupBy("OpenId")
        .agg(F.max("ExtraInfo1").alias("SignupReason"))
    )
    first = rel.first_event(events, activation_types, "FirstActivationDate")
    elapsed = dates.day_diff(F.col("SignupDate"), F.col("FirstActivationDate"))
    return (
        rel.with_company_type(base, company, ["DisplayName"])
        .join(reasons, "OpenId", "left")
        .join(first, "OpenId", "left")
        .withColumn(
            "Source",
            F.when(F.col("SignupReason").isin(*invite_reasons), "Invites").otherwise(
                "Marketing Inbound"
            ),
        )
        .withColumn("Activated", rel.flag(elapsed <= days))
        .withColumnRenamed("OpenId", "UserId")
        .select(*_USER_COLUMNS)
    )


def onboarding(
    users: DataFrame,
    events: DataFrame,
    *,
    categories: Mapping[str, Iterable[str]] = taxonomy.ONBOARDING,
    activity: Iterable[str],
) -> DataFrame:
    """Active days per category and span, and retention in the second month.

    ``users`` is the output of :func:`onboarding_users`; repeated rows of it collapse.  The
    log shrinks to one row per user and month with a bitmap of days per category.  A user
    row meets the at most four months of its spans, and one aggregate yields all counts.
    """
    months = rel.category_months(events, {**categories, "Any": tuple(activity)}).withColumnRenamed(
        "OpenId", "DayUser"
    )
    signup, last = F.to_date("SignupDate"), F.date_add(F.to_date("SignupDate"), LAST_DAY)
    near = (F.col("UserId") == F.col("DayUser")) & F.col("ActiveMonth").between(
        dates.month_start(signup), last
    )
    # bit i of a category: active on day i after signup
    since_signup = [
        F.bit_or(rel.span_bits(F.col(name), F.col("ActiveMonth"), signup, last)).alias(f"_{name}")
        for name in [*categories, "Any"]
    ]

    def days_in(category: str, span: tuple[int, int], name: str) -> Column:
        low, high = span
        wanted = F.lit((1 << high + 1) - (1 << low)).cast("bigint")
        days = F.bit_count(F.col(f"_{category}").bitwiseAND(wanted))
        return F.coalesce(days, F.lit(0)).cast("bigint").alias(name)

    counted = [
        (category, span, name.format(category))
        for category in categories
        for name, span in SPANS.items()
    ] + [("Any", span, name) for name, span in TOTAL_SPANS.items()]
    return (
        users.join(months, near, "left")
        .groupBy(*_USER_COLUMNS)
        .agg(*since_signup)
        .select(*_USER_COLUMNS, *[days_in(*c) for c in counted])
        .withColumn("Retained", rel.flag(F.col("ActiveDays30To60DaysAfterSignup") > 0))
    )
