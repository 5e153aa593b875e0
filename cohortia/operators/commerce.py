"""Starter-app deploys and shop carts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy

PROJECT_COLUMNS = [
    "S_UUID", "ProjectName", "CreatedDate", "CreatorCompanyPlatformName",
    "ProjectIsDeleted", "EnvironmentType", "AppType", "ProjectMemberCount",
    "FirstSandboxLogin", "LastSandboxLogin",
]


def starter_app_deploys(
    events: DataFrame,
    projects: DataFrame,
    *,
    internal: str,
    deploy_types: Iterable[str] = taxonomy.DEPLOYS,
) -> DataFrame:
    """Projects made from a template with their first and last deploy.

    Time differences count minute marks.  Projects of the own company, and
    those without project data, are left out.
    """
    created = (
        rel.event_scan(events, [taxonomy.TEMPLATE_CREATED])
        .select(
            F.col("ExtraInfo3").alias("ProjectID"), F.col("ExtraInfo2").alias("TemplateID"),
            F.col("OpenId").alias("OpenID"), F.col("Timestamp").alias("DateTimeProjectCreated"),
        )
        .distinct()
    )
    deploys = (
        rel.event_scan(events, deploy_types)
        .groupBy(F.col("ExtraInfo1").alias("ProjectID"))
        .agg(
            F.min("Timestamp").alias("FirstDeployDateTime"),
            F.max("Timestamp").alias("LastDeployDateTime"),
            F.count("Timestamp").alias("NumberOfDeploys"),
        )
    )
    known = projects.where(text.lacks(F.col("CreatorCompanyPlatformName"), internal)).select(
        F.col("S_UUID").alias("ProjectID"), *PROJECT_COLUMNS,
        dates.minute_diff(F.col("CreatedDate"), F.col("LastSandboxLogin")).alias(
            "TimeDiffLastActiveDate"
        ),
        "AppStatus",
    )
    born = F.col("DateTimeProjectCreated")
    first, last = F.col("FirstDeployDateTime"), F.col("LastDeployDateTime")
    # Project data and deploys meet first, one row per project each; the join
    # with the creation events comes last, where a busy project can be split.
    return (
        created.join(known.join(deploys, "ProjectID", "left"), "ProjectID", "inner")
        .select(
            "ProjectID", "TemplateID", "OpenID", "DateTimeProjectCreated",
            "FirstDeployDateTime", "LastDeployDateTime",
            F.to_date(first).alias("FirstDeployDate"),
            F.to_date(last).alias("LastDeployDate"),
            dates.minute_diff(born, first).alias("TimeDiffFirstDeploy"),
            dates.minute_diff(born, last).alias("TimeDiffLastDeploy"),
            "NumberOfDeploys", *PROJECT_COLUMNS, "TimeDiffLastActiveDate", "AppStatus",
        )
    )


def cart_checkouts_per_user(events: DataFrame, users: DataFrame, *, internal: str) -> DataFrame:
    """Checkouts of external users."""
    orders = rel.event_scan(events, [taxonomy.CART_CHECKOUT]).select(
        "OpenId", F.to_date("Timestamp").alias("OrderDate"), F.col("ExtraInfo1").alias("OrderId")
    )
    return rel.keep_external(orders, users, internal)


def cart_events(events: DataFrame, *, internal: str) -> DataFrame:
    """Items put into or taken out of a cart by external users."""
    return (
        rel.event_scan(events, [taxonomy.CART_ADDED, taxonomy.CART_DELETED])
        .where(text.lacks(F.col("CompanyId"), internal))
        .select(
            "OpenId", "Timestamp", "EventType",
            F.col("ExtraInfo1").alias("OrderLineId"),
            F.col("ExtraInfo2").alias("StockId"),
            F.col("ExtraInfo3").alias("Quantity"),
        )
    )
