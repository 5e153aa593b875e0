"""Significance of A/B experiments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel

SIGNUP_METRICS = ("SignupStarted", "SignupCompleted", "Activated")
TOUR_METRICS = ("GuidanceFinished", "LectureCompleted", "WmActivated")


def unpivot_metrics(
    rows: DataFrame, *, date_column: str, metrics: Sequence[str], weight: str | None = None
) -> DataFrame:
    """One row per experiment member and metric that has a value.

    ``weight`` is a column to carry along that counts repetitions of a member.
    """
    ids = [date_column, "ExperimentGroup", "Experiment", *([weight] if weight else [])]
    cast = rows.select(*ids, *[F.col(m).cast("int").alias(m) for m in metrics])
    return rel.unpivot_values(cast, ids, metrics)


def _moments(value: Column, weight: str | None) -> tuple[Column, Column, Column]:
    """Size, mean and sample variance, of plain or of repeated values."""
    if weight is None:
        return F.count("Metric"), F.avg(value), F.var_samp(value)
    times = F.col(weight)
    size, total = F.sum(times), F.sum(times * value)
    squares = F.sum(times * value * value)
    variance = F.when(size > 1, (squares - total * total / size) / (size - 1))
    return size, total / size, variance


def ab_significance(
    long: DataFrame, *, as_of: dt.date | dt.datetime, weight: str | None = None
) -> DataFrame:
    """Size and mean of groups A and B and the z-score, per experiment and metric.

    ``Z = (largest mean - smallest mean) / sqrt(sum of variance / size)`` over
    all non-blank groups, not only A and B; NULL when the root is 0 or no group
    has a variance.  Rows without an experiment keep their metric with NULL
    sizes and means.  With ``weight`` a row stands for that many equal rows.
    """
    value = F.col("Value").cast("double")
    size, mean, variance = _moments(value, weight)
    known = F.col("Experiment").isNotNull()
    groups = (
        long.where(text.not_blank(F.col("ExperimentGroup")))
        .groupBy("Experiment", "Metric", "ExperimentGroup")
        .agg(
            F.when(known, size).alias("N"),
            F.when(known, mean).alias("Mu"),
            F.when(known, variance).alias("Variance"),
        )
    )
    group = F.col("ExperimentGroup")
    a, b = group == "A", group == "B"
    root = F.sqrt(F.sum(F.col("Variance") / F.col("N")))
    return groups.groupBy("Experiment", "Metric").agg(
        F.max(F.when(a, group)).alias("G1"),
        F.max(F.when(b, group)).alias("G2"),
        F.sum(F.when(a, F.col("N"))).alias("N1"),
        F.sum(F.when(b, F.col("N"))).alias("N2"),
        F.sum(F.when(a, F.col("Mu"))).alias("Mu1"),
        F.sum(F.when(b, F.col("Mu"))).alias("Mu2"),
        F.try_divide(F.max("Mu") - F.min("Mu"), root).alias("Zscore"),
    ).select(
        dates.as_day(as_of).alias("CurrentDate"), "Experiment", "Metric",
        "G1", "G2", "N1", "N2", "Mu1", "Mu2", "Zscore",
    )


def active_experiments(
    results: DataFrame, tracker: DataFrame, *, days_after_end: int = 30
) -> DataFrame:
    """Results of experiments that run, ended recently, or are not tracked.

    A row stays when the experiment has started and has no end, when its end
    plus ``days_after_end`` is still ahead, or when no start is known.
    """
    dated = tracker.select(
        F.col("UniqueId").alias("Experiment"),
        F.to_date("StartDate").alias("_start"),
        F.to_date("EndDate").alias("_end"),
    )
    today = F.col("CurrentDate")
    running = (today > F.col("_start")) & F.col("_end").isNull()
    recent = F.date_add("_end", days_after_end) > today
    return (
        results.join(dated, "Experiment", "left")
        .where(running | recent | F.col("_start").isNull())
        .select(*results.columns)
    )
