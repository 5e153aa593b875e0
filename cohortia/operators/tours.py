"""Guided tutorials and product tours."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy


def tour_progress(events: DataFrame) -> DataFrame:
    """Start, steps and finish per user and tutorial, in one aggregation.

    ``FirstStartDate`` is the first welcome step (NULL when never started),
    ``CompletedSteps`` the number of distinct steps, ``FinishDate`` the first
    day of *any* step, and ``GuidanceFinished`` the number of finish steps.
    """
    step, day = F.col("ExtraInfo1"), F.to_date("Timestamp")
    return (
        rel.event_scan(events, [taxonomy.TUTORIAL_STEP])
        .groupBy("OpenId", F.col("ExtraInfo2").alias("Tutorial"))
        .agg(
            F.min(F.when(step == taxonomy.WELCOME_STEP, day)).alias("FirstStartDate"),
            F.countDistinct(step).alias("CompletedSteps"),
            F.min(day).alias("FinishDate"),
            rel.count_if(step == taxonomy.FINISHED_STEP).alias("GuidanceFinished"),
        )
    )


def tour_started(progress: DataFrame) -> DataFrame:
    """First start per user and tutorial."""
    return progress.where(F.col("FirstStartDate").isNotNull()).select(
        "OpenId", "FirstStartDate", "Tutorial"
    )


def tour_steps_completed(progress: DataFrame) -> DataFrame:
    """Distinct steps per user and tutorial."""
    return progress.select("OpenId", "Tutorial", "CompletedSteps")


def tour_finished(progress: DataFrame) -> DataFrame:
    """Finish count and first day per user and tutorial."""
    return progress.select("OpenId", "Tutorial", "FinishDate", "GuidanceFinished")


def tour_broken(events: DataFrame) -> DataFrame:
    """Users and days with a broken tour (at most one per user and day)."""
    return (
        rel.event_scan(events, [taxonomy.TUTORIAL_BROKEN])
        .select("OpenId", F.to_date("Timestamp").alias("BrokenDate"))
        .distinct()
        .withColumn("BrokenEvents", F.lit(1))
    )


def tour_broken_daily(broken: DataFrame) -> DataFrame:
    """Number of users with a broken tour per day."""
    return broken.groupBy("BrokenDate").agg(F.sum("BrokenEvents").alias("BrokenEventsByDay"))


def tour_continue(events: DataFrame) -> DataFrame:
    """Distinct 'continue' steps per user."""
    return (
        rel.event_scan(events, [taxonomy.TUTORIAL_STEP])
        .where(F.lower("ExtraInfo1").startswith(taxonomy.CONTINUE_PREFIX.lower()))
        .select("OpenId", F.col("ExtraInfo1").alias("StepName"))
        .distinct()
    )


def tour_conversion(
    progress: DataFrame,
    events: DataFrame,
    *,
    anchor: str = "start",
    lecture_types: Iterable[str] = (taxonomy.LECTURE_COMPLETED,),
    deploy_types: Iterable[str] = taxonomy.ACTIVATION,
) -> DataFrame:
    """Lecture completed and app deployed on days +1 to +8 after the anchor.

    ``anchor`` is ``'start'`` (tutorials that were started) or ``'finish'``
    (every tutorial, counted from ``FinishDate``).  The columns of ``progress``
    are kept, so later steps need no join back to it.
    """
    if anchor == "start":
        base = progress.where(F.col("FirstStartDate").isNotNull())
        anchor_day = F.col("FirstStartDate")
    elif anchor == "finish":
        base, anchor_day = progress, F.col("FinishDate")
    else:
        raise ValueError("anchor must be 'start' or 'finish'")
    windows = base.withColumn("LowerBoundary", F.date_add(anchor_day, 1)).withColumn(
        "UpperBoundary", F.date_add(anchor_day, 8)
    )
    days = rel.day_flags(
        events, {"Lecture": tuple(lecture_types), "Deploy": tuple(deploy_types)}
    ).withColumnRenamed("OpenId", "DayUser")
    in_window = (F.col("OpenId") == F.col("DayUser")) & F.col("Day").between(
        F.col("LowerBoundary"), F.col("UpperBoundary")
    )
    return (
        windows.join(days, in_window, "left")
        .groupBy(*windows.columns)
        .agg(
            F.coalesce(F.max("Lecture"), F.lit(0)).alias("LectureCompleted"),
            F.coalesce(F.max("Deploy"), F.lit(0)).alias("WmActivated"),
        )
    )


def tour_output(
    conversion: DataFrame,
    growth: DataFrame,
    *,
    as_of: dt.date | dt.datetime,
    continued: DataFrame | None = None,
    broken: DataFrame | None = None,
    customer_types: DataFrame | None = None,
    require_finished: bool = False,
    experiment: str | None = None,
    not_experiment: str | None = None,
    first_days: int = 8,
    copies: str | None = None,
) -> DataFrame:
    """Started tutorials of new users with conversion and growth metrics.

    Conversions are NULL until their window has passed and, with
    ``require_finished`` (use it with the finish anchor), unless the tutorial
    was finished.  Only tutorials started less than ``first_days`` days after
    signup are kept; a start before signup qualifies.

    The grain is user x tutorial, times each 'continue' step of the user when
    ``continued`` is given (it is matched on the user alone, on purpose), times
    each broken day of the user when ``broken`` is given.  A user's equal steps go through
    the joins as one row with their number and unfold last, dealt anew, so that no task
    has to write out one user's product; ``copies`` names a column that keeps the number
    instead, as a weight for statistics.
    """
    tutorial = F.col("Tutorial")
    name = text.tutorial_experiment(tutorial)
    kept = F.col("FirstStartDate").isNotNull()
    if experiment is not None:
        kept = kept & (name == experiment)
    if not_experiment is not None:
        kept = kept & (name != not_experiment)
    base = conversion.where(kept)

    # A missing tutorial name matches no step facts and no continue steps.
    known = tutorial.isNotNull()
    finished = F.when(known, F.col("GuidanceFinished"))
    steps = F.when(known, F.col("CompletedSteps"))
    due = dates.as_instant(as_of) > F.col("UpperBoundary")
    if require_finished:
        due = due & (finished > 0)
        steps = F.when(finished == 0, steps)
    columns = [
        "OpenId", "FirstStartDate", "Tutorial", name.alias("Experiment"),
        text.tutorial_group(tutorial).alias("ExperimentGroup"),
        rel.flag(finished > 0).alias("GuidanceFinished"),
        F.when(due, F.col("LectureCompleted")).alias("LectureCompleted"),
        F.when(due, F.col("WmActivated")).alias("WmActivated"),
    ]
    if continued is not None:
        choices = rel.counted(
            continued.select(F.col("OpenId").alias("_chooser"), "StepName"), "_steps"
        )
        base = base.join(choices, (F.col("OpenId") == F.col("_chooser")) & known, "left")
        columns += [
            rel.flag(F.col("StepName") == taxonomy.CONTINUE_LEARN).alias("Learn"),
            rel.flag(F.col("StepName") == taxonomy.CONTINUE_IN_APP).alias("WorkInApp"),
            "_steps",
        ]
    tours = base.select(*columns, steps.alias("CompletedSteps"))

    week = dates.day_diff(F.col("SignupDate"), F.col("FirstStartDate")) < first_days
    out = (
        tours.join(growth, F.col("OpenId") == F.col("UserId"), "inner")
        .where(week)
        .withColumn("WithinFirstWeek", F.lit(1))
    )
    if broken is not None:
        days = broken.withColumnRenamed("OpenId", "_broken_user")
        out = (
            out.join(days, F.col("OpenId") == F.col("_broken_user"), "left")
            .drop("_broken_user")
            .withColumn("GuidanceStarted", rel.flag(text.not_blank(F.col("OpenId"))))
            .withColumn("Activated", F.col("ActivatedWithin30days"))
        )
        if continued is None:
            out = out.drop("BrokenDate")
        else:
            open_steps = F.when(F.col("GuidanceFinished") == 0, F.col("CompletedSteps"))
            out = (
                out.withColumn("ChosenLearn", F.col("Learn"))
                .withColumn("ChosenWorkInApp", F.col("WorkInApp"))
                .withColumn("StageCompletion", open_steps)
                .withColumn("Maxsteps", F.col("CompletedSteps"))
            )
    if customer_types is not None:
        types = customer_types.select(F.col("OpenId").alias("CustomerId"), "CustomerType")
        out = out.join(types, F.col("OpenId") == F.col("CustomerId"), "left").drop("CustomerId")
    if continued is None:
        return out if copies is None else out.withColumn(copies, F.lit(1).cast("bigint"))
    if copies is None:
        return rel.unfolded(out, "_steps")
    return out.withColumn(copies, F.coalesce("_steps", F.lit(1))).drop("_steps")


def flow_conversion(events: DataFrame) -> DataFrame:
    """Start and end of each product tour per user, for tours ended at most once.

    ``LastStep`` averages the last step of closed tours with 1000 for every
    other outcome, cut to an integer; a step that is no number is left out.
    """
    started = (
        rel.event_scan(events, [taxonomy.TOUR_STARTED])
        .groupBy("OpenId", F.col("ExtraInfo1").alias("FlowID"))
        .agg(
            F.to_date(F.min("Timestamp")).alias("FirstStartDate"),
            F.max("ExtraInfo3").alias("Revision"),
            F.count("OpenId").alias("TimesStarted"),
        )
    )
    outcome = F.col("ExtraInfo2")
    closed = text.same_text(outcome, "closed")
    step = F.when(closed, F.col("ExtraInfo3").try_cast("int")).otherwise(1000)
    ended = (
        rel.event_scan(events, [taxonomy.TOUR_ENDED])
        .groupBy("OpenId", F.col("ExtraInfo1").alias("FlowID"))
        .agg(
            rel.count_if(text.same_text(outcome, "completed")).alias("CountCompleted"),
            rel.count_if(closed).alias("CountClosed"),
            F.avg(step).cast("int").alias("LastStep"),
        )
    )
    completed = F.coalesce("CountCompleted", F.lit(0))
    shut = F.coalesce("CountClosed", F.lit(0))
    return (
        started.join(ended, ["OpenId", "FlowID"], "left")
        .where(completed + shut < 2)
        .select(
            "OpenId", "FlowID", "Revision", "FirstStartDate", "TimesStarted",
            completed.alias("CountCompleted"), shut.alias("CountClosed"),
            rel.flag(F.col("TimesStarted") > 0).alias("Started"), "LastStep",
        )
    )
