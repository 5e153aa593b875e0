"""Reading and writing tables as Parquet directories, and staging.

A table is a directory under a root that every executor can reach.  A table that is
replaced as a whole holds a directory for each version, and a pointer names the current
one.  A version becomes current by one atomic rename after all of it is written, so a job
that fails leaves the old rows, and readers never see a half-written table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


_POINTER = "_current"
_VERSION = "version="


def _files(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system, as the session configures it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _current(spark: SparkSession, table: str) -> str | None:
    """The current version's name; None where the table is one plain directory."""
    pointer, files = _files(spark, f"{table}/{_POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point_to(spark: SparkSession, table: str, version: str) -> None:
    """Make ``version`` current: a pointer written aside takes the old one's place."""
    jvm = spark.sparkContext._jvm
    aside, files = _files(spark, f"{table}/{_POINTER}-{uuid.uuid4().hex}")
    stream = files.create(aside, True)
    stream.write(version.encode())
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    pointer, _ = _files(spark, f"{table}/{_POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf()).rename(
        aside, pointer, options)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table, or the earlier output of a job."""
    table = f"{root.rstrip('/')}/{name}"
    version = _current(spark, table)
    return spark.read.parquet(f"{table}/{version}" if version else table)


def collated(
    rows: DataFrame, collation: str = "UTF8_LCASE_RTRIM", columns: Sequence[str] | None = None
) -> DataFrame:
    """``rows`` whose text ``columns`` (all, if not named) compare by ``collation``.

    The default takes upper and lower case, and trailing blanks or none, as equal: in
    predicates, joins, groups and distinct counts of every operator.  Collate all tables
    of a job alike, as texts of two collations do not compare.  Spark tests collated texts
    after the scan; partition filters and filters on other types still reach it.
    """
    named = {f.name for f in rows.schema if isinstance(f.dataType, StringType)}
    wanted = named if columns is None else named.intersection(columns)
    return rows.select(*[
        F.collate(F.col(f"`{c}`"), collation).alias(c) if c in wanted else F.col(f"`{c}`")
        for c in rows.columns
    ])


def exact(rows: DataFrame) -> DataFrame:
    """``rows`` with texts compared byte by byte again, as stored tables hold them."""
    return collated(rows, "UTF8_BINARY")


def replace_table(
    rows: DataFrame, root: str, name: str, *, partition_by: Sequence[str] = ()
) -> None:
    """Write ``rows`` as the whole content of the table.

    Rows may come from the table itself.  The version replaced stays until the next
    replacement, for readers that have begun; older ones and what failed jobs left go.
    """
    spark, table = rows.sparkSession, f"{root.rstrip('/')}/{name}"
    before, version = _current(spark, table), f"{_VERSION}{uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(f"{table}/{version}")
    _point_to(spark, table, version)
    place, files = _files(spark, table)
    for entry in files.listStatus(place):
        if entry.getPath().getName() not in (_POINTER, version, before):
            files.delete(entry.getPath(), True)


def create_table(rows: DataFrame, root: str, name: str) -> None:
    """Write a new table; an existing one is an error."""
    rows.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{name}")


def append_day(
    rows: DataFrame, root: str, name: str, *, value: dt.date, day: str = "CurrentDate"
) -> None:
    """Add the results of the day ``value`` to a growing table.

    The table is partitioned by ``day``.  The day's directory is replaced as a whole, so
    running a day again replaces that day, also by nothing, and keeps the rest.  All
    ``rows`` are of that day.
    """
    folder = f"{root.rstrip('/')}/{name}/{day}={value.isoformat()}"
    rows.drop(day).write.mode("overwrite").parquet(folder)


def _period(by: str) -> Column:
    if by not in ("day", "month"):
        raise ValueError("by must be 'day' or 'month'")
    return F.to_date("Timestamp") if by == "day" else F.trunc("Timestamp", "MM")


def write_event_log(events: DataFrame, root: str, name: str, *, by: str = "day") -> None:
    """Write an event log for pruned reads.

    Partitioned by day (or month, for a small log) and sorted by event type within files,
    so that time bounds skip directories and type lists skip row groups.  Adaptive
    execution deals the rows by bytes: a heavy day goes to several tasks, and light ones
    share a task.
    """
    (
        events.withColumn("EventDate", _period(by))
        .hint("rebalance", "EventDate")
        .sortWithinPartitions("EventDate", "EventType", "OpenId")
        .write.mode("overwrite")
        .partitionBy("EventDate")
        .parquet(f"{root.rstrip('/')}/{name}")
    )


def read_event_log(
    spark: SparkSession, root: str, name: str, *, since: dt.date | None = None, by: str = "day"
) -> DataFrame:
    """An event log, from ``since`` on; earlier periods are not read.

    The rows keep ``EventDate``, from which ``relational.event_scan`` prunes by its bounds.
    """
    log = read_table(spark, root, name)
    if since is not None:
        period = since if by == "day" else since.replace(day=1)
        log = log.where(
            (F.col("EventDate") >= F.lit(period)) & (F.to_date("Timestamp") >= F.lit(since))
        )
    return log


def write_user_log(events: DataFrame, table: str, path: str, *, buckets: int) -> None:
    """Write the events of known users as a catalog table bucketed by user.

    Aggregations and joins of ``spark.table(table)`` on the user, also with further keys,
    need no shuffle of the log.  A task writes one bucket, a file for each month, sorted
    by event type.  Rows without a user would all share a bucket and are left out; user
    reports drop them too.  One user's rows are in one bucket: where a single user owns
    much of the log, read the log of :func:`write_event_log`.
    """
    (
        events.where(F.col("OpenId").isNotNull())
        .withColumn("EventDate", _period("month"))
        .repartition(buckets, "OpenId")
        .sortWithinPartitions("EventDate", "EventType", "OpenId")
        .write.mode("overwrite").format("parquet").option("path", path)
        .partitionBy("EventDate").bucketBy(buckets, "OpenId").sortBy("EventType", "OpenId")
        .saveAsTable(table)
    )


def staged(rows: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``rows`` as a table and read it back, for results read many times.

    Cuts the lineage: the table outlives lost executors, and later reads fetch only the
    columns they need.
    """
    replace_table(rows, root, name)
    return read_table(rows.sparkSession, root, name)
