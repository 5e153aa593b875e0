"""Relational building blocks used by the metric operators.

The blocks are written so that no single key has to fit into one task: rows are
reduced map-side to (key, day) or (key, instant) before they move, and time
lookups run per (key, hour) with a small carry between hours, never as an
inequality join that pairs up all rows of a key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.functions import dates, text

def one_of(column: str, values: Iterable[str]) -> Column:
    """``column IN (values)``, written as one expression: event lists are long
    and building them value by value is slow on the driver."""
    quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"`{column}` IN ({', '.join(quoted)})")


# --- scans -----------------------------------------------------------------


def event_scan(
    events: DataFrame,
    types: Iterable[str],
    *,
    after: dt.date | dt.datetime | None = None,
    between: tuple[dt.datetime, dt.datetime] | None = None,
) -> DataFrame:
    """Events of the given types, optionally later than ``after`` (exclusive)
    or inside the closed range ``between``.  Both filters reach the file scan.

    On a stored log, which has ``EventDate`` (the day or the month of the directory),
    directories outside the bounds are not read.
    """
    found = events.where(one_of("EventType", types))
    stored = "EventDate" in events.columns
    if after is not None:
        found = found.where(F.col("Timestamp") > dates.as_instant(after))
        if stored:
            found = found.where(F.col("EventDate") >= F.lit(_month_of(after)))
    if between is not None:
        low, high = between
        if stored:
            found = found.where(
                F.col("EventDate").between(F.lit(_month_of(low)), F.lit(_date_of(high)))
            )
        found = found.where(
            F.col("Timestamp").between(dates.as_instant(low), dates.as_instant(high))
        )
    return found


def _date_of(moment: dt.date | dt.datetime) -> dt.date:
    return moment.date() if isinstance(moment, dt.datetime) else moment


def _month_of(moment: dt.date | dt.datetime) -> dt.date:
    return _date_of(moment).replace(day=1)


def first_event(events: DataFrame, types: Iterable[str], name: str) -> DataFrame:
    """Earliest timestamp per user among ``types``."""
    return (
        event_scan(events, types)
        .where(F.col("OpenId").isNotNull())
        .groupBy("OpenId")
        .agg(F.min("Timestamp").alias(name))
    )


def active_days(
    events: DataFrame, types: Iterable[str], day: str = "YearMonthDay"
) -> DataFrame:
    """Distinct (user, day) pairs.

    The duplicate removal shuffles on user *and* day after a map-side combine,
    so a user who owns a third of the log ends up with at most one row per
    calendar day and cannot overload a later join on the user alone.
    """
    return (
        event_scan(events, types)
        .where(F.col("OpenId").isNotNull())
        .select("OpenId", F.to_date("Timestamp").alias(day))
        .distinct()
    )


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def day_bits(at: Column) -> Column:
    """Aggregate: the days of a month on which something happened, as bits from day 1."""
    return F.bit_or(_bit(F.dayofmonth(at) - 1))


def active_months(events: DataFrame, types: Iterable[str]) -> DataFrame:
    """One row per (user, month) with the bitmap ``Days`` of its active days.

    Bitmaps merge by OR, so they combine map-side and stand for up to 31 rows of
    :func:`active_days` in every later join.
    """
    return (
        event_scan(events, types)
        .where(F.col("OpenId").isNotNull())
        .groupBy("OpenId", F.trunc("Timestamp", "MM").alias("ActiveMonth"))
        .agg(day_bits(F.col("Timestamp")).alias("Days"))
    )


def category_months(events: DataFrame, categories: Mapping[str, Iterable[str]]) -> DataFrame:
    """One row per (user, month) with a bitmap of active days per category, in one pass.

    The bitmap is NULL for a category without an event in the month.
    """
    wanted = sorted({t for types in categories.values() for t in types})
    return (
        event_scan(events, wanted)
        .where(F.col("OpenId").isNotNull())
        .groupBy("OpenId", F.trunc("Timestamp", "MM").alias("ActiveMonth"))
        .agg(
            *[
                day_bits(F.when(one_of("EventType", types), F.col("Timestamp"))).alias(name)
                for name, types in categories.items()
            ]
        )
    )


def span_bits(days: Column, month: Column, low: Column, high: Column) -> Column:
    """The days of ``month`` that lie in the closed span, as bits from its first day.

    Bounds compare as instants: with a time of day, the span starts on the next day.
    The bitmaps of all months of a span merge by OR, so a month met twice counts once.
    A span has at most 62 days.
    """
    first = F.to_date(low)
    first = F.when(first < low, F.date_add(first, 1)).otherwise(first)
    at = F.datediff(month, first)
    length = F.datediff(F.to_date(high), first) + 1
    moved = F.when(at >= 0, F.call_function("shiftleft", days, at)).otherwise(
        F.call_function("shiftrightunsigned", days, -at))
    inside = at.between(-30, 61) & length.between(1, 62)
    return F.when(inside, moved.bitwiseAND(_bit(length) - 1)).otherwise(0)


def days_in_span(days: Column, month: Column, low: Column, high: Column) -> Column:
    """Aggregate: distinct active days in the span, over the months that touch it."""
    bits = F.bit_or(span_bits(days, month, low, high))
    return F.coalesce(F.bit_count(bits), F.lit(0)).cast("bigint")


def day_flags(
    events: DataFrame, categories: Mapping[str, Iterable[str]], day: str = "Day"
) -> DataFrame:
    """One row per (user, day) with a 0/1 column per category, in one pass."""
    wanted = sorted({t for types in categories.values() for t in types})
    return (
        event_scan(events, wanted)
        .where(F.col("OpenId").isNotNull())
        .groupBy("OpenId", F.to_date("Timestamp").alias(day))
        .agg(
            *[
                F.max(flag(one_of("EventType", types))).alias(name)
                for name, types in categories.items()
            ]
        )
    )


# --- conditional aggregates --------------------------------------------------


def count_if(condition: Column) -> Column:
    """``SUM(CASE WHEN condition THEN 1 ELSE 0 END)``; NULL counts as 0."""
    return F.sum(F.when(condition, 1).otherwise(0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, otherwise 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


# --- joins -------------------------------------------------------------------


def external_users(
    users: DataFrame, internal: str, *, case_insensitive: bool = True
) -> DataFrame:
    """Ids of users whose company is known and is not the own company."""
    return users.where(
        text.lacks(F.col("CompanyId"), internal, case_insensitive=case_insensitive)
    ).select("OpenId")


def keep_external(
    rows: DataFrame, users: DataFrame, internal: str, *, case_insensitive: bool = True
) -> DataFrame:
    """Rows of external users.  A semi-join: duplicate users never fan out."""
    keep = external_users(users, internal, case_insensitive=case_insensitive)
    return rows.join(keep, "OpenId", "left_semi")


def left_join_sparse_key(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread: Sequence[str],
    *, blanks_match: bool = True,
) -> DataFrame:
    """Left join where ``left_key`` is missing for a large share of the rows.

    Spark would send all NULL keys to one partition.  They cannot match, so
    they get a filler key drawn from a hash of ``spread`` and scatter evenly;
    the extra condition keeps the result exact even if a real key should
    equal a filler.  ``right_key`` must not occur in ``left``.  With
    ``blanks_match=False`` the right side has no blank keys, and blank ones of
    the left side scatter as well.
    """
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*spread).cast("string"))
    present = F.col(left_key).isNotNull()
    if not blanks_match:
        present = text.not_blank(F.col(left_key))
    keyed = left.withColumn("_key", F.when(present, F.col(left_key)).otherwise(filler))
    matched = (F.col("_key") == F.col(right_key)) & present
    return keyed.join(right, matched, "left").drop("_key")


def counted(rows: DataFrame, name: str) -> DataFrame:
    """Distinct rows with the number of times that each is there."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(name))


RUN = 1000  # copies that one row unfolds to in one step
SPREAD = 10_000  # rows of one listed key value for which a further salt is taken
PARTS = 16  # in which the rows of a listed key value are counted


def unfolded(rows: DataFrame, count: str) -> DataFrame:
    """Repeat each row ``count`` times (NULL: once) and drop the column.

    A row with very many copies first becomes runs of copies, which are dealt anew
    before they unfold, so that no task has to write out all of them.
    """
    total = F.greatest(F.coalesce(F.col(count), F.lit(1)), F.lit(0)).cast("bigint")
    staged = rows.withColumn("_n", total).where("_n > 0")
    runs = staged.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_n - 1) div {RUN})")))
    dealt = runs.hint("rebalance")
    left = F.least(F.lit(RUN), F.col("_n") - F.col("_run") * RUN)
    return (
        dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), left.cast("int"))))
        .drop(count, "_n", "_run", "_copy")
    )


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join whose *right* side repeats rows very often for some keys.

    Adaptive execution cannot split the right side of a left join, so its rows are
    counted first, map-side, and the copies unfold after the join.
    """
    joined = left.join(counted(right, "_copies"), key, "left")
    return unfolded(joined, "_copies")


def semi_join_spread(rows: DataFrame, known: DataFrame, key: str, spread: str) -> DataFrame:
    """Semi-join with a short list of ``key`` values of which each has very many rows.

    Both sides carry a salt, drawn from ``spread`` on the left and all salts on the
    right, so that one value goes to many tasks: one for every ``SPREAD`` rows that the
    most frequent value has in ``known``, where each value is counted in ``PARTS`` parts.
    """
    part = F.pmod(F.xxhash64(*known.columns), F.lit(PARTS)).alias("_part")
    counts = known.groupBy(key, part).agg(F.count(F.lit(1)).alias("_rows"))
    salts = F.coalesce(F.ceil(F.max("_rows") * PARTS / SPREAD), F.lit(1))
    most = counts.agg(salts.cast("bigint").alias("_salts"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), most.scalar()))
    listed = known.select(key).distinct().withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), most.scalar() - 1)))
    return salted.join(listed, [key, "_salt"], "left_semi").drop("_salt")


# --- one input, several readers ----------------------------------------------------


_READ = "_read"


def read_together(rows: DataFrame) -> DataFrame:
    """Let several readers (:func:`part_of`) of ``rows`` share its last exchange.

    Spark computes an exchange once where its copies are equal, but the optimizer would
    first push each reader's filter and choice of columns below it.  The mark needs all
    columns, and as it depends on the task no filter passes it, so the copies stay equal.
    """
    here = F.spark_partition_id() >= 0
    return rows.withColumn(_READ, F.when(here, F.xxhash64(*rows.columns)))


def part_of(shared: DataFrame, condition: Column) -> DataFrame:
    """The rows of :func:`read_together` for which ``condition`` holds."""
    return shared.where(condition & F.col(_READ).isNotNull()).drop(_READ)


# --- time lookups --------------------------------------------------------------


COMBINE = {"sum": F.sum, "max": F.max}


def slot_rows(rows: DataFrame, keys: Sequence[str], measures: Iterable[str]) -> DataFrame:
    """Events and probes, dealt once by key and hour of the log.

    ``rows`` has ``keys``, ``at``, ``_row`` (NULL for an event, a struct with
    ``closed`` for a probe) and the measures of events.  What reads the result
    reads the same exchange, so its input is computed once: all columns are
    needed by every reader in this module, and the key is a struct, which is
    never NULL itself, so no reader pushes a filter of its own below.
    """
    slot = F.struct(*keys, F.to_date("at").alias("_day"), F.hour("at").alias("_hour"))
    return rows.select(slot.alias("_slot"), "at", "_row", *measures).repartition("_slot")


def slot_totals(
    dealt: DataFrame, keys: Sequence[str], measures: Mapping[str, str], *, events: bool = False
) -> DataFrame:
    """Each probe of ``slot_rows`` with the measures over the earlier events.

    Rows have ``_slot``, ``at``, ``_row``, ``_own_<measure>`` and the totals:
    sums default to 0, maxima to NULL, as for a NULL in a key or in ``at``.
    With ``events`` they come back too, with totals up to themselves.

    A running window covers one (keys, hour) group at a time.  The totals of
    earlier hours come from a second window over one row per hour of the log,
    made from the same dealt rows.  No window spans all rows of a key.
    """
    probe = F.col("_row").isNotNull()
    order = F.when(~probe, 1).when(F.col("_row.closed"), 2).otherwise(0)
    up_to = Window.unboundedPreceding, Window.currentRow
    within = Window.partitionBy("_slot").orderBy("at", order).rowsBetween(*up_to)
    inside = dealt.select(
        "_slot", "at", "_row", *[F.col(n).alias(f"_own_{n}") for n in measures],
        *[COMBINE[h](n).over(within).alias(n) for n, h in measures.items()],
    )
    if not events:
        inside = inside.where(probe)
    before = (
        Window.partitionBy(*[f"_slot.{k}" for k in keys])
        .orderBy("_slot._day", "_slot._hour")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # only hours in which something asks have to be met again
    asked = F.max(F.when(probe, F.col("at"))).alias("_asked")
    earlier = (
        dealt.groupBy("_slot")
        .agg(*[COMBINE[h](n).alias(n) for n, h in measures.items()], asked)
        .select(
            "_slot", "_asked",
            *[COMBINE[h](n).over(before).alias(f"_e{n}") for n, h in measures.items()],
        )
        .where(F.col("_asked").isNotNull())
    )
    known = F.col("at").isNotNull()
    for k in keys:
        known = known & F.col(f"_slot.{k}").isNotNull()

    def total(name: str, how: str) -> Column:
        here, past = F.col(name), F.col(f"_e{name}")
        if how == "max":
            return F.when(known, F.greatest(here, past))
        return F.when(known, F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0))).otherwise(0)

    return inside.join(earlier, "_slot", "left").select(
        "_slot", "at", "_row", *[f"_own_{n}" for n in measures],
        *[total(n, h).alias(n) for n, h in measures.items()],
    )


def prefix_totals(
    probes: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Running totals of ``events`` looked up at each probe instant.

    ``probes`` has ``keys``, ``at``, ``closed`` and any further columns;
    ``events`` has ``keys``, ``at`` and the measure columns, combined by
    ``'sum'`` or ``'max'``.  Each probe row comes back once with the measures
    over the events of its keys with ``event.at < at`` (``<=`` when
    ``closed``): sums default to 0, maxima to NULL.  A NULL in a key or in
    ``at`` matches nothing.

    The work is linear in the input: events are combined per (keys, instant)
    before they move, and both sides move once (:func:`slot_totals`).
    """
    keys = list(keys)
    present = F.col("at").isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    carried = [c for c in probes.columns if c not in {*keys, "at", "closed"}]
    instants = events.where(present).groupBy(*keys, "at").agg(
        *[COMBINE[h](n).alias(n) for n, h in measures.items()])
    asked = probes.select(*keys, "at", F.struct("closed", *carried).alias("_row"))
    dealt = slot_rows(instants.unionByName(asked, allowMissingColumns=True), keys, measures)
    return slot_totals(dealt, keys, measures).select(
        *[F.col(f"_slot.{k}").alias(k) for k in keys], "at",
        *[F.col(f"_row.{c}").alias(c) for c in ("closed", *carried)], *measures,
    )


def latest_before(
    probes: DataFrame, events: DataFrame, keys: Sequence[str], event_id: str
) -> DataFrame:
    """As-of lookup: the event with the largest id strictly before each probe.

    Each probe row (``keys``, ``at``, ...) comes back once with ``event_id`` and
    ``found_at``, both NULL when there is no earlier event.  "Latest" is by id,
    which equals latest by time only when ids grow with time.
    """
    last = F.struct(F.col(event_id).alias("id"), F.col("at").alias("time")).alias("last")
    found = prefix_totals(
        probes.withColumn("closed", F.lit(False)),
        events.select(*keys, "at", last), keys, {"last": "max"},
    )
    return found.select(
        *probes.columns, F.col("last.id").alias(event_id), F.col("last.time").alias("found_at")
    )


@dataclass(frozen=True)
class Span:
    """A time window whose bounds are columns of the row it belongs to."""

    low: Column
    high: Column
    low_closed: bool = True
    high_closed: bool = True


def sum_in_spans(
    rows: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    spans: Mapping[str, Span],
) -> DataFrame:
    """Add to each distinct row the sums of ``measures`` inside its spans.

    A span total is the running total at its end minus that at its start, so
    the cost grows with rows plus events and not with their pairs.  ``spans``
    maps a name to a span; the sums are called name + measure.  An open-ended
    (NULL) bound gives 0.
    """
    ends = []
    for name, span in spans.items():
        known = span.low.isNotNull() & span.high.isNotNull()
        for at, closed, sign in (
            (span.low, not span.low_closed, -1),
            (span.high, span.high_closed, 1),
        ):
            ends.append(
                F.struct(
                    F.lit(name).alias("span"), F.when(known, at).alias("at"),
                    F.lit(closed).alias("closed"), F.lit(sign).alias("sign"),
                )
            )
    probes = rows.select("*", F.explode(F.array(*ends)).alias("_end")).select(
        *rows.columns, "_end.*"
    )
    totals = prefix_totals(probes, events, keys, {m: "sum" for m in measures})
    return totals.groupBy(*rows.columns).agg(
        *[
            F.sum(F.when(F.col("span") == name, F.col("sign") * F.col(m)).otherwise(0)).alias(
                f"{name}{m}"
            )
            for name in spans
            for m in measures
        ]
    )


# --- reshaping -----------------------------------------------------------------


def pivot_max(
    rows: DataFrame, by: Sequence[str], label: Column, value: Column, labels: Mapping[str, str]
) -> DataFrame:
    """Turn label/value rows into one column per listed label (maximum value).

    ``labels`` maps output column to label text.  Labels outside the list add
    no column but their rows still make a group, and a NULL key is one group.
    """
    return rows.groupBy(*by).agg(
        *[F.max(F.when(label == F.lit(t), value)).alias(c) for c, t in labels.items()]
    )


def unpivot_values(
    rows: DataFrame, ids: Sequence[str], metrics: Sequence[str],
    metric: str = "Metric", value: str = "Value",
) -> DataFrame:
    """Long form of ``metrics``; NULL values give no row, so each metric keeps
    its own denominator."""
    return rows.unpivot(list(ids), list(metrics), metric, value).where(
        F.col(value).isNotNull()
    )


# --- company attributes ----------------------------------------------------------


def company_types(company: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Company type by priority Partner, Customer, University, Other."""
    def any_row(column: str) -> Column:
        return F.max(flag(F.col(column) == 1)) == 1

    return company.groupBy("CompanyId", *extra_keys).agg(
        F.when(any_row("IsPartner"), "Partner")
        .when(any_row("IsCustomer"), "Customer")
        .when(any_row("IsUniversity"), "University")
        .otherwise("Other")
        .alias("CompanyType")
    )


def with_company_type(
    users: DataFrame, company: DataFrame, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """Attach the company type, 'Other' for unknown companies."""
    return users.join(company_types(company, extra_keys), "CompanyId", "left").withColumn(
        "CompanyType", F.coalesce("CompanyType", F.lit("Other"))
    )
