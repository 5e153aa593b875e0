"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words.  Document rates w are as close to 1 as the
target allows, in relative entropy, and at most 2: the minimum of sum(w log w - w + 1)
under sum(w * size) = target is w = min(2, exp(lambda * size)), with one multiplier for
each source.  Newton steps on the convex dual find the multipliers; every step is one
aggregation over the counts of (source, size).  The rates are then rounded into copies
by carrying the fractions along each source in order of size, so that what rounding adds
or takes stays within a document, and the last gap is closed with single documents.

All sums are over exact numbers, so the result does not depend on the order of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix, as a multiple of all words
MOST = 2  # copies of a document
STEPS = 60  # Newton steps at most
CLOSE = 1e-9  # of the target
UNIT = 1 << 20  # fractions of a copy
RUN = 4096  # documents whose fractions are carried along in one window
SALTS = 64  # tasks that the rows of one source meet its facts in, at most
CLOSING = 3  # single documents that close the last gap of a source


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; null text: 0) and a hash of each whole text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col("doc_id").cast("string"), text).alias("mark"),
    )


def source_targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """source, k (its place by code point, null last), source_size and target.

    Targets share ``share`` times all words by weight, and stop at ``most`` times their
    source's words; the excess is shared again by weight.  That is the level at which
    the sources below it are full: sources are taken in the order in which they fill up.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))  # one row for each source
    weight = reduce(
        lambda found, i: found.when(F.col("k") % len(weights) == i, float(weights[i])),
        range(1, len(weights)), F.when(F.col("k") % len(weights) == 0, float(weights[0])),
    )
    placed = totals.withColumn("k", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    full = F.col("source_size").cast("double") * most
    fills = Window.orderBy(full / F.col("weight"), "k")
    everything = Window.partitionBy()
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    rest = fills.rowsBetween(0, Window.unboundedFollowing)
    levelled = placed.withColumn(
        "level",
        (F.sum("source_size").over(everything) * share
         - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    ).withColumn("open", full > F.col("level") * F.col("weight"))
    # the level is that of the first source that does not fill up
    level = F.min(F.when(F.col("open"), F.struct(full / F.col("weight"), "k", "level")))
    return levelled.withColumn("at", level.over(everything)["level"]).select(
        "source", "k", "source_size",
        F.when(F.col("at").isNull(), full)
        .otherwise(F.least(full, F.col("at") * F.col("weight"))).alias("target"),
    )


def _beside(rows: DataFrame, facts: DataFrame, key: str = "k") -> DataFrame:
    """Rows with the facts of their source, which may own most of them: source and salt
    deal the rows, and each fact goes to every salt."""
    salts = facts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("mark", "doc_id"), F.lit(SALTS))).join(
        salts, [key, "salt"]).drop("salt")


def _rate(tilt: Column, x: Column) -> Column:
    """Rate of a document of scaled size x; a null tilt is a source that is full."""
    return F.when(tilt.isNull(), float(MOST)).otherwise(
        F.least(F.lit(float(MOST)), F.exp(F.least(tilt * x, F.lit(1.0))))
    )


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,9)")


def tilts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """k, scale (mean size) and tilt, the multiplier of size / scale; null: full source."""
    counts = stage(
        sized.groupBy("source", "size").agg(F.count("*").alias("n")).alias("c")
        .join(targets.alias("t"), F.expr("c.source <=> t.source"))
        .select("k", "size", "n", "source_size", "target")
    )
    state = stage(
        counts.groupBy("k").agg(
            F.max("target").alias("target"),
            (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"),
            F.max("source_size").alias("source_size"),
        )
        .withColumn("full", F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12))
        .select(
            "k", "target", "scale", F.when(~F.col("full"), 0.0).alias("tilt"),
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            F.when(F.col("full"), 0.0).otherwise(1.0).alias("gap"),
        )
    )
    for _ in range(STEPS):
        if not state.filter(F.col("gap") > CLOSE).limit(1).count():
            break
        state = stage(_newton(counts, state))
    return state.select("k", "scale", "tilt")


def _newton(counts: DataFrame, state: DataFrame) -> DataFrame:
    """One step for every source: inside its bracket, else halving it."""
    x = F.col("size") / F.col("scale")
    rate = _rate(F.col("tilt"), x)
    words = F.col("n") * F.col("size")
    sums = (
        counts.select("k", "size", "n").join(state, "k")
        .groupBy("k").agg(
            F.sum(_exact(words * rate)).cast("double").alias("taken"),
            F.sum(_exact(F.when(rate < MOST, words * rate * x).otherwise(0.0))).cast("double")
            .alias("slope"),
        )
    )
    tilt, target, over = F.col("tilt"), F.col("target"), F.col("taken") > F.col("target")
    low, high = F.when(over, F.col("low")).otherwise(tilt), F.when(over, tilt).otherwise(F.col("high"))
    step = tilt - (F.col("taken") - target) / F.when(F.col("slope") > 0, F.col("slope"))
    reach = 1 + F.abs(tilt)
    inside = (step > F.coalesce("low", tilt - 4 * reach)) & (
        step < F.coalesce("high", tilt + 4 * reach))
    halved = F.when(F.col("low").isNull(), tilt - 4 * reach).when(
        F.col("high").isNull(), tilt + 4 * reach).otherwise((F.col("low") + F.col("high")) / 2)
    return (
        state.join(sums, "k").withColumns({"low": low, "high": high})
        .withColumn("gap", F.when(tilt.isNull(), 0.0)
                    .otherwise(F.abs(F.col("taken") - target) / target))
        .select(
            "k", "target", "scale",
            F.when((F.col("gap") <= CLOSE) | tilt.isNull(), tilt)
            .otherwise(F.when(inside, step).otherwise(halved)).alias("tilt"),
            "low", "high", "gap",
        )
    )


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, mark and copies (0 to 2) of every row.

    Null and empty texts have size 0 and are taken as they are, once.  A null source is
    a source of its own, the last one.  Repeated rows are rows of their own.
    """
    sized = stage(sizes(docs))
    targets = stage(source_targets(sized))
    rows = (
        sized.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source"))
        .select("doc_id", "s.source", "size", "mark", "k", "source_size", "target")
        .transform(_beside, tilts(sized, targets))
        .withColumn("units", F.when(F.col("size") > 0, F.round(
            _rate(F.col("tilt"), F.col("size") / F.col("scale")) * UNIT)).otherwise(UNIT)
            .cast("long"))
        .withColumn("bin", F.when(F.col("size") > 0, F.floor(F.log2("size") * 8)).otherwise(-1))
        .drop("tilt", "scale")
    )
    bins = rows.groupBy("k", "bin").agg(F.ceil(F.count("*") / RUN).alias("runs"))
    rows = stage(
        rows.join(bins, ["k", "bin"])
        .withColumn("run", F.pmod(F.xxhash64("mark"), F.col("runs"))).drop("runs")
    )
    before = Window.partitionBy("k").orderBy("bin", "run")
    carried = (
        rows.groupBy("k", "bin", "run").agg(F.sum("units").alias("all_units"))
        .withColumn("start", F.sum("all_units").over(before) - F.col("all_units") + UNIT // 2)
        .drop("all_units")
    )
    along = Window.partitionBy("k", "bin", "run").orderBy("size", "mark", "doc_id")
    end = F.col("start") + F.sum("units").over(along.rowsBetween(Window.unboundedPreceding, 0))
    rounded = (
        rows.join(carried, ["k", "bin", "run"])
        .withColumns({"end": end, "nth": F.row_number().over(along)})
        .withColumn("copies", F.expr(f"end div {UNIT} - (end - units) div {UNIT}"))
        .drop("start", "end", "units")
    )
    for _ in range(CLOSING):
        rounded = _closed(stage(rounded))
    return rounded.select(
        "doc_id", "source", "size", "source_size", "target", "mark", "copies"
    )


def _closed(rows: DataFrame) -> DataFrame:
    """Change the copies of one document of each source where that brings it nearer."""
    gaps = rows.groupBy("k").agg(
        (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    can = (F.col("size") > 0) & F.when(F.col("gap") > 0, F.col("copies") < MOST).otherwise(
        F.col("copies") > 0)
    left = F.abs(F.abs("gap") - F.col("size"))
    best = (
        _beside(rows, gaps).filter(can & (left < F.abs("gap")))
        .groupBy("k").agg(F.min(F.struct(left.alias("left"), "bin", "run", "nth",
                                         F.signum("gap").cast("int").alias("change"))).alias("b"))
        .select("k", "b.bin", "b.run", "b.nth", "b.change")
    )
    return rows.join(best, ["k", "bin", "run", "nth"], "left").withColumn(
        "copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them."""
    key = ["doc_id", "source", "mark"]
    mark = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    whole = docs.select(row.alias("row"), "doc_id", "source", mark.alias("mark"))
    copies = mix(docs).groupBy(*key).agg(F.sum("copies").alias("copies")).filter("copies > 0")
    same = " AND ".join(f"w.{name} <=> c.{name}" for name in key)
    group = Window.partitionBy(*key)
    return (
        whole.alias("w").join(copies.alias("c"), F.expr(same)).select("w.*", "copies")
        .withColumns({
            "nth": F.row_number().over(group.orderBy(F.lit(0))),
            "twins": F.count("*").over(group),
        })
        # rows that repeat each other share their copies
        .withColumn("own", F.expr("copies * nth div twins - copies * (nth - 1) div twins"))
        .filter("own > 0").withColumn("copy", F.explode(F.expr("sequence(1, int(own))")))
        .select("row.*")
    )
