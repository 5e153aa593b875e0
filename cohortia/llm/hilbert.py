"""Shards of documents along a Hilbert curve over their metadata.

Each dimension is quantised by its distribution, so that a cell of the curve holds about
as many rows whatever the dimension's values are.  Rows are sorted by the index of their
cell on the curve and cut into runs: a shard covers a compact box of all dimensions at
once, so a reader that filters by any of them skips the shards whose ranges do not match.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType, LongType

from cohortia.llm.common import importable, parts_for, stage

DIMENSIONS = ("source", "lang", "size")
BITS = 8  # of a quantised dimension
_OWN = "llm_"  # of columns added on the way


def index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of ``bits``-bit coordinates.

    Gray code, one level of halving at a time: from the highest bit down, a coordinate
    whose bit is set reflects the first coordinate in what is below, and one whose bit is
    not set swaps what is below with the first.
    """
    x = np.array(cells, np.int64).T
    n = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(n):
            upper = (x[i] >> level) & 1 == 1
            swapped = np.where(upper, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, swapped)
            x[i] ^= swapped
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> level) & 1)
    return place


def running(rows: DataFrame, order: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Staged rows with ``before_<w>``: the sum of every weight over all earlier rows.

    Rows go by range of ``order`` to tasks, each of which adds up its own; the tasks'
    totals, as many as there are partitions, are carried on.  Rows that are equal in
    ``order`` should be told apart by its last column, then no value of any column is too
    frequent: the ranges split it.
    """
    spark = rows.sparkSession
    importable(spark)
    dealt = rows.repartitionByRange(parts_for(spark), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn(_OWN + "part", F.spark_partition_id().cast("long"))
    names = [f"before_{w}" for w in weights]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(weights, 0)
        for batch in batches:
            for w, name in zip(weights, names):
                own = batch.column(w).to_numpy(zero_copy_only=False).astype(np.int64)
                sums = np.cumsum(own) + carried[w]
                batch = batch.append_column(name, pa.array(sums - own))
                carried[w] = int(sums[-1]) if len(sums) else carried[w]
            yield batch

    schema = StructType([*dealt.schema.fields, *[StructField(name, LongType()) for name in names]])
    held = stage(dealt.mapInArrow(added, schema))
    totals = held.groupBy(_OWN + "part").agg(*[F.sum(w).alias(w) for w in weights]).collect()
    starts, so_far = [], dict.fromkeys(weights, 0)
    for row in sorted(totals, key=lambda r: r[_OWN + "part"]):
        starts.append((row[_OWN + "part"], *[so_far[w] for w in weights]))
        for w in weights:
            so_far[w] += row[w]
    schema = ", ".join([f"{_OWN}part long", *[f"{_OWN}{w} long" for w in weights]])
    carried = F.broadcast(spark.createDataFrame(starts, schema))  # a row for each partition
    return held.join(carried, _OWN + "part").select(
        *rows.columns, *[(F.col(n) + F.col(_OWN + w)).alias(n) for w, n in zip(weights, names)])


def cuts(rows: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Where the quantised values of every dimension begin: (least value, number) in order.

    Values are ordered as Spark orders them and numbered by the share of rows before
    their middle, ``2**bits`` numbers in all; so many cuts a dimension reach the driver
    at most.  Null is no cut, it has number 0.
    """
    listed = None
    for i, name in enumerate(dimensions):
        value = F.col(name)
        numeric = isinstance(rows.schema[name].dataType, NumericType)
        own = rows.groupBy(
            F.lit(i).alias("dim"),
            (F.lit(None).cast("string") if numeric else value.cast("string")).alias("text"),
            (value.cast("double") if numeric else F.lit(None).cast("double")).alias("number"),
        ).agg(F.count("*").alias("rows"))
        listed = own if listed is None else listed.union(own)
    numbered = running(listed, ["dim", "text", "number"], ["rows"])
    total = numbered.filter("dim = 0").agg(F.sum("rows")).first()[0]
    if not total:
        return {name: [] for name in dimensions}
    middle = F.col("before_rows") - F.col("dim") * F.lit(total) + F.expr("rows div 2")
    found = (
        numbered.filter("text IS NOT NULL OR number IS NOT NULL")
        .withColumn("cell", F.floor(middle * F.lit(1 << bits) / F.lit(total)))
        .groupBy("dim", "cell").agg(F.min("text").alias("text"), F.min("number").alias("number"))
        .collect()
    )
    out: dict[str, list] = {name: [] for name in dimensions}
    for row in sorted(found, key=lambda r: (r["dim"], r["cell"])):
        least = row["text"] if row["text"] is not None else row["number"]
        out[dimensions[row["dim"]]].append((least, int(row["cell"])))
    return out


def curve(rows: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row's cell on the Hilbert curve over its quantised dimensions."""
    importable(rows.sparkSession)
    bounds = cuts(rows, dimensions, bits)
    values = []
    for name in dimensions:
        numeric = isinstance(rows.schema[name].dataType, NumericType)
        values.append(F.col(name).cast("double" if numeric else "string"))
    held = [([least for least, _ in bounds[d]], [0, *[cell for _, cell in bounds[d]]]) for d in dimensions]

    @F.pandas_udf("long")
    def place(columns: pd.DataFrame) -> pd.Series:
        cells = np.zeros((len(columns), len(held)), np.int64)
        for i, (least, numbers) in enumerate(held):
            own = columns.iloc[:, i]
            codes, distinct = pd.factorize(own)  # null and NaN have no number
            known = np.array([numbers[bisect_right(least, v)] for v in distinct] + [0], np.int64)
            cells[:, i] = known[codes]
        return pd.Series(index(cells, bits))

    return place(F.struct(*[v.alias(f"d{i}") for i, v in enumerate(values)]))


def place(
    docs: DataFrame, *, shards: int = 16, law: str = "rows", dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS, keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of ``docs`` with size, text_crc32, law, curve, shard and slot.

    With ``keep``, only those columns of ``docs`` move and come back, without the texts
    for instance where the arrangement alone is wanted.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` the checksum of its bytes;
    both are those of an empty text where the text is null.  ``dimensions`` may name size
    and any columns of numbers or text; a null value is the first of its dimension.
    ``law`` says how the curve is cut: 'rows' makes counts at most one apart, 'bytes'
    sizes equal to within the largest document.  Slots number a shard's rows along the
    curve, from 0 without gaps.  On equal places of the curve rows with equal checksum lie
    together, then by doc_id; repeated rows and ids, and null ids, are rows like others.
    With fewer rows than shards the last shards are empty, an empty table gives no rows.
    Columns of ``docs`` that have a name of the added ones are replaced.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({
        "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text),
        _OWN + "one": F.lit(1).cast("long"), _OWN + "row": F.monotonically_increasing_id(),
    })
    rows = rows.withColumn("curve", curve(rows, dimensions, bits))
    added = ("size", "text_crc32", "law", "curve", "shard", "slot")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    moved = dict.fromkeys([*kept, "doc_id", "size", "text_crc32", "curve", _OWN + "one", _OWN + "row"])
    dealt = running(rows.select(*moved), ["curve", "text_crc32", "doc_id", _OWN + "row"], [_OWN + "one", "size"])
    at, before = F.col(f"before_{_OWN}one"), F.col("before_size")
    n, total = dealt.agg(F.count("*"), F.sum("size")).first()
    if law == "rows":
        least, more = divmod(n, shards)
        shard = F.when(at < more * (least + 1), F.floor(at / (least + 1))).otherwise(
            more + F.floor((at - more * (least + 1)) / max(least, 1)))
    else:
        shard = F.floor((before * 2 + F.col("size")).cast("decimal(38,0)") * shards / (2 * (total or 1)))
    dealt = dealt.withColumn("shard", F.least(shard.cast("int"), F.lit(shards - 1)))
    starts = {r["shard"]: r["least"] for r in dealt.groupBy("shard").agg(F.min(at).alias("least")).collect()}
    first = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("shard")) \
        if starts else F.lit(0)
    return dealt.select(
        *kept, "size", "text_crc32", F.lit(law).alias("law"), "curve", "shard",
        (at - first).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, **settings) -> DataFrame:
    """Write documents as Parquet, a folder for each shard, rows along the curve.

    Returns the manifest: rows, bytes and the range of every dimension of each shard, by
    which a reader picks the shards it needs.
    """
    dimensions = settings.get("dimensions", DIMENSIONS)
    placed = place(docs, **settings)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return manifest(docs.sparkSession.read.parquet(path), dimensions)


def manifest(placed: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """rows, bytes, least and most value of every dimension, and whether it has nulls."""
    spans = []
    for name in dimensions:
        spans += [
            F.min(name).alias(f"least_{name}"), F.max(name).alias(f"most_{name}"),
            F.bool_or(F.col(name).isNull()).alias(f"null_{name}"),
        ]
    return placed.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), *spans).orderBy("shard")
