"""Near-duplicate vectors by hashing to cells of the E8 lattice.

Each table projects unit vectors at random to eight dimensions and decodes the result to
the nearest point of E8, whose 240 shortest vectors lead to the neighbouring cells.  A
vector is looked up in its own cell and in the neighbouring cells nearest to it; what is
found there is verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import scan, stage
from cohortia.llm.components import components

COSINE = 0.95
TABLES = 14
PROBES = 8  # neighbouring cells that a vector is looked up in
SCALE = 1.5  # of the projection; a cell has volume 1
SEED = 20_240


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    points = np.rint(x)
    off = x - points
    row = np.arange(len(x))
    worst = np.abs(off).argmax(axis=1)
    odd = points.sum(axis=1) % 2 != 0
    points[row, worst] += np.where(odd, np.where(off[row, worst] >= 0, 1, -1), 0)
    return points


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8 to rows of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _keys(points: np.ndarray, table: int, size: int) -> np.ndarray:
    """One 64-bit key for each lattice point of a table for vectors of ``size``."""
    doubled = np.rint(points * 2).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        key = np.full(points.shape[:-1], (table * 1_000_003 + size) & 0xFFFFFFFF, np.uint64)
        for i in range(8):
            key = (key ^ doubled[..., i]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def cells(rows: DataFrame, *, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
          seed: int = SEED) -> DataFrame:
    """(c, key, own): the cells of vectors (c, unit), their own and those to look up."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        steps = shortest_vectors()
        projections: dict[int, np.ndarray] = {}
        for part in slices:
            by_size: dict[int, list[int]] = {}
            for i, vector in enumerate(part["unit"]):
                by_size.setdefault(len(vector), []).append(i)
            for size, at in by_size.items():
                if size not in projections:
                    random = np.random.default_rng([seed, size])
                    projections[size] = random.normal(size=(size, 8 * tables)) * scale
                x = np.array([part["unit"][i] for i in at]) @ projections[size]
                own = np.array([part["c"][i] for i in at], np.int64)
                for table in range(tables):
                    y = x[:, 8 * table:8 * table + 8]
                    points = decode(y)
                    near = np.argpartition(-((y - points) @ steps.T), probes, axis=1)[:, :probes]
                    around = np.concatenate([points[:, None], points[:, None] + steps[near]], axis=1)
                    keys = _keys(around, table, size)
                    first = np.zeros(keys.shape, bool)
                    first[:, 0] = True
                    yield {
                        "c": np.repeat(own, keys.shape[1]),
                        "key": keys.ravel(),
                        "own": first.ravel(),
                    }

    return scan(rows.select("c", "unit"), each, "c long, key long, own boolean")


def near_duplicates(vectors: DataFrame, *, cosine: float = COSINE, **settings) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``.

    ``vectors`` has vec_id and embedding.  Equal vectors are one class: each row links to
    the others of its class and to the rows of the classes within ``cosine``.  Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing
    and are components of their own, as are rows without an id that link with nothing
    (component null); vectors of different length never link.  Rows that repeat an id
    are rows of their own.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + x * x))
    double = F.col("embedding").cast("array<double>")
    usable = (
        F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = vectors.select("vec_id", double.alias("v")).withColumn(
        "norm", F.when(F.col("v").isNotNull() & F.coalesce(usable, F.lit(False)), norm))
    # a norm that over- or underflows is taken of the vector scaled by its largest component
    rows = rows.withColumn("most", F.when(
        F.col("norm").isNotNull(), F.array_max(F.transform("v", lambda x: F.abs(x)))))
    good = rows.filter("most > 0").withColumn(
        "v", F.transform("v", lambda x: x / F.col("most"))).withColumn("norm", norm)
    unit = good.select(
        "vec_id", F.transform("v", lambda x: x / F.col("norm")).alias("unit")
    ).withColumn("c", F.xxhash64("unit"))
    classes = stage(
        unit.groupBy("c").agg(
            F.first("unit").alias("unit"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    )
    found = cells(classes, **settings)
    entries = stage(found)
    pairs = (
        entries.alias("p").join(entries.filter("own").alias("i"), "key")
        .filter("p.c <> i.c")
        .select(F.least("p.c", "i.c").alias("a"), F.greatest("p.c", "i.c").alias("b")).distinct()
    )
    dot = F.aggregate(
        F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda sum_, x: sum_ + x)
    links = stage(
        pairs.join(classes.select(F.col("c").alias("a"), F.col("unit").alias("x")), "a")
        .join(classes.select(F.col("c").alias("b"), F.col("unit").alias("y")), "b")
        .filter(dot >= cosine).select("a", "b")
    )
    both = links.union(links.select("b", "a"))
    others = (
        both.join(classes.select(F.col("c").alias("b"), "n"), "b")
        .groupBy("a").agg(F.sum("n").alias("linked"))
    )
    roots = components(links)
    named = (
        roots.join(classes, roots["node"] == classes["c"])
        .groupBy("root").agg(F.min("least").alias("component"))
    )
    about = (
        classes.select("c", "n", "least")
        .join(others, F.col("c") == F.col("a"), "left")
        .join(roots, F.col("c") == F.col("node"), "left")
        .join(named, "root", "left")
        .select(
            "c", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "least").alias("component_id"),
        )
    )
    linked = unit.select("vec_id", "c").join(about, "c").select("vec_id", "n_links", "component_id")
    alone = rows.filter("most IS NULL OR most <= 0").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
