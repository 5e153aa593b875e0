"""Hard negatives by rotated one-bit codes.

A vector is coded by the signs of its rotated components and by how far it aligns with
that code vector; what the code leaves over is rotated and coded again, a few times.  An
anchor's product with a code is a few popcounts over the bit planes of the rotated anchor.
Alignments times these products estimate the score, and the Cauchy-Schwarz inequality
bounds what is left over: an interval that holds the score for certain.  Rows whose
interval cannot reach the result go after each code; the rest are scored in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.common import importable, stage
from cohortia.llm.vectors import finite, fixed_point, matrix, widest

CODES = 6  # one-bit codes of a vector, each of what the ones before leave over
PLANES = 8  # bits of a component of a rotated anchor
ANCHORS = 4_096  # anchors of a block
ROWS = 8_192  # vectors of a block
SEED = 20_242

_CODED = "row long, vec_id long, label long, x binary, codes binary, along binary, left binary, length double"


def _rotations(width: int, codes: int, seed: int) -> np.ndarray:
    """A random rotation for each code."""
    random = np.random.default_rng([seed, width])
    return np.stack([np.linalg.qr(random.normal(size=(width, width)))[0] for _ in range(codes)])


def encode(x: np.ndarray, rotations: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, along, left) of rows: sign bits, product with the code vector, and the
    norm of what is left over, for each code.

    Row = sum over codes of along * (code vector turned back) + what is left at last.
    """
    width = rotations.shape[1]
    rest = x.astype(float)
    codes, along, left = [], [], []
    for rotation in rotations:
        rest = rest @ rotation
        bits = rest >= 0
        signs = np.where(bits, 1.0, -1.0) / np.sqrt(width)
        own = (rest * signs).sum(axis=1)
        rest = rest - own[:, None] * signs
        codes.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))
        along.append(own)
        left.append(np.sqrt((rest**2).sum(axis=1)))
    return np.stack(codes, axis=1), np.stack(along, axis=1), np.stack(left, axis=1)


class _Anchor:
    """A rotated anchor in bit planes, one set for each code."""

    def __init__(self, x: np.ndarray, rotations: np.ndarray, planes: int):
        self.x, self.width = x, rotations.shape[1]
        self.norm = float(np.sqrt((x.astype(float) ** 2).sum()))
        self.planes, self.low, self.step, self.total, self.off = [], [], [], [], []
        turned = x.astype(float)
        for rotation in rotations:
            turned = turned @ rotation
            low = float(turned.min())
            step = (float(turned.max()) - low) / (2**planes - 1) or 1.0
            steps = np.rint((turned - low) / step).astype(np.int64)
            bits = (steps[None, :] >> np.arange(planes)[:, None]) & 1
            self.planes.append(
                np.packbits(bits.astype(bool), axis=1, bitorder="little").view(np.uint64))
            self.low.append(low)
            self.step.append(step)
            self.total.append(int(steps.sum()))
            self.off.append(float(np.sqrt(((turned - (low + step * steps)) ** 2).sum())))

    def product(self, code: int, bits: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """The anchor's product with code vectors, but for ``off[code]`` at most."""
        planes = self.planes[code]
        weights = 2.0 ** np.arange(len(planes))
        common = np.bitwise_count(bits[:, None, :] & planes[None]).sum(axis=2) @ weights
        whole = self.low[code] * (2 * ones - self.width) + self.step[code] * (2 * common - self.total[code])
        return whole / np.sqrt(self.width)


class Block:
    """Coded vectors, and the intervals of their scores with an anchor."""

    def __init__(self, part: pa.Table, width: int, codes: int):
        n = part.num_rows
        binary = lambda name, kind: np.frombuffer(
            b"".join(part.column(name).to_pylist()), kind).reshape(n, -1)
        self.x = binary("x", np.int64)
        self.codes = binary("codes", np.uint64).reshape(n, codes, -1)
        self.along, self.left = binary("along", float), binary("left", float)
        self.ones = np.bitwise_count(self.codes).sum(axis=2).astype(float)
        self.row, self.vec_id, self.label, self.length = (
            part.column(c).to_numpy() for c in ("row", "vec_id", "label", "length"))

    def scores(self, at: np.ndarray, anchor: _Anchor) -> np.ndarray:
        return self.x[at] @ anchor.x

    def intervals(self, at: np.ndarray, anchor: _Anchor, width: int) -> Iterator:
        """Yields (low, high) of rows ``at`` after each code; is sent those that stay."""
        estimate, doubt = np.zeros(len(at)), np.zeros(len(at))
        for code in range(self.codes.shape[1]):
            along = self.along[at, code]
            own = anchor.product(code, self.codes[at, code], self.ones[at, code])
            estimate += along * own
            doubt += along * anchor.off[code]
            # what is left is orthogonal to this code's vector, so only that part of the
            # anchor which is so too can meet it
            across = np.sqrt(np.maximum(
                0, anchor.norm**2 - np.maximum(0, np.abs(own) - anchor.off[code]) ** 2))
            wide = doubt + across * self.left[at, code]
            wide += 1e-9 * anchor.norm * self.length[at] + 1e-6  # rounding of the sums
            stay = yield estimate - wide, estimate + wide
            at, estimate, doubt = at[stay], estimate[stay], doubt[stay]


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: higher scores, then smaller ids."""
    return np.lexsort((rows, ids, -scores))[:k]


def nearest(block: Block, at: np.ndarray, anchor: _Anchor, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of rows ``at`` by score, and their scores."""
    walk = block.intervals(at, anchor, anchor.width)
    low, high = next(walk)
    while True:
        least = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
        stay = high >= least
        at = at[stay]
        try:
            low, high = walk.send(stay)
        except StopIteration:
            break
    scores = block.scores(at, anchor)
    first = _best(scores, block.vec_id[at], block.row[at], k)
    return at[first], scores[first]


def within(block: Block, at: np.ndarray, anchor: _Anchor, bands: list[tuple[int, int]], k: int):
    """For each band of scores, the first k of rows ``at`` in it, and their scores."""
    walk = block.intervals(at, anchor, anchor.width)
    low, high = next(walk)
    while True:
        stay = np.zeros(len(at), bool)
        for least, most in bands:
            if least > most:
                continue
            certain = low[(low >= least) & (high <= most)]
            if len(certain) >= k:
                least = np.partition(certain, len(certain) - k)[len(certain) - k]
            stay |= (high >= least) & (low <= most)
        at = at[stay]
        try:
            low, high = walk.send(stay)
        except StopIteration:
            break
    scores = block.scores(at, anchor)
    out = []
    for least, most in bands:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        first = inside[_best(scores[inside], block.vec_id[at[inside]], block.row[at[inside]], k)]
        out.append((at[first], scores[first]))
    return out


def coded(
    vectors: DataFrame, *, scale: int = 256, codes: int = CODES, seed: int = SEED
) -> tuple[DataFrame, int]:
    """Rows that take part, as whole numbers and codes, staged; and the padded width.

    ``vectors`` has vec_id, embedding and label.  Rows whose id, label or vector is null,
    or whose vector holds null or non-finite components, take no part.  Shorter vectors
    are filled up with zeros, and equal rows are one row.
    """
    good = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("v"))
    whole = good.select("vec_id", "label", fixed_point("v", scale, 0).alias("x")).distinct()
    size = widest(good, "v")
    width = max(64, -(-size // 64) * 64)
    importable(vectors.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations = _rotations(width, codes, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), width)
            bits, along, left = encode(x, rotations)
            packed = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("vec_id"), batch.column("label"), packed(x),
                packed(bits), packed(along), packed(left),
                pa.array(np.sqrt((x.astype(float) ** 2).sum(axis=1))),
            ], names=["row", "vec_id", "label", "x", "codes", "along", "left", "length"])

    named = whole.withColumn("row", F.xxhash64("vec_id", "label", "x"))
    return stage(named.mapInArrow(each, _CODED)), width


def _paired(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], each, schema: str) -> DataFrame:
    """``each(anchors, rows)`` for every block of anchors and block of rows.

    Blocks are dealt by the rows' hashes, and their numbers follow from counted rows, so
    a task holds two blocks of bounded size whatever the labels and vectors are.
    """
    a, r = blocks
    by_row = rows.withColumn("rb", F.pmod(F.xxhash64("row"), F.lit(r))).withColumn(
        "ab", F.explode(F.sequence(F.lit(0), F.lit(a - 1))))
    by_anchor = anchors.withColumn("ab", F.pmod(F.xxhash64("row"), F.lit(a)).cast("int")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(r - 1).cast("long"))))
    return by_anchor.groupBy("ab", "rb").cogroup(by_row.groupBy("ab", "rb")).applyInArrow(each, schema)


def mine(
    vectors: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, scale: int = 256, codes: int = CODES, planes: int = PLANES,
    block_anchors: int = ANCHORS, block_rows: int = ROWS, seed: int = SEED,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchors`` says of a row of (vec_id, label) whether it is an anchor.  Scores are
    products of vectors as whole numbers ``floor(scale * x)``.  An anchor's positives are
    its first ``positives`` other rows of its label; each has the first ``negatives`` rows
    of another label that score ``low`` to ``high`` per cent of the positive's score.
    Higher scores come first, smaller ids break ties.  A positive without such rows gives
    none, as do an empty table and one label alone.  Rows that repeat an id with another
    vector or label are rows of their own.
    """
    spark = vectors.sparkSession
    rows, width = coded(vectors, scale=scale, codes=codes, seed=seed)
    chosen = stage(rows.filter(anchors).select("row", "vec_id", "label", "x"))
    blocks = (max(1, -(-chosen.count() // block_anchors)), max(1, -(-rows.count() // block_rows)))
    importable(spark)

    def opened(part: pa.Table, rotations: np.ndarray) -> Iterator[tuple[int, int, int, _Anchor]]:
        for row, vec_id, label, x in zip(*(part.column(c).to_pylist() for c in ("row", "vec_id", "label", "x"))):
            yield row, vec_id, label, _Anchor(np.frombuffer(x, np.int64), rotations, planes)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            block = Block(right, width, codes)
            by_label = {label: np.flatnonzero(block.label == label) for label in np.unique(block.label)}
            for row, vec_id, label, anchor in opened(left, _rotations(width, codes, seed)):
                at = by_label.get(label, np.zeros(0, np.int64))
                at = at[(block.row[at] != row) | (block.vec_id[at] != vec_id)]
                if len(at):
                    found, scores = nearest(block, at, anchor, positives)
                    for column, values in zip(out, ([row] * len(found), block.vec_id[found], block.row[found], scores)):
                        column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["row", "id", "other", "score"])

    first = Window.partitionBy("row").orderBy(F.desc("score"), "id", "other")
    liked = stage(
        _paired(rows, chosen, blocks, find_positives, "row long, id long, other long, score long")
        .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("liked"))
    )
    asked = stage(
        chosen.join(liked, "row").select("row", "vec_id", "label", "x", "liked.id", "liked.score"))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], [], []]
        if left.num_rows and right.num_rows:
            block = Block(right, width, codes)
            by_label = {label: np.flatnonzero(block.label != label) for label in np.unique(block.label)}
            whole = np.arange(len(block.label))
            ids, scores = left.column("id").to_pylist(), left.column("score").to_pylist()
            for i, (row, vec_id, label, anchor) in enumerate(opened(left, _rotations(width, codes, seed))):
                bands = [(-((-low * s) // 100), (high * s) // 100) for s in scores[i]]
                found = within(block, by_label.get(label, whole), anchor, bands, negatives)
                for place, (at, own) in enumerate(found):
                    n = len(at)
                    for column, values in zip(out, (
                        [row] * n, [vec_id] * n, [place] * n, [ids[i][place]] * n, [scores[i][place]] * n,
                        block.vec_id[at], own,
                    )):
                        column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=[
            "row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"])

    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        _paired(rows, asked, blocks, find_negatives, (
            "row long, anchor_id long, place long, positive_id long, positive_score long, "
            "negative_id long, negative_score long"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
