import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_brute_force(rows, anchor, positives=5, negatives_=3):
    good = {}
    for vec_id, v, label in rows:
        if vec_id is not None and label is not None and v is not None and all(
            x is not None and np.isfinite(x) for x in v
        ):
            good[vec_id, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = None
    out = []
    for me in good:
        if not anchor(me[0]):
            continue
        scored = [(-sum(a * b for a, b in zip(me[2], r[2])), r[0], r[1]) for r in good if r != me]
        for score, positive, _ in sorted(s for s in scored if s[2] == me[1])[:positives]:
            inside = sorted(
                s for s in scored if s[2] != me[1] and 50 * -score <= 100 * -s[0] <= 95 * -score)
            out += [(me[0], positive, rank + 1, n, -score, -s)
                    for rank, (s, n, _) in enumerate(inside[:negatives_])]
    return sorted(out)


def clustered(seed, n, size=24):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, size))
    return [
        (i, [float(np.float32(x)) for x in centres[i % 6] * random.uniform(0, 1) + random.normal(size=size)],
         int(random.integers(0, 4)))
        for i in range(n)
    ]


@pytest.mark.parametrize("blocks", [{}, {"block_anchors": 3, "block_rows": 40}])
def test_equals_brute_force(spark, blocks):
    rows = clustered(1, 260)
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(120)]  # one vector holds a third of all
    rows += [(2000 + i, [0.25] * 24, 1) for i in range(6)] + [rows[0], rows[50]]
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, **blocks)
    assert sorted(map(tuple, found.collect())) == by_brute_force(rows, lambda i: i % 10 == 0)


def test_wide_vectors(spark):
    rows = clustered(2, 120, size=150)
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == by_brute_force(rows, lambda i: i % 10 == 0)


def test_intervals_hold_the_scores_and_spare_most_rows():
    random = np.random.default_rng(3)
    x = np.floor(256 * random.normal(size=(3_000, 64))).astype(np.int64)
    x[:40] = 0
    rotations = negatives._rotations(64, negatives.CODES, 1)
    codes, along, left = negatives.encode(x, rotations)
    block = negatives.Block.__new__(negatives.Block)
    block.x, block.codes, block.along, block.left = x, codes, along, left
    block.ones = np.bitwise_count(codes).sum(axis=2).astype(float)
    block.row = block.vec_id = np.arange(len(x))
    block.length = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    for i in (0, 50, 51, 52):
        anchor = negatives._Anchor(x[i], rotations, negatives.PLANES)
        at, scores = np.arange(len(x)), x @ x[i]
        walk = block.intervals(at, anchor, 64)
        low, high = next(walk)
        widths = []
        for code in range(negatives.CODES):
            assert (low <= scores).all() and (scores <= high).all()
            widths.append((high - low)[at != i].mean())
            try:
                low, high = walk.send(np.ones(len(x), bool))
            except StopIteration:
                assert code == negatives.CODES - 1
        assert widths[-1] <= 0.15 * widths[0] + 1
        scored = []
        block.scores = lambda at, anchor: scored.append(len(at)) or x[at] @ anchor.x
        negatives.nearest(block, at[at != i], anchor, 5)
        if i:
            assert scored[0] < 0.05 * len(x)  # the others are dropped by their intervals
        del block.scores


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 1.0], 1), (10, None, 1), (10, [], 1),
        (20, [nan, 1.0], 1), (20, [inf, 1.0], 1), (20, [None, 1.0], 1), (None, [1.0, 2.0], 1),
        (30, [1.0, 1.0], None), (31, [1.0, 2.0], 1), (32, [1.0], 2), (33, [0.5, 1.0], 2),
        (34, [0.5, 1.0], 2), (40, [0.0, 0.0], 2), (50, [-1.0, 0.0], 2),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS row", "2 AS ab", "3 AS x", "4 AS score", "5 AS place")
    # an id with two vectors is two rows; short vectors count as filled up with zeros
    padded = [(i, v if v is None else v + [0.0] * (2 - len(v)), label) for i, v, label in rows]
    found = negatives.mine(frame, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, found)) == by_brute_force(padded, lambda i: i % 10 == 0)


def test_nothing_to_find(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
    alone = [(i, [1.0, float(i)], 7) for i in range(30)]
    assert negatives.mine(spark.createDataFrame(alone, SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
