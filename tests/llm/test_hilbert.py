import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import hilbert, queries
from tests.llm import samples


@pytest.mark.parametrize("dimensions, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    places = hilbert.index(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_running_sums(spark):
    random = np.random.default_rng(1)
    rows = [(int(random.integers(0, 3)), i, int(random.integers(0, 9))) for i in range(400)]
    frame = spark.createDataFrame(rows, "k long, i long, w long").repartition(7)
    got = {r["i"]: r["before_w"] for r in hilbert.running(frame, ["k", "i"], ["w"]).collect()}
    so_far = 0
    for _, i, w in sorted(rows):
        assert got[i] == so_far
        so_far += w


def test_cuts_follow_the_distribution(spark):
    values = [None] * 10 + ["a"] * 60 + ["b"] * 10 + ["c"] * 20
    frame = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "s string, x double")
    found = hilbert.cuts(frame, ["s", "x"], 3)
    # middles at 40, 75 and 90 of 100 rows; a number for every eighth of distinct values
    assert found["s"] == [("a", 3), ("b", 6), ("c", 7)]
    assert [cell for _, cell in found["x"]] == list(range(8))
    assert [least for least, _ in found["x"]] == [0.0, 13.0, 25.0, 38.0, 50.0, 63.0, 75.0, 88.0]


def by_hand(docs, shards):
    """The shards of collected rows by plain Python, from the same cuts."""
    quantised = []
    for name, value in (
        ("source", lambda d: d["source"]), ("lang", lambda d: d["lang"]),
        ("size", lambda d: len((d["text"] or "").encode()) + 1),
    ):
        known = sorted(value(d) for d in docs if value(d) is not None)
        missing = len(docs) - len(known)
        numbers, at = {None: 0}, missing
        for v, same in itertools.groupby(known):
            n = len(list(same))
            numbers[v] = (at + n // 2) * 256 // len(docs)
            at += n
        quantised.append([numbers[value(d)] for d in docs])
    places = hilbert.index(np.array(quantised).T, 8)
    crc = [zlib.crc32((d["text"] or "").encode()) for d in docs]
    order = sorted(range(len(docs)), key=lambda i: (places[i], crc[i], docs[i]["doc_id"]))
    out, at = {}, 0
    for shard in range(shards):
        n = len(docs) // shards + (shard < len(docs) % shards)
        for slot, i in enumerate(order[at:at + n]):
            out[docs[i]["doc_id"]] = (crc[i], shard, slot)
        at += n
    return out


def test_query_equals_brute_force(spark):
    docs = samples.documents(spark).collect()
    got = queries.op11_hilbert_shards(spark, samples.SF).collect()
    want = by_hand(docs, 16)
    assert {r["doc_id"]: (r["text_crc32"], r["shard"], r["slot"]) for r in got} == want
    assert len(got) == len(docs) and {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def slots_are_gapless(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    return [len(s) for s in by_shard.values()]


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_laws_under_a_hot_source_and_copies(spark, law):
    texts = ["same text"] * 500 + [f"text {i} " * (i % 40) for i in range(700)]
    frame = samples.docs(spark, texts, sources=["hot"] * 900 + [f"s{i % 9}" for i in range(300)])
    rows = hilbert.place(frame, law=law).collect()
    counts = slots_are_gapless(rows)
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    copies = sorted((r["shard"], r["slot"]) for r in rows if r["text"] == "same text")
    assert len({s for s, _ in copies}) <= -(-500 // min(counts)) + 1  # copies lie together


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_awkward_rows(spark, law):
    frame = samples.awkward(spark)
    placed = hilbert.place(frame, law=law)
    rows = placed.collect()
    assert len(rows) == frame.count() and placed.columns.count("size") == 1
    slots_are_gapless(rows)
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), law)
        assert 0 <= r["shard"] < 16
    assert hilbert.place(samples.empty(spark), law=law).count() == 0


def test_unknown_law(spark):
    with pytest.raises(ValueError):
        hilbert.place(samples.empty(spark), law="luck")


def test_written_shards_prune_every_dimension(spark, tmp_path):
    docs = samples.documents(spark, "sf0.01")
    ranges = hilbert.write_shards(docs, str(tmp_path / "curve")).collect()
    by_size = hilbert.write_shards(docs, str(tmp_path / "line"), dimensions=["size"])
    line = hilbert.manifest(spark.read.parquet(str(tmp_path / "line"))).collect()
    assert sum(r["rows"] for r in ranges) == sum(r["rows"] for r in by_size.collect()) == docs.count()

    def read(shards, name, value):
        return sum(r[f"least_{name}"] <= value <= r[f"most_{name}"] for r in shards)

    langs = [r["lang"] for r in docs.select("lang").distinct().collect()]
    sources = [r["source"] for r in docs.select("source").distinct().collect()]
    for name, values in (("lang", langs), ("source", sources)):
        own = sum(read(ranges, name, v) for v in values)
        assert own < 0.75 * sum(read(line, name, v) for v in values)
    sizes = [r["size"] for r in docs.select((F.octet_length("text") + 1).alias("size")).collect()]
    assert sum(read(ranges, "size", v) for v in sizes) < 0.75 * 16 * len(sizes)
