from collections import Counter

from cohortia.llm import mixing
from tests.llm import samples


def targets_by_hand(sizes):
    """Share again until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.remove(s)
        left -= sum(out[s] for s in over)
    return out


def check(rows, docs, near):
    text = {}
    for d in docs:
        text.setdefault((d["doc_id"], d["source"]), []).append(len((d["text"] or "").encode().split()))
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] in text[r["doc_id"], r["source"]]
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    want = targets_by_hand(sizes)
    for source, size in want.items():
        assert abs(target[source] - size) <= 1e-9 * max(size, 1)
        assert abs(taken[source] - size) <= near(source)


def test_documents(spark):
    docs = samples.documents(spark, "sf0.01")
    found = mixing.mix(docs)
    rows = found.collect()
    check(rows, docs.collect(), lambda source: 120)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)


def test_rates_tilt_exponentially(spark):
    texts = ["w " * (i % 37 + 1) for i in range(300)]
    docs = samples.docs(spark, texts, sources=[["a", "b", "c"][i % 3] for i in range(300)])
    sized = mixing.sizes(docs)
    targets = mixing.source_targets(sized)
    import math
    size_of = {}
    for r in sized.collect():
        size_of.setdefault(r["source"], []).append(r["size"])
    names = {r["k"]: (r["source"], r["target"]) for r in targets.collect()}
    for r in mixing.tilts(sized, targets).collect():
        source, target = names[r["k"]]
        if r["tilt"] is None:
            assert target == 2 * sum(size_of[source])
        else:
            taken = sum(n * min(2, math.exp(r["tilt"] * n / r["scale"])) for n in size_of[source])
            assert abs(taken - target) < 1e-6 * target


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    rows = mixing.mix(docs)
    check(rows.collect(), docs.collect(), lambda source: 40_000)
    assert rows.count() == docs.count()
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in rows.collect():
        copies[r["doc_id"], r["source"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"]) for r in mixed.collect())
    assert got == +copies
    assert mixing.mix(samples.empty(spark)).count() == 0
    assert mixing.mixed(samples.empty(spark)).count() == 0
