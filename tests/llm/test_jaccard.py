import itertools

import numpy as np

from cohortia.llm import jaccard
from tests.llm import samples


def sets_of(texts, words):
    out = []
    for text in texts:
        own = (text or "").encode().lower().split()
        out.append({tuple(own[i:i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    return out


def components_of(sets, percent):
    root = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root


def test_spanning_links_hold_the_components():
    for seed, percent in itertools.product(range(8), (80, 90)):
        texts = samples.prose(seed, 60, words=60)
        distinct = list(dict.fromkeys(texts))
        own = [jaccard.shingles(t) for t in distinct]
        links = jaccard.spanning_links(own, percent=percent)
        sets = sets_of(distinct, 3)
        root = list(range(len(distinct)))
        for a, b in links:
            assert 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
            ra, rb = root[a], root[b]
            assert ra != rb
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
        assert root == components_of(sets, percent)


def test_equals_brute_force(spark, monkeypatch):
    texts = samples.prose(3, 250, words=120)
    texts += [None, "", " \n", "A b", "a B", "b a", "x", "x", "a b c", "A  B\tC"]
    frame = samples.docs(spark, texts)
    for words, percent, together in ((3, 90, None), (5, 80, 200)):
        if together:  # clusters cut into blocks
            monkeypatch.setattr(jaccard, "TOGETHER", together)
        got = {r["doc_id"]: r for r in jaccard.near_documents(frame, words=words, percent=percent).collect()}
        sets = sets_of(texts, words)
        want = components_of(sets, percent)
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {
            i: (len(sets[i]), want[i]) for i in range(len(texts))}


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    rows = jaccard.near_documents(docs).collect()
    assert len(rows) == docs.count()
    component = {r["doc_id"]: r["component_id"] for r in rows}
    assert component[7] == 6 and component[3] == 3 and component[0] == 0
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # wordless rows stay (two of them without id), one row of each group
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9] and ids.count(None) == 2
    assert jaccard.near_documents(samples.empty(spark)).count() == 0
    assert jaccard.one_of_each(samples.empty(spark)).count() == 0


def test_short_lists_are_the_rarest(spark):
    texts = samples.prose(9, 80, words=80)
    frame = samples.docs(spark, texts).coalesce(1)  # a task shows a class once
    rows = jaccard.described(frame, bits=8)
    docs = {r["doc_id"]: r for r in rows.filter("kind = 0").collect()}
    assert [docs[i]["n"] for i in range(80)] == [len(s) for s in sets_of(texts, 3)]
    levels = jaccard.frequency_sketch(rows, bits=8)
    assert levels.size == 256
    for own in (levels, np.zeros(256, np.uint8)):
        home = {}
        for r in jaccard.short_lists(frame, own, words=3, percent=90).filter("NOT guest").collect():
            assert all((x % (1 << 64)) % jaccard.PARTS == r["part"] for x in r["shingles"]) and len(r["cells"]) == r["width"]
            home.setdefault(r["c"], (r["n"], []))[1].extend(r["shingles"])
        assert home.keys() == {r["c"] for r in docs.values()}
        for n, shown in home.values():
            assert len(set(shown)) == len(shown) == n - -(-9 * n // 10) + 1


def test_lists_hold_together_what_may_link(spark, monkeypatch):
    """The bound never parts a true link, whatever the widths, batches and lengths."""
    texts = samples.prose(12, 150, words=60)
    sets = sets_of(texts, 3)
    want = components_of(sets, 90)
    frame = samples.docs(spark, texts)
    rows = jaccard.described(frame, bits=10).cache()
    class_of = {r["doc_id"]: r["c"] for r in rows.filter("kind = 0").collect()}
    levels = jaccard.frequency_sketch(rows, bits=10)
    own = lambda n, percent: 16 << min(3, int(n) // 25)  # noqa: E731  many guests
    for long_, batch, width in ((20_000, "10000", jaccard.width_of), (20_000, "7", own), (2, "10000", own), (2, "7", own)):
        monkeypatch.setattr(jaccard, "LONG", long_)
        monkeypatch.setattr(jaccard, "width_of", width)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        root = {c: c for c in class_of.values()}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c

        for r in jaccard.candidate_links(frame, levels).collect():
            root[find(r["a"])] = find(r["b"])
        for i, j in itertools.combinations(range(len(texts)), 2):
            if want[i] == want[j]:
                assert find(class_of[i]) == find(class_of[j])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bound_of_the_overlap():
    own = [jaccard.shingles(t) for t in dict.fromkeys(samples.prose(4, 80, words=50))]
    n = np.array([len(x) for x in own])
    for width in (16, 64):
        cells = np.stack([np.bincount((x & np.uint64(width - 1)).astype(int), minlength=width) for x in own])
        for i in range(len(own)):
            near = jaccard.may_link(n[i], cells[i], n, cells, 90)
            for j in range(len(own)):
                shared = len(np.intersect1d(own[i], own[j]))
                if 100 * shared >= 90 * (n[i] + n[j] - shared):
                    assert near[j]


def test_one_of_each_goes_by_links_and_not_by_ids(spark):
    words = "the quick brown fox jumps over a lazy dog near the old river bank at dawn".split()
    near = [" ".join([*words, f"end{i}"]) for i in range(3)]
    other = "an entirely different text that shares not a single shingle with any of them here"
    texts = [near[0], other, near[1], near[2], "x y z", "x y z"]
    frame = samples.docs(spark, texts, ids=[7, 7, 9, None, None, None])
    kept = jaccard.one_of_each(frame, words=5, percent=60).collect()
    # one id on two unrelated texts keeps both; near copies without an id are one group
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, "x y z"), (7, other), (7, near[0])]
    unnamed = samples.docs(spark, near, ids=[None] * 3)
    assert jaccard.one_of_each(unnamed, words=5, percent=60).count() == 1
