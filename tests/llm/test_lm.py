import math
from collections import Counter

import numpy as np
import pytest

from cohortia.llm import lm
from cohortia.llm.common import held_out
from pyspark.sql import functions as F
from tests.llm import samples


def scored(docs, **settings):
    return lm.scores(docs.select("doc_id", held_out(F.col("doc_id"), 10).alias("held"), "text"), **settings)


def check_counts(rows, docs):
    """Everything but the model's score, by brute force."""
    import zlib
    token = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in docs}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in token}
    counts = Counter(x for i, own in token.items() if not out[i] for x in own)
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        own = token[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[r["doc_id"]], len(own), total)
        assert r["n_known"] == sum(counts[x] > 0 for x in own)
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_counts_and_base(spark, monkeypatch):
    texts = samples.prose(2, 150, words=900) + [None, "", "Never-seen WORDS here"]
    docs = list(enumerate(texts))
    monkeypatch.setattr(lm, "BLOCK", 500)
    monkeypatch.setattr(lm, "HELD_WORDS", 100)
    frame = samples.docs(spark, texts).repartition(3)
    small, full = scored(frame, vocabulary=40).collect(), scored(frame).collect()
    for rows in (small, full):
        check_counts(rows, docs)
        assert all(r["score"] <= 0 for r in rows)


def test_model_beats_single_words_on_held_out_texts(spark):
    rows = scored(samples.documents(spark, "sf0.01")).filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 0.95
    again = scored(samples.documents(spark, "sf0.01")).filter("held_out").collect()
    assert sorted((r["doc_id"], r["score"]) for r in rows) == sorted((r["doc_id"], r["score"]) for r in again)


def test_probabilities_add_up():
    random = np.random.default_rng(0)
    customers = random.integers(0, 200, 30)
    parent = lm.seat_parent(customers, 0.7)
    assert np.allclose(parent.probabilities.sum(axis=1), 1)
    words = np.arange(30)
    own = random.integers(0, 90, 30)
    keys = 5 << lm.SHIFT | words[own > 0]
    samples_ = list(lm._seated(keys, own[own > 0], parent, (1,), lm.SAMPLES))
    tables = np.zeros(30, np.int64)
    tables[own > 0] = sum(samples_)
    contexts = lm.Contexts(
        np.full(8, own.sum()), np.stack([np.full(8, t.sum()) for t in samples_]))
    p = 10 ** lm.log_probabilities(np.full(30, 5), words, own, tables, contexts, parent)
    assert p.sum() == pytest.approx(1)


def test_gibbs_conditional_by_enumeration():
    """One dish of three customers: seatings counted by hand."""
    d, strength, p = 0.6, 1.5, 0.3
    weight = {1: (1 - d) * (2 - d), 2: 3 * (1 - d), 3: 1.0}
    for t in weight:
        weight[t] *= math.prod(p * (strength + d * i) for i in range(t))
    want = np.array([weight[t] for t in (1, 2, 3)])
    n = 40_000
    drawn = lm.sweep(np.full(n, 3), np.ones(n, np.int64), np.arange(n), np.full(n, p), n, d, strength,
                     np.random.default_rng(1))
    got = np.bincount(drawn, minlength=4)[1:] / n
    assert np.allclose(got, want / want.sum(), atol=0.01)


def test_packing():
    random = np.random.default_rng(1)
    for values in ([], [0], [255], [256, 1], [2**62], random.integers(0, 2**40, 999)):
        values = np.array(values, np.int64)
        assert np.array_equal(lm.unpack(lm.pack(values)), values)
        assert np.array_equal(lm.unpack_sorted(lm.pack_sorted(np.sort(values))), np.sort(values))


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    rows = scored(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_tokens"] == 1 and by_id[1]["score"] == by_id[0]["score"]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert scored(samples.empty(spark)).count() == 0
    untaught = lm.scores(docs.select("doc_id", F.lit(True).alias("held"), "text")).collect()
    assert {r["train_tokens"] for r in untaught} == {0} and {r["n_known"] for r in untaught} == {0}


def test_pairs_of_all_words_are_learnt(spark):
    """However few words are named: the pairs of the others are counted as well."""
    frame = samples.docs(spark, samples.prose(3, 200, words=900)).repartition(3)
    by_id = [{r["doc_id"]: r["score"] for r in scored(frame, vocabulary=n).collect()} for n in (2, 5_000)]
    assert by_id[0] == by_id[1]


def test_restaurants_in_parts(spark, monkeypatch):
    """Contexts dealt over the buckets: the same customers, other draws."""
    frame = samples.docs(spark, samples.prose(5, 400, words=30)).repartition(3)
    whole = {r["doc_id"]: r["score"] for r in scored(frame).collect()}
    monkeypatch.setattr(lm, "DEALT", 50)
    parts = {r["doc_id"]: r["score"] for r in scored(frame).collect()}
    assert whole != parts
    assert sum(parts.values()) == pytest.approx(sum(whole.values()), rel=0.01)
