import numpy as np
from pyspark.sql import functions as F

from cohortia.llm import language
from cohortia.llm.queries import op1_language_id
from tests.llm import samples


def counts_by_hand(text):
    out = {}
    word_list = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for word in word_list:
        padded = f" {word} "
        grams = [*word, *(padded[i:i + 2] for i in range(len(padded) - 1)),
                 *(padded[i:i + 3] for i in range(len(padded) - 2))]
        for gram in grams:
            out[gram] = out.get(gram, 0) + 1
    return sorted(out.values())


def test_grams_are_those_of_padded_words():
    for text in ("One, two: one!", "a", "à la carte 12 à", "  x  "):
        codes, counts = language.gram_counts(text)
        assert sorted(counts.tolist()) == counts_by_hand(text)
        assert (np.diff(codes) > 0).all()


def test_out_of_place_distance():
    rows = [{"lang": lang, "code": ord(c), "rank": i}
            for lang, word in (("x", "abc"), ("y", "cba")) for i, c in enumerate(word)]
    profiles = language.Profiles.of(rows, 3)
    # the first three n-grams of "aab aab": pairs outweigh nothing, so single letters lead
    own = language._ranked(*language.gram_counts("abc abc"), 3)
    want = []
    for order in ("abc", "cba"):
        rank = {ord(c): i for i, c in enumerate(order)}
        want.append(sum(abs(rank[c] - i) if c in rank else 3 for i, c in enumerate(own.tolist())))
    lang, score = profiles.predict("abc abc")
    assert lang == ("x" if want[0] <= want[1] else "y")
    assert score == 1 - min(want) / 9


def test_held_out_accuracy(spark):
    found = op1_language_id(spark, samples.SF.replace("0.001", "0.01"))
    truth = samples.documents(spark, "sf0.01").select("doc_id", "lang")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 100
    assert np.mean([row["lang_pred"] == row["lang"] for row in rows]) > 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    profiles = language.learn(docs)
    rows = language.predict(docs, profiles).collect()
    assert len(rows) == docs.count()
    by_id = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in rows if row["doc_id"] is not None}
    for id_ in (0, 1, 2, 5):  # null, empty, white space, digits
        assert by_id[id_] == ("und", 0.0)
    kept = language.known(docs, profiles)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [3, 3, 4, 6, 7, 8, 9]
    empty = samples.empty(spark)
    assert language.predict(empty, profiles).count() == 0
    nothing = language.learn(empty)
    assert {r[0] for r in language.predict(docs, nothing).select("lang_pred").collect()} == {"und"}
    assert language.known(docs, nothing).filter(F.col("doc_id") == 3).count() == 2


def test_another_script_is_rejected_and_rare_languages_are_learnt(spark):
    texts = [f"the cat and the dog number {i} are here" for i in range(400)] + ["le chat est sur la table"] * 2
    frame = samples.docs(spark, texts, langs=["en"] * 400 + ["fr"] * 2)
    profiles = language.learn(frame, rows=20)
    assert set(profiles.languages) == {"en", "fr"}
    probe = samples.docs(spark, ["the dog", "le chat", "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0", "12", None])
    assert {r["doc_id"] for r in language.known(probe, profiles).collect()} == {0, 1}
