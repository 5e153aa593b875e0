import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import __spark_entry__ as entry_points
import corpus_pipeline
import pytest

from cohortia.llm import secrets
from cohortia.llm.common import stage
from tests.llm import samples
from tests.llm.test_jaccard import components_of, sets_of
from tests.llm.test_mixing import targets_by_hand
from tests.llm.test_pieces import library
from tests.llm.test_secrets import made


def through(spark, docs, sf_dir):
    kept = {"documents": docs}
    for name, apply in corpus_pipeline.STAGES:
        docs = kept[name] = stage(apply(spark, docs, sf_dir))
    return kept


def test_stages_take_effect(spark):
    docs = samples.documents(spark).union(samples.docs(spark, ["123 456", None, ""], ids=[9001, 9002, 9003]))
    kept = through(spark, docs, samples.SF)
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert kept[name].columns == docs.columns
    ids = {name: {r["doc_id"] for r in frame.select("doc_id").collect()} for name, frame in kept.items()}
    assert ids["documents"] - ids["language_id"] == {9001, 9002, 9003}
    assert ids["mask_secrets"] == ids["near_duplicates"] and ids["mix"] <= ids["mask_secrets"]
    assert kept["encode"].count() == kept["mix"].count() > 0
    assert kept["near_duplicates"].count() == len(ids["near_duplicates"]) < len(ids["language_id"])


def test_run_is_the_stages(spark):
    ran = corpus_pipeline.run(spark, samples.SF).collect()
    assert ran and ran[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def letter_grams(text):
    """The n-grams of a text's words, as often as they are there."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return Counter(
        gram for word in words for padded in [f" {word} "]
        for gram in [*word, *(padded[i:i + 2] for i in range(len(padded) - 1)),
                     *(padded[i:i + 3] for i in range(len(padded) - 2))])


def in_known_language(docs):
    """Rows that share an n-gram with the 300 most frequent ones of a language learnt."""
    learnt = {}
    for row in docs:
        if row["lang"] is not None and crc32(str(row["doc_id"]).encode()) % 5:
            learnt.setdefault(row["lang"], Counter()).update(letter_grams(row["text"]))
    profile = {gram for counts in learnt.values() for gram, _ in counts.most_common(300)}
    return [row for row in docs if letter_grams(row["text"]).keys() & profile]


def first_of_each_group(docs):
    """The row of the least id among near copies: five words, four fifths of the shingles."""
    docs = sorted(docs, key=lambda row: row["doc_id"])
    root = components_of(sets_of([row["text"] for row in docs], 5), 80)
    return [row for i, row in enumerate(docs) if root[i] == i]


def test_run_equals_the_stages_by_hand(spark, tmp_path, monkeypatch):
    odd = samples.docs(
        spark, ["123 456", None, "", "日本語 文字", "a b c d e f g h i j", "A b  c d e f g h i j"],
        ids=range(9001, 9007))
    texts, hidden = made(160)
    planted = samples.docs(spark, texts, ids=range(9100, 9260), sources=["code"] * 160)
    samples.documents(spark).select(odd.columns).union(odd).union(planted).write.parquet(f"{tmp_path}/documents.parquet")
    given = {}

    def noted(name, apply):
        def stage_(spark, docs, sf_dir):
            given[name] = docs
            return apply(spark, docs, sf_dir)
        return name, stage_

    monkeypatch.setattr(corpus_pipeline, "STAGES", [noted(*s) for s in corpus_pipeline.STAGES])
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs, known, distinct, masked, taken = (given[name].collect() for name, _ in corpus_pipeline.STAGES)

    def same(rows, want):
        return sorted(map(tuple, rows), key=str) == sorted(map(tuple, want), key=str)

    assert same(known, in_known_language(docs))
    assert {row["doc_id"] for row in docs} - {row["doc_id"] for row in known} == {9001, 9002, 9003, 9004}
    assert same(distinct, first_of_each_group(known)) and len(distinct) < len(known)

    # masks stand for the findings called secret and for nothing else
    words = secrets.dictionary(training_rows(given["mask_secrets"]))
    forest = secrets.learn(training_rows(given["mask_secrets"]), words)
    secret = {}
    for row in secrets.findings(given["mask_secrets"], forest, words).filter("is_secret").collect():
        secret.setdefault(row["doc_id"], Counter())[row["candidate_sha256"]] += 1
    after = {row["doc_id"]: row for row in masked}
    assert after.keys() == {row["doc_id"] for row in distinct}
    for at, value in enumerate(hidden):
        if value:
            assert after[9100 + at]["text"] == texts[at].replace(value, secrets.MASK)
    for row in distinct:
        now = after[row["doc_id"]]
        assert now.asDict() | {"text": None} == row.asDict() | {"text": None}
        around = "(.+?)".join(map(re.escape, now["text"].split(secrets.MASK)))
        gone = re.fullmatch(around, row["text"], re.DOTALL).groups()
        assert Counter(sha256(x.encode()).hexdigest() for x in gone) == secret.get(row["doc_id"], Counter())

    # no row is changed or taken more than twice, and sources come near their targets
    copies = Counter(map(tuple, taken))
    assert set(copies) <= set(map(tuple, masked)) and max(copies.values()) <= 2
    sizes, words_taken, largest = Counter(), Counter(), Counter()
    for row in masked:
        size = len(row["text"].encode().split())
        sizes[row["source"]] += size
        words_taken[row["source"]] += size * copies[tuple(row)]
        largest[row["source"]] = max(largest[row["source"]], size)
    for source, target in targets_by_hand(sizes).items():
        assert abs(words_taken[source] - target) <= largest[source]

    own = library()
    want = []
    for row in taken:
        ids = own.encode(row["text"])
        want.append((row["doc_id"], len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     sha256(own.decode(ids).encode()).hexdigest()))
    assert same([(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found], want)


def training_rows(docs):
    return docs.filter("crc32(CAST(doc_id AS STRING)) % 5 <> 0")


@pytest.mark.parametrize("make", [samples.awkward, samples.empty])
def test_awkward_rows(spark, make):
    kept = through(spark, make(spark), samples.SF)
    assert kept["mix"].columns == kept["documents"].columns


def test_registered():
    names = entry_points.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names
