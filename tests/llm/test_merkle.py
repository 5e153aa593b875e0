import random
from hashlib import sha256

from cohortia.llm import merkle
from tests.llm import samples


def test_fingerprints_tell_texts_apart():
    texts = list(dict.fromkeys(samples.prose(1, 200))) + ["", "a", "a ", "a\n", "a.\nb.", "a.b.\n"]
    texts = list(dict.fromkeys(texts))
    prints = [merkle.fingerprint(t) for t in texts]
    assert len({p.split("/")[0] for p in prints}) == len(texts)
    assert prints == [merkle.fingerprint(t) for t in texts]
    for text in texts:
        assert b"".join(merkle.paragraphs(text)).decode() == text


def test_likeness_and_differing_spans():
    text = " ".join(f"This is sentence number {i}, of many." for i in range(400))
    edited = text.replace("number 200,", "number two hundred,")
    one, other = merkle.fingerprint(text), merkle.fingerprint(edited)
    assert merkle.likeness(one, one) == 1 and merkle.likeness(merkle.fingerprint(""), one) == 0
    assert 0.97 < merkle.likeness(one, other) < 1
    spans = merkle.differing(one, other)
    at = text.index("number 200,")
    assert any(a <= at < b for a, b in spans) and sum(b - a for a, b in spans) < 500
    assert merkle.differing(one, one) == []


def by_hand(rows):
    """Report of (doc_id, text) with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        prints = [merkle.fingerprint(t) for t in (text, edited, after)]
        out[i] = (len(text), sha256(edited.encode()).hexdigest(), prints[0], prints[1],
                  merkle.likeness(*prints[:2]), merkle.likeness(prints[0], prints[2]))
    return out


def test_report_equals_brute_force(spark):
    texts = samples.prose(6, 120) + [None, "", "é日本🙂" * 9]
    ids = [i * 7919 % 100_003 - 50_000 for i in range(len(texts))]
    frame = samples.docs(spark, texts, ids=ids).repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in merkle.edit_report(frame).collect()}
    assert got == by_hand(zip(ids, texts))


def test_large_ids_and_a_single_row(spark):
    ids = [2**62 + i for i in range(6)] + [-(2**62)]
    texts = [f"text {i}" for i in range(7)]
    got = {r["doc_id"]: tuple(r)[1:] for r in merkle.edit_report(samples.docs(spark, texts, ids=ids)).collect()}
    assert got == by_hand(zip(ids, texts))
    (row,) = merkle.edit_report(samples.docs(spark, ["abcd"])).collect()
    assert row["edited_sha256"] == sha256(b"abab").hexdigest() and row["near_next"] == 1


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    rows = merkle.edit_report(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert merkle.edit_report(samples.empty(spark)).count() == 0
    assert merkle.edit_report(docs.filter("doc_id IS NULL")).count() == 2
    assert merkle.fingerprints(docs).count() == docs.count()


def test_unbroken_text_is_cut_by_content():
    draw = random.Random(3)
    for alphabet in ("\u65e5\u672c\u8a9e\u6587\u7ae0\u4e2d\u56fd\u5b57", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef0123456789+/"):
        text = "".join(draw.choices(alphabet, k=4_000))
        leaves = merkle.paragraphs(text)
        assert b"".join(leaves) == text.encode() and len(leaves) > 30
        edited = text[:2_000] + "#" + text[2_000:]
        changed = set(merkle.paragraphs(edited)) ^ set(leaves)
        assert 0 < len(changed) <= 6
        half = text[:2_000] + "".join(draw.choices(alphabet, k=2_000))
        assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(half)) > 0.3
