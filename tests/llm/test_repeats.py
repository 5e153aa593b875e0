import random
from hashlib import sha256

from cohortia.llm import repeats
from tests.llm import samples


def by_hand(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, sha256(kept).hexdigest()))
    return out


def strings(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(60):
        letters = draw.choice(["a", "ab", "abcdefghijklmnop", "éa日"])
        own = "".join(draw.choices(letters, k=draw.randint(0, 150)))
        if texts and draw.random() < 0.6:
            other = draw.choice(texts) or ""
            a = draw.randint(0, len(other))
            own = own[:40] + other[a:a + draw.randint(0, 120)] + own[40:]
        texts.append(own)
    return texts + [None, "", texts[3], "ab" * 200, "x" * 19, "x" * 20, "y" * 21]


def test_matching_statistics_equal_brute_force():
    draw = random.Random(3)
    for trial in range(120):
        letters = draw.choice(["ab", "abc", "abcdefgh"])
        texts = ["".join(draw.choices(letters, k=draw.randint(1, 40))).encode() for _ in range(draw.randint(1, 6))]
        if trial % 3 == 0:
            texts += [texts[0] + b"zz" + texts[0], b"a" * 30]
        starts = [(t, i) for t, text in enumerate(texts) for i in range(len(text))]
        got = repeats.matching_statistics(texts)

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        for t, i in starts:
            want = max((common(texts[t][i:], texts[u][j:]) for u, j in starts if (u, j) != (t, i)), default=0)
            assert got[t][i] == want


def test_spans_cover_every_start():
    draw = random.Random(1)
    for _ in range(50):
        data = bytes(draw.choices(b"abc", k=draw.randint(0, 300)))
        found = repeats.spans(data, 20, 4)
        starts = [i for _, a, b, _ in found for i in range(a, b + 1)]
        assert starts == list(range(max(len(data) - 19, 0)))
        for order, gram in ((0, 4), (1, 4), (2, 4), (3, 20)):
            key = {}
            for k, a, b, many in repeats.spans(data, 20, gram, order):
                own = [data[i:i + 20] for i in range(a, b + 1)]
                assert many or len(set(own)) == len(own)
                assert all(key.setdefault(string, k) == k for string in own)
            assert gram < 20 or len(set(key.values())) == len(key)


def test_heavy_keys_are_divided(spark, monkeypatch):
    # a line that all texts hold, longer than a string, between text of their own, numbered
    # within or not; copies; text of one period; rows that repeat id and text
    draw = random.Random(5)
    line = "".join(draw.choices("abcdefghij", k=26))
    texts = []
    for i in range(120):
        own = "".join(draw.choices("klmnopq", k=30))
        texts.append(own[:15] + (line[:13] + f"{i:03}" + line[13:] if i % 3 else line) + own[15:])
    texts += [texts[7], texts[8] + "x", "ab" * 60, "ab" * 50 + "c" * 60]
    docs = samples.docs(spark, texts)
    monkeypatch.setattr(repeats, "BLOCK", 200)
    divided, whole = [], repeats._divided
    monkeypatch.setattr(repeats, "_divided", lambda *a: divided.append(a[-2:]) or whole(*a))
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.digests(repeats.without_repeats(docs, length=20, gram=4)).collect()}
    assert got == dict(enumerate(by_hand(texts, 20)))
    assert divided == [(4, 1), (4, 2), (20, 3)]
    twice = docs.union(docs.filter("doc_id IN (1, 7)"))
    rows = repeats.digests(repeats.without_repeats(twice, length=20, gram=4)).collect()
    again = by_hand(texts + [texts[1], texts[7]], 20)
    ids = [*range(len(texts)), 1, 7]
    assert sorted(tuple(r) for r in rows) == sorted((i, *row) for i, row in zip(ids, again))


def test_copies_are_compared_once(spark, monkeypatch):
    # rows of spans do not grow with the copies of a text, nor with near copies as a whole
    draw = random.Random(11)
    text = "".join(draw.choices("abcdefghij", k=3000))
    near = [text[:1500] + f"<{i}>" + text[1503:] for i in range(30)]
    sorted_out, counts = repeats._sorted_out, []

    def counted(rows):
        counts.append(rows.count())
        return sorted_out(rows)

    monkeypatch.setattr(repeats, "_sorted_out", counted)
    for texts in ([text] * 2, [text] * 40, near):
        rows = repeats.digests(repeats.without_repeats(samples.docs(spark, texts), length=20, gram=4)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in rows} == dict(enumerate(by_hand(texts, 20)))
    assert counts[1] == counts[0] and counts[2] < 4 * counts[0]


def test_division_moves_only_texts_that_hold_a_heavy_key(spark, monkeypatch):
    draw = random.Random(12)
    line = "".join(draw.choices("abcdefghij", k=26))
    texts = ["".join(draw.choices("klmnopq", k=100)) for _ in range(200)]
    texts += ["".join(draw.choices("klmnopq", k=30)) + line + "".join(draw.choices("klmnopq", k=30)) for _ in range(30)]
    monkeypatch.setattr(repeats, "BLOCK", 400)
    with_texts, moved = repeats._with_texts, []
    monkeypatch.setattr(repeats, "_with_texts", lambda docs, wanted: moved.append(docs) or with_texts(docs, wanted))
    rows = repeats.digests(repeats.without_repeats(samples.docs(spark, texts), length=20, gram=8)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == dict(enumerate(by_hand(texts, 20)))
    assert len(moved) > 1  # a division at least, then the index
    assert 30 <= moved[0].count() <= 40


def test_periodic_text_is_cut_into_chunks_of_bounded_size():
    data = b"ab" * 2000
    found = repeats.spans(data, 20, 20)
    cut = list(repeats.chunks(data, found, 20))
    assert [s for *_, own in cut for s in own][0][2:4] == (0, 0)
    assert sum(len(own) for *_, own in cut) == len(found) == len(data) - 19
    assert max(len(own) for *_, own in cut) <= repeats.MOST


def test_planted_passages_at_the_bound(spark):
    # a passage of 399 bytes that two texts hold stays, of 400 and 401 bytes it goes
    draw = random.Random(9)
    texts = []
    for size in (399, 400, 401):
        passage = "".join(draw.choices("abcdefgh ", k=size - 2))
        texts += ["<" + "".join(draw.choices("xyz", k=700)) + f"({passage})" + "".join(draw.choices("uvw", k=300)),
                  "".join(draw.choices("rst", k=500)) + f"({passage})"]
    rows = repeats.digests(repeats.without_repeats(samples.docs(spark, texts))).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert got == dict(enumerate(by_hand(texts, 400)))
    assert [got[i][1] for i in range(6)] == [0, 0, 400, 400, 401, 401]


def test_equals_brute_force(spark, monkeypatch):
    for seed, block in ((1, repeats.BLOCK), (2, 300)):  # the second divides keys
        monkeypatch.setattr(repeats, "BLOCK", block)
        texts = strings(seed)
        rows = repeats.digests(repeats.without_repeats(samples.docs(spark, texts), length=20, gram=4)).collect()
        got = {r["doc_id"]: tuple(r)[1:] for r in rows}
        assert got == dict(enumerate(by_hand(texts, 20)))


def test_production_length(spark):
    texts = samples.prose(8, 60, words=3000)
    rows = repeats.digests(repeats.without_repeats(samples.docs(spark, texts))).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == dict(enumerate(by_hand(texts, 400)))


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    rows = repeats.digests(repeats.without_repeats(docs)).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows}
    n = len(samples.LONG)
    assert got[6] == got[7] == (n, n, 1) and got[0] == (0, 0, 0)
    assert repeats.without_repeats(samples.empty(spark)).count() == 0
