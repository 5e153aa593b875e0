import random
from hashlib import sha256

from cohortia.llm import pieces
from cohortia.llm.queries import piece_model
from tests.llm import samples

PARTS = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "日", "🙂", "　", "​", "the ", "12", " ▁ ", "\0", "\r", "<s>", "ﬁ"]


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def texts():
    draw = random.Random(1)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 9))) for _ in range(3000)]


def test_equals_the_library(monkeypatch):
    own = library()
    monkeypatch.setattr(pieces, "WORDS_KEPT", 50)  # the table is emptied again and again
    table = pieces.WordTable(piece_model())
    assert table.separable
    for at in range(0, 3000, 100):
        part = texts()[at:at + 100]
        for text, (ids, decoded) in zip(part, table.rows_of(part)):
            assert ids.tolist() == own.encode(text)
            assert decoded == own.decode(own.encode(text))


def test_whole_texts_where_words_cannot_stand_alone():
    table, own = pieces.WordTable(piece_model()), library()
    table.separable = False
    part = texts()[:200]
    assert [(ids.tolist(), text) for ids, text in table.rows_of(part)] == [
        (own.encode(t), own.decode(own.encode(t))) for t in part]


def test_documents(spark):
    own = library()
    docs = samples.documents(spark)
    rows = {r["doc_id"]: r for r in pieces.digests(pieces.encode_decode(docs, piece_model())).collect()}
    for doc in docs.collect():
        ids = own.encode(doc["text"])
        row = rows[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == sha256(own.decode(ids).encode()).hexdigest()


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    encoded = pieces.encode_decode(docs, piece_model())
    own, found = library(), encoded.collect()
    text = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert len(found) == docs.count()
    assert {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found} == {
        (i, tuple(own.encode(t or "")), own.decode(own.encode(t or ""))) for i, t in text}
    empty = [r for r in pieces.digests(encoded).collect() if r["doc_id"] in (0, 1)]
    assert all(r["n_tokens"] == 0 and r["ids_sha256"] == sha256(b"").hexdigest() for r in empty)
    assert pieces.encode_decode(samples.empty(spark), piece_model()).count() == 0
