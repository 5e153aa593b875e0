"""Small tables that hold the awkward cases."""

import os
import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 8_000


def documents(spark, name="sf0.001"):
    return spark.read.parquet(os.path.join("/root/testdata", name, "documents.parquet"))


def docs(spark, texts, **columns):
    """Texts as documents with ids from 0; ``columns`` as lists."""
    n = len(texts)
    ids, langs = columns.get("ids", range(n)), columns.get("langs", ["en"] * n)
    sources = columns.get("sources", ["a"] * n)
    rows = [(i, t, l, s, None if t is None else len(t))
            for i, t, l, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    texts = [
        None, "", " \t\n", "one", "one", "two words", "1234 5678", LONG, LONG, "é日本🙂 ▁ x  y ",
        'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" end', None, "A b c d e f g h",
    ]
    ids = [0, 1, 2, 3, 3, 4, 5, 6, 7, None, 8, None, 9]
    frame = docs(
        spark, texts, ids=ids, langs=[None, "en", "fr"] * 4 + ["en"],
        sources=["a", None, "b", "a", "a", "b", "c", "a", "b", None, "c", "d", "ß"],
    )
    clash = ("score", "size", "copies", "k", "c", "row", "th", "llm_parts", "part", "component_id")
    return frame.withColumns({name: F.lit(i) for i, name in enumerate(clash)})


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed, n, words=400):
    """Texts of made-up words, with copies, near copies and shared passages."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdeilnorst", k=draw.randint(2, 8))) for _ in range(words)]
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.15:
            texts.append(draw.choice(texts))
        elif texts and kind < 0.5:
            own = draw.choice(texts).split(" ")
            for _ in range(draw.randint(1, 3)):
                if own:
                    own[draw.randrange(len(own))] = draw.choice(vocabulary)
            texts.append(" ".join(own))
        else:
            texts.append(" ".join(draw.choices(vocabulary, k=draw.randint(1, 90))))
    return texts
