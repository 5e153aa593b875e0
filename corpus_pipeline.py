"""The corpus pipeline: documents through language, copies, secrets, mixing and encoding.

Each stage takes (spark, docs, sf_dir) and returns rows that are written as Parquet and
read again as the next one's docs.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.llm import jaccard, language, mixing, pieces, secrets
from cohortia.llm.common import held_out, stage
from cohortia.llm.queries import piece_model


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts in a known language; texts without a letter go."""
    return language.known(docs, language.learn(docs.filter(~held_out(F.col("doc_id"), 5))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, by shingles of five words at 0.8."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mask; all documents stay."""
    training = docs.filter(~held_out(F.col("doc_id"), 5))
    words = secrets.dictionary(training)
    return secrets.masked(docs, secrets.learn(training, words), words)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target wants."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, as digests."""
    return pieces.digests(pieces.encode_decode(docs, piece_model()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("mix", mix),
    ("encode", encode),
]

#: No stage but the mixing can be said in SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
