"""The registered queries of the text operators: thin, with their production settings."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.llm import (
    hilbert, jaccard, language, lattice, lm, merkle, mixing, negatives, pieces, quality, repeats,
    secrets, whitening,
)
from cohortia.llm.common import held_out

PIECE_MODEL = "piece_bpe_32k.model"


def piece_model() -> str:
    """Where the piece vocabulary lies: a setting, or the installed public tokenizers."""
    if "LLM_PIECE_MODEL" in os.environ:
        return os.environ["LLM_PIECE_MODEL"]
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5)
    profiles = language.learn(docs.filter(~out))
    return language.predict(docs, profiles).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    training = docs.filter(~held_out(F.col("doc_id"), 5))
    words = secrets.dictionary(training)
    return secrets.findings(docs, secrets.learn(training, words), words)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.measured(_table(spark, sf_dir, "documents"))
    out = held_out(F.col("doc_id"), 5)
    model = quality.learn(rows.filter(~out), _table(spark, sf_dir, "labels"))
    return quality.score(rows, model).select(
        "doc_id", out.alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(_table(spark, sf_dir, "documents")))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_decode(_table(spark, sf_dir, "documents"), piece_model()))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm.scores(docs.select("doc_id", held_out(F.col("doc_id"), 10).alias("held"), "text"))


def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.place(_table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    rows = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_language_id, op2_lattice, op3_secrets, op4_jaccard, op5_mixing, op6_fingerprints,
        op7_quality, op8_repeats, op9_pieces, op10_pitman_yor, op11_hilbert_shards,
        op12_hard_negatives, op13_whitening,
    )
}
#: All pairs, and what links reach by recursion: for tables that are small.
_REACHED = """
reached AS (
  SELECT id AS a, id AS b FROM node UNION SELECT r.a, l.b FROM reached r JOIN link l ON l.a = r.b)"""

ORACLE_SQL: dict[str, str] = {
    "op2_lattice": f"""
WITH RECURSIVE node AS (SELECT DISTINCT vec_id AS id FROM embeddings),
v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
link AS (
  SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
{_REACHED},
root AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON id = vec_id""",
    "op4_jaccard": f"""
WITH RECURSIVE node AS (SELECT DISTINCT doc_id AS id FROM documents),
word AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM word),
place AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM place x JOIN place y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
{_REACHED},
root AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM shingled JOIN root ON id = doc_id""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    list_inner_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
  n.id AS negative_id, positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3""",
}
