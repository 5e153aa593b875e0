"""Language of a text by rank-order profiles of letter n-grams.

A profile is the list of the most frequent n-grams (1 to 3 letters, words padded), in
order.  A text is given the language whose profile its own list is out of place with
least: the sum over the text's n-grams of the difference of ranks, and the profile
length for an n-gram that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.common import importable, scan

PROFILE = 300  # n-grams of a profile
LEARN_ROWS = 5_000  # about as many texts of each label are learnt from
BITS = 21  # of a code point
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes (ascending) and counts of a text's n-grams; empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # one pad (0) before, between and after words
    padded = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.int64)
    padded = padded[np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])]
    first, second, third = padded[:-2], padded[1:-1], padded[2:]
    inner = second != 0
    codes = np.concatenate([
        padded[padded != 0],
        (padded[:-1] << BITS) | padded[1:] | (1 << 62),
        ((first << (2 * BITS)) | (second << BITS) | third)[inner],
    ])
    return np.unique(codes, return_counts=True)


def _ranked(codes: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent codes in order; equal counts in the order of the codes."""
    return codes[np.argsort(-counts, kind="stable")[:length]]


@dataclass
class Profiles:
    """Languages in order, all their codes ascending, and a rank per code and language."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    length: int

    @classmethod
    def of(cls, rows: list, length: int) -> Profiles:
        languages = sorted({row["lang"] for row in rows})
        codes = np.array(sorted({row["code"] for row in rows}), np.int64)
        ranks = np.full((len(codes), len(languages)), -1, np.int64)
        for row in rows:
            ranks[np.searchsorted(codes, row["code"]), languages.index(row["lang"])] = row["rank"]
        return cls(languages, codes, ranks, length)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus the share of the greatest distance."""
        own = _ranked(*gram_counts(text), self.length)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        away = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.length, away).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.length * len(own)))


def learn(
    docs: DataFrame, *, length: int = PROFILE, rows: int = LEARN_ROWS
) -> Profiles:
    """Profiles of the languages of labelled ``docs`` (text, non-null lang, doc_id).

    Learns from about ``rows`` texts of each label, chosen by a hash of doc_id (all, if
    there are fewer), so that a rare language keeps its profile beside frequent ones.
    What reaches the driver is a count and ``length`` n-grams of each label.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    shares = [x for lang, n in counts.items() if n > rows for x in (F.lit(lang), F.lit(int(rows / n * (1 << 40))))]
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    chosen = labelled
    if shares:
        chosen = labelled.filter(draw < F.coalesce(
            F.try_element_at(F.create_map(*shares), F.col("lang")), F.lit(1 << 40)))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            found: dict[str, list] = {}
            for text, lang in zip(part["text"], part["lang"]):
                found.setdefault(lang, []).append(gram_counts(text))
            for lang, pairs in found.items():
                codes, at = np.unique(np.concatenate([c for c, _ in pairs]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([n for _, n in pairs]), len(codes))
                yield {
                    "lang": [lang] * len(codes),
                    "code": codes,
                    "n": counts.astype(np.int64),
                }

    counted = (
        scan(chosen.select("text", "lang"), each, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = (
        counted.withColumn("rank", F.row_number().over(order) - 1)
        .filter(F.col("rank") < length).select("lang", "code", "rank")
    )
    return Profiles.of(top.collect(), length)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    A text that is null or has no letter gets ``und`` and score 0, as every text does
    when nothing was learnt.  Ties go to the first language in order of its label.
    Repeated rows give repeated rows.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            found = [profiles.predict(text) for text in part["text"]]
            yield {
                "doc_id": part["doc_id"],
                "lang_pred": [lang for lang, _ in found],
                "score": [score for _, score in found],
            }

    return scan(docs.select("doc_id", "text"), each, "doc_id long, lang_pred string, score double")


def known(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a known language.

    Rejected are texts without a letter (null and empty ones too) and texts that share
    no n-gram with any profile, such as those in another script (score 0); if nothing
    was learnt, nothing is told apart and all rows with a letter stay.
    """
    importable(docs.sparkSession)

    @F.pandas_udf("boolean")
    def accepted(texts):  # noqa: ANN001, ANN202
        if not profiles.languages:
            return texts.map(lambda text: bool(len(gram_counts(text)[0])))
        return texts.map(lambda text: profiles.predict(text)[1] > 0)

    return docs.filter(accepted(F.col("text")))
