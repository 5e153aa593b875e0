"""Quality of a text by a regularised quadratic discriminant over its statistics.

Each class has a mean and a covariance of the transformed statistics; the covariance is
drawn towards the pooled one and towards a multiple of the identity.  A text's score is
the posterior of class 1 from the difference of the classes' log densities, computed
with Cholesky factors that are decomposed once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import scan, stage

POOLED = 0.3  # weight of the pooled covariance
ROUND = 0.02  # weight of the identity
FLATTEN = 0.1  # power of the densities, as the statistics depend on each other

_BYTES = np.arange(256)
_CLASSES = np.stack([
    (_BYTES >= 97) & (_BYTES <= 122),  # small letters
    (_BYTES >= 65) & (_BYTES <= 90),  # capitals
    (_BYTES >= 48) & (_BYTES <= 57),  # digits
    np.isin(_BYTES, [32, 9, 10, 11, 12, 13]),  # white space
    np.isin(_BYTES, list(b".,;:'\"?-()")),  # marks of prose
    np.isin(_BYTES, list(b"!#$%&*+/<=>@[\\]^_`{|}~")),  # other marks
    _BYTES >= 128,
]).astype(float)
N_STATS = 17


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a text; those of an empty text if it is null."""
    data = (text or "").encode("utf-8", "replace")
    shares = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(len(data), 1)
    words = data.lower().split()
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = data.split(b"\n")
    pairs = len(set(zip(words, words[1:])))
    at_most = max(len(words), 1)
    ends = sum(word[-1] < 128 and not word[-1:].isalnum() for word in words)
    return [
        *np.sqrt(shares / n).tolist(),
        float(np.log1p(len(words))),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        float(np.log1p(lengths.max())),
        len(counts) / at_most,
        float(np.sqrt(max(counts.values(), default=0) / at_most)),
        pairs / max(len(words) - 1, 1),
        len(set(lines)) / len(lines),
        float(np.log1p(len(words) / len(lines))),
        float(np.sqrt(ends / at_most)),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the array of statistics of every whole text, staged."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            yield {"doc_id": part["doc_id"], "x": [statistics(text) for text in part["text"]]}

    return stage(scan(docs.select("doc_id", "text"), each, "doc_id long, x array<double>"))


@dataclass
class Discriminant:
    """Means, Cholesky factors and log weights of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    logs: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, n: np.ndarray, total: np.ndarray, products: np.ndarray) -> Discriminant:
        """From counts, sums and sums of products by class."""
        size = total.shape[1]
        share = np.maximum(n, 1)
        means = total / share[:, None]
        spread = products / share[:, None, None] - means[:, :, None] * means[:, None, :]
        pooled = (spread * n[:, None, None]).sum(axis=0) / max(n.sum(), 1)
        scale = np.sqrt(np.maximum(np.diag(pooled), 0)) + 1e-6
        pooled, spread = pooled / np.outer(scale, scale), spread / np.outer(scale, scale)
        factors = []
        for own in spread:
            mixed = (1 - POOLED) * own + POOLED * pooled
            level = max(np.trace(mixed) / size, 1e-6)
            factors.append(np.linalg.cholesky((1 - ROUND) * mixed + ROUND * level * np.eye(size)))
        weights = np.log((n + 1) / (n.sum() + 2))
        halves = np.array([np.log(np.diag(factor)).sum() for factor in factors])
        return cls(means, np.stack(factors), weights - FLATTEN * halves, scale)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for rows of statistics."""
        logs = []
        for k in range(2):
            z = np.linalg.solve(self.factors[k], ((x - self.means[k]) / self.scale).T)
            logs.append(self.logs[k] - FLATTEN * 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def learn(rows: DataFrame, labels: DataFrame) -> Discriminant:
    """A discriminant from measured ``rows`` and ``labels`` (doc_id, quality 0 or 1).

    Labels that are null or neither 0 nor 1 are left out; a repeated row counts as often
    as it is there.  The sums are added up on the executors, by class and position.
    """
    joined = rows.join(
        labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality"), "doc_id"
    ).select("x", F.col("quality").cast("int").alias("k"))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        sums = np.zeros((2, 1 + N_STATS + N_STATS**2))
        for part in slices:
            x, k = np.array(part["x"], float).reshape(-1, N_STATS), np.array(part["k"])
            for c in range(2):
                own = x[k == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield {"k": [0, 1], "sums": sums.tolist()}

    summed = (
        scan(joined, each, "k int, sums array<double>")
        .select("k", F.posexplode("sums").alias("at", "v"))
        .groupBy("k", "at").agg(F.sum("v").alias("v")).collect()
    )
    sums = np.zeros((2, 1 + N_STATS + N_STATS**2))
    for k, at, v in summed:
        sums[k, at] = v
    return Discriminant.of(
        sums[:, 0], sums[:, 1:1 + N_STATS], sums[:, 1 + N_STATS:].reshape(2, N_STATS, N_STATS)
    )


def score(rows: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score (0 to 1) of measured rows; without labels learnt, 0.5 for all.

    Null and empty texts are scored by the statistics of an empty text.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            x = np.array(part["x"], float).reshape(-1, N_STATS)
            yield {"doc_id": part["doc_id"], "score": model.scores(x).tolist()}

    return scan(rows.select("doc_id", "x"), each, "doc_id long, score double")
