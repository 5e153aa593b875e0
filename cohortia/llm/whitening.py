"""Whitening of vectors by their leading principal components.

The components come from Chebyshev-filtered subspace iteration.  Every step of the
polynomial recurrence is one distributed pass that sums centred ``X'(XQ)`` over blocks of
rows: it damps the unwanted end of the spectrum, which a Lanczos column that goes through
the passes of the first filter bounds from below.  QR and Rayleigh-Ritz follow on the driver, which
holds a few columns as long as a vector, until the residuals certify the wanted pairs.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import arrays, importable, stage
from cohortia.llm.vectors import finite, fixed_point, matrix, widest

COMPONENTS = 8
GUARD = 16  # columns beyond the wanted ones
DEGREE = 12  # passes of one filter at most
GROWTH = 23.0  # logarithm of what a filter may grow the largest direction by
ROUNDS = 60  # filters at most
CERTIFIED = 1e-13  # residual, as a share of the largest eigenvalue, that ends the iteration
ACCEPTED = 1e-9  # residual that must be reached where rounding ends progress earlier
RANK = 1e-12  # share of the trace under which an eigenvalue counts as zero
ROWS = 1_024  # vectors of a block
FAN = 64  # matrices that one task, or the driver, sums
SEED = 20_241


@dataclass(frozen=True)
class Blocks:
    """Fixed-point vectors in blocks of rows, and their exact sums."""

    rows: DataFrame  # ids, named (whether there is an id), x: a block's numbers, row by row
    n: int
    sums: np.ndarray  # of every component
    wide: bool  # whether n * x could leave 64 bits


@dataclass(frozen=True)
class Fit:
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    trace: float
    residual: float
    passes: int


def _total(
    blocks: DataFrame, each: Callable[[np.ndarray], np.ndarray],
    join: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add,
) -> np.ndarray | None:
    """Sum of the matrices ``each(block)`` over all blocks; None where there are none.

    A task sums its blocks, further tasks sum up to ``FAN`` tasks' matrices, and at most
    ``FAN`` matrices reach the driver.
    """

    def summed(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, list]]:
        total = None
        for part in parts:
            for block in part["x"]:
                own = each(np.frombuffer(block, np.int64))
                total = own if total is None else join(total, own)
        if total is not None:
            yield {"sums": [pickle.dumps(total)]}

    def joined(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, list]]:
        total = None
        for part in parts:
            for own in part["sums"]:
                total = pickle.loads(own) if total is None else join(total, pickle.loads(own))
        if total is not None:
            yield {"sums": [pickle.dumps(total)]}

    sums = arrays(blocks.select("x"), summed, "sums binary")
    tasks = blocks.rdd.getNumPartitions()
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        sums = arrays(sums.repartition(tasks, F.spark_partition_id()), joined, "sums binary")
    found = [pickle.loads(row["sums"]) for row in sums.collect()]
    return reduce(join, found) if found else None


def blocks(vectors: DataFrame, *, scale: int = 1_024, offset: int = 100_000, rows: int = ROWS) -> Blocks:
    """Vectors as fixed-point numbers ``floor(scale * c) + offset``, in blocks.

    ``vectors`` has vec_id and embedding.  Rows whose vector is null or holds null or
    non-finite components are left out (as are components of 2**40 and more, which are
    no fixed-point numbers); shorter vectors are filled up with components of zero.
    """
    good = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(finite("v"))
    width = widest(good, "v")
    importable(vectors.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = matrix(part.column("x"), width, offset)
                ids = part.column("vec_id")
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
                    "named": pa.array([np.asarray(ids.is_valid()).tobytes()], pa.binary()),
                    "x": pa.array([x.tobytes()], pa.binary()),
                })

    fixed = good.select(F.col("vec_id").cast("long").alias("vec_id"), fixed_point("v", scale, offset).alias("x"))
    held = stage(fixed.mapInArrow(packed, "ids binary, named binary, x binary"))
    if width == 0:
        n = held.agg(F.sum(F.length("named"))).first()[0] or 0
        return Blocks(held, n, np.zeros(0, np.int64), False)

    def sums(flat: np.ndarray) -> np.ndarray:
        x = flat.reshape(-1, width)
        return np.array([*x.sum(axis=0), len(x)], object)

    exact = _total(held, sums)
    if exact is None:
        return Blocks(held, 0, np.zeros(width, np.int64), False)
    n, total = int(exact[width]), exact[:width]
    most = _total(held, lambda flat: np.abs(flat).max(keepdims=True), np.maximum)
    wide = 4 * n * int(most[0]) >= 1 << 62
    return Blocks(held, n, total if wide else total.astype(np.int64), wide)


def _deviations(flat: np.ndarray, at: Blocks) -> np.ndarray:
    """n * x - sums, exactly: 64-bit numbers, or Python's where those could overflow."""
    x = flat.reshape(-1, len(at.sums))
    if at.wide:
        return x.astype(object) * at.n - at.sums.astype(object)
    return x * at.n - at.sums


def _bare(at: Blocks) -> Blocks:
    """What tasks need of the blocks: no DataFrame goes to them."""
    return Blocks(None, at.n, at.sums, at.wide)


def products(at: Blocks, q: np.ndarray) -> np.ndarray:
    """The covariance times ``q`` by one pass: the sum of centred X'(Xq), over n."""
    own = _bare(at)

    def each(flat: np.ndarray) -> np.ndarray:
        x = (_deviations(flat, own) / own.n).astype(float)
        return x.T @ (x @ q)

    return _total(at.rows, each) / at.n


def _trace(at: Blocks) -> float:
    own = _bare(at)

    def each(flat: np.ndarray) -> np.ndarray:
        return ((_deviations(flat, own) / own.n).astype(float) ** 2).sum(axis=0)

    return float(_total(at.rows, each).sum() / at.n)


class _Lanczos:
    """A column that goes through the passes of a filter and bounds the lowest eigenvalue."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alpha, self.beta = [start / np.linalg.norm(start)], [], []

    @property
    def column(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, product: np.ndarray) -> None:
        self.alpha.append(float(product @ self.column))
        held = np.array(self.basis).T
        rest = product - held @ (held.T @ product)
        rest -= held @ (held.T @ rest)
        self.beta.append(float(np.linalg.norm(rest)))
        self.basis.append(rest / self.beta[-1] if self.beta[-1] > 0 else np.zeros_like(rest))

    def least(self) -> float:
        inner = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        values, vectors = np.linalg.eigh(inner)
        return max(0.0, float(values[0] - self.beta[-1] * abs(vectors[-1, 0])))


def leading(
    multiply: Callable[[np.ndarray], np.ndarray], size: int, trace: float, *,
    components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, rounds: int = ROUNDS,
    seed: int = SEED,
) -> Fit:
    """The leading eigenpairs of a symmetric matrix without negative eigenvalues.

    ``multiply`` is one pass.  The block has ``components + guard`` columns, or all where
    the matrix is smaller, and then one Rayleigh-Ritz step is exact.  The damped interval
    ends below the wanted values even where more of them are equal than the block has
    columns.  Raises where the residuals never fall under ``ACCEPTED``.
    """
    random = np.random.default_rng(seed)
    width = min(size, components + guard)
    wanted = min(components, width)
    q = np.linalg.qr(random.normal(size=(size, width)))[0]
    lanczos = _Lanczos(random.normal(size=size))
    low, before, passes = 0.0, np.inf, 0
    for round_ in range(rounds):
        product = multiply(q)
        passes += 1
        inner = q.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        top = values[0]
        if top <= 0:
            return Fit(np.zeros(0), np.zeros((size, 0)), trace, 0.0, passes)
        residual = float(np.linalg.norm(product - q * values, axis=0)[:wanted].max() / top)
        if residual <= CERTIFIED or width == size or (residual <= ACCEPTED and residual > before / 2):
            return Fit(values[:wanted], q[:, :wanted], trace, residual, passes)
        before = residual
        least = max(0.0, float(values[wanted - 1]))
        low = min(low, max(0.0, float(values[-1])))
        high = min(float(values[-1]), least - 0.05 * (least - low))
        centre, half = (low + high) / 2, max((high - low) / 2, 1e-14 * top)
        # no more than what keeps the least wanted direction from drowning in the largest
        steps = int(np.clip(GROWTH / np.arccosh(max((top - centre) / half, 1.0001)), 1, degree))
        sigma = first = half / max(top - centre, half)
        old, new = q, q
        for i in range(steps):
            if round_ == 0:
                out = multiply(np.column_stack([new, lanczos.column]))
                lanczos.step(out[:, -1])
                out = out[:, :-1]
            else:
                out = multiply(new)
            passes += 1
            if i == 0:
                new = (out - centre * q) * (sigma / half)
            else:
                following = 1 / (2 / first - sigma)
                old, new = new, 2 * (following / half) * (out - centre * new) - sigma * following * old
                sigma = following
        q = np.linalg.qr(new)[0]
        low = max(low, lanczos.least())
    raise ArithmeticError(f"residual {before} after {passes} passes")


def fit(at: Blocks, **settings) -> Fit:
    """The principal components of the blocks; those of eigenvalue zero are left out."""
    size = len(at.sums)
    trace = _trace(at) if size and at.n else 0.0
    if trace <= 0:
        return Fit(np.zeros(0), np.zeros((size, 0)), 0.0, 0.0, 0)
    found = leading(lambda q: products(at, q), size, trace, **settings)
    real = found.values > RANK * trace
    return Fit(found.values[real], found.vectors[:, real], trace, found.residual, found.passes)


def _projected(flat: np.ndarray, at: Blocks, model: Fit) -> np.ndarray:
    x = (_deviations(flat, at) / at.n).astype(float)
    return (x @ model.vectors) / np.sqrt(model.values)


def identity_error(at: Blocks, model: Fit) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, by two passes."""
    own, size = _bare(at), len(model.values)
    if not size:
        return 0.0
    mean = _total(at.rows, lambda flat: _projected(flat, own, model).sum(axis=0)) / at.n

    def each(flat: np.ndarray) -> np.ndarray:
        w = _projected(flat, own, model) - mean
        return w.T @ w

    return float(np.abs(_total(at.rows, each) / at.n - np.eye(size)).max())


def whiten(vectors: DataFrame, *, scale: int = 1_024, offset: int = 100_000, **settings) -> DataFrame:
    """vec_id, n, deviation, whitened, explained and identity_error of every vector.

    ``whitened`` and ``explained`` are lists with an entry for each component, the
    largest eigenvalue first.  ``vectors`` has vec_id and embedding; further columns of
    any name do not matter.  Rows whose vector is null or holds null or non-finite
    components are left out; repeated rows and ids, and null ids, are rows like others.
    Shorter vectors are filled up with zeros.  Components without variance are left out:
    equal vectors, or one vector, have empty lists, and an empty table gives no rows.
    ``deviation`` is exact; where it does not fit in 64 bits it is null.
    """
    at = blocks(vectors, scale=scale, offset=offset)
    model = fit(at, **settings)
    error = identity_error(at, model)
    own = _bare(at)
    explained = (model.values / model.trace).tolist() if len(model.values) else []

    def each(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, list]]:
        for part in parts:
            for ids, named, block in zip(part["ids"], part["named"], part["x"]):
                flat, n = np.frombuffer(block, np.int64), len(named)
                if len(own.sums):
                    off = _deviations(flat, own)
                    rough = (off.astype(float) ** 2).sum(axis=1)
                    if own.wide or rough.max() >= 2.0**62:
                        exact = [s if s < 1 << 63 else None for s in (off.astype(object) ** 2).sum(axis=1)]
                    else:
                        exact = (off**2).sum(axis=1).tolist()
                    white = list(_projected(flat, own, model))
                else:
                    exact, white = [0] * n, [[]] * n
                yield {
                    "vec_id": pa.array(np.frombuffer(ids, np.int64), mask=~np.frombuffer(named, bool)),
                    "n": [own.n] * n,
                    "deviation": exact, "whitened": white, "explained": [explained] * n,
                    "identity_error": [error] * n,
                }

    return arrays(at.rows, each, (
        "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, "
        "identity_error double"))


def by_component(rows: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    return rows.select(
        "vec_id", "n", "deviation", "explained", "identity_error",
        F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.col("explained")[F.col("at")].alias("explained"), "identity_error",
    )
