import numpy as np
import pytest

from cohortia.llm import queries, whitening
from tests.llm import samples

SCHEMA = "vec_id long, embedding array<float>"


def by_numpy(vectors, components=8):
    """Whole numbers, exact deviations, whitened rows and shares by a dense solver."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    centred = off / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    white = centred @ turn / np.sqrt(values)
    return (off.astype(object) ** 2).sum(axis=1), white, values / (centred**2).sum() * n


def test_query_equals_a_dense_solver(spark):
    table = spark.read.parquet(f"{samples.SF}/embeddings.parquet").collect()
    deviations, white, shares = by_numpy([r["embedding"] for r in table])
    rows = queries.op13_whitening(spark, samples.SF).toPandas()
    assert len(rows) == 8 * len(table) and set(rows["n"]) == {len(table)}
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-10
    got = rows.pivot(index="vec_id", columns="component", values="whitened")
    got = got.loc[[r["vec_id"] for r in table]].to_numpy()
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(rows.groupby("component")["explained"].first().to_numpy() / shares - 1).max() < 1e-10
    first = rows[rows["component"] == 1].set_index("vec_id")["deviation"]
    assert [first[r["vec_id"]] for r in table] == list(deviations)


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 60) ** 6, np.r_[np.ones(50), 1 + 1e-3 * np.arange(10)],
    np.ones(60), np.r_[np.zeros(55), 1e-6, 1, 2, 3, 4], np.r_[np.ones(30), 2 * np.ones(30)],
])
def test_iteration_is_certified(values):
    random = np.random.default_rng(4)
    basis = np.linalg.qr(random.normal(size=(60, 60)))[0]
    a = basis * values @ basis.T
    found = whitening.leading(lambda q: a @ q, 60, values.sum())
    assert np.abs(found.values - np.sort(values)[::-1][:8]).max() < 1e-9 * values.max()
    assert found.residual <= whitening.ACCEPTED
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12


def test_sums_go_through_further_tasks(spark, monkeypatch):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(90, 40))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(7)
    monkeypatch.setattr(whitening, "FAN", 2)
    at = whitening.blocks(frame)
    x = np.floor(1024 * vectors.astype(np.float32).astype(float)) + 100_000
    centred = x - x.mean(axis=0)
    q = random.normal(size=(40, 3))
    assert np.allclose(whitening.products(at, q), centred.T @ (centred @ q) / 90, rtol=1e-11)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0]), (1, None), (2, [nan, 1.0, 1.0]), (3, [inf, 1.0, 1.0]),
        (4, [None, 1.0, 1.0]), (None, [4.0, 2.0, 1.0]), (5, [1.5]), (6, []), (7, [0.5, 2.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS x", "2 AS ids", "3 AS n", "4 AS v")
    good = [(i, (v + [0.0] * 3)[:3]) for i, v in rows if v is not None and all(
        x is not None and np.isfinite(x) for x in v)]
    deviations, white, shares = by_numpy([v for _, v in good], 3)
    found = whitening.whiten(frame).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]) for r in found) == sorted(
        (i is None, i or 0, d) for (i, _), d in zip(good, deviations))
    assert all(len(r["whitened"]) == 3 and r["n"] == len(good) for r in found)
    assert np.allclose(found[0]["explained"], shares)
    assert found[0]["identity_error"] < 1e-9
    one = next(r for r in found if r["vec_id"] is None)
    assert np.allclose(np.abs(one["whitened"]), np.abs(white[[i for i, _ in good].index(None)]))


@pytest.mark.parametrize("rows", [
    [], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)],
])
def test_without_variance(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert [(r["deviation"], r["whitened"]) for r in found.collect()] == [
        (0, []) for _, v in rows if v is not None]
    assert whitening.by_component(found).count() == 0


def test_fewer_components_than_eight(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 5.0]) for i in range(20)]
    found = whitening.by_component(whitening.whiten(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r["component"] for r in found} == {1} and abs(found[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_64_bits(spark):
    rows = [(0, [2.0**38, 0.0]), (1, [-(2.0**38), 1.0]), (2, [0.5, 2.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["vec_id"]: r["deviation"] is None for r in found.collect()} == {0: True, 1: True, 2: False}
