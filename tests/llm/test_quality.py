import numpy as np
from pyspark.sql import functions as F

from cohortia.llm import quality
from cohortia.llm.queries import op7_quality
from tests.llm import samples


def test_held_out_labels(spark):
    scored = op7_quality(spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").collect()
    y = np.array([r["quality"] for r in rows])
    s = np.array([r["score"] for r in rows])
    rank = s.argsort().argsort()
    area = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / (y == 1).sum() / (y == 0).sum()
    assert len(rows) > 500 and area > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97


def test_discriminant_is_that_of_the_densities():
    random = np.random.default_rng(3)
    n, size = np.array([400.0, 600.0]), quality.N_STATS
    xs = [random.normal(size=(400, size)) * 2, random.normal(size=(600, size)) + 0.7]
    model = quality.Discriminant.of(
        n, np.stack([x.sum(axis=0) for x in xs]), np.stack([x.T @ x for x in xs]))
    probe = random.normal(size=(50, size))
    logs = []
    for k in range(2):
        cov = model.factors[k] @ model.factors[k].T * np.outer(model.scale, model.scale)
        d = probe - model.means[k]
        density = -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])
        logs.append(quality.FLATTEN * density + np.log((n[k] + 1) / (n.sum() + 2)))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert np.allclose(model.scores(probe), want)


def test_sums_do_not_depend_on_partitions(spark):
    docs = samples.documents(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    rows = quality.measured(docs)
    one = quality.learn(rows.repartition(1), labels)
    many = quality.learn(rows.repartition(7), labels)
    assert np.allclose(one.factors, many.factors) and np.allclose(one.means, many.means)


def test_awkward_rows(spark):
    docs = samples.awkward(spark)
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (3, None), (3, 1), (None, 1), (4, 7), (6, 0), (6, 0)], "doc_id long, quality int")
    rows = quality.measured(docs)
    scored = quality.score(rows, quality.learn(rows, labels)).collect()
    assert len(scored) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in scored)
    by_id = {}
    for r in scored:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert by_id[0] == by_id[1] and len(by_id[3]) == 1
    untaught = quality.learn(rows, labels.filter("false"))
    assert {r["score"] for r in quality.score(rows, untaught).collect()} == {0.5}
    assert quality.score(quality.measured(samples.empty(spark)), untaught).count() == 0
