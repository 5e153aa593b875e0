"""Tables whose source takes case and trailing blanks as equal."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

import bindings.queries  # noqa: F401
from bindings import rules
from bindings.registry import REGISTRY
from bindings.spark_views import Tables
from cohortia.functions import text
from cohortia.operators import growth
from cohortia.plans.jobs import Jobs, Settings
from cohortia.sources import tables, taxonomy
from tests.conftest import by_key, rows

SF = "/root/testdata/sf0.001"
TYPES = taxonomy.growth_types("Acme")


@pytest.fixture(params=["UTF8_BINARY", "UTF8_LCASE", "UTF8_LCASE_RTRIM"])
def collation(request):
    return request.param


def test_predicates(spark, collation):
    """Containment ignores case by default and blank tests trailing blanks, whatever the
    collation; plain equality follows the collation."""
    frame = spark.createDataFrame([("ACME labs",), ("acme",), ("Acme  ",), ("  ",), ("",), (None,)], "x string")
    x = tables.collated(frame, collation)
    count = lambda test: x.where(test).count()
    assert count(text.contains(F.col("x"), "acme")) == 3
    assert count(text.lacks(F.col("x"), "Acme")) == 2
    assert count(text.not_blank(F.col("x"))) == 3
    equal = {"UTF8_BINARY": 1, "UTF8_LCASE": 1, "UTF8_LCASE_RTRIM": 2}[collation]
    assert count(F.col("x") == "acme") == equal
    assert count(F.col("x").isin("acme", "other")) == equal
    assert count(F.col("x") == "ACME LABS") == (collation != "UTF8_BINARY")
    assert count(F.col("x") == "") == (2 if collation == "UTF8_LCASE_RTRIM" else 1)
    assert count(text.same_text(F.col("x"), "ACME")) == equal


def test_growth_metrics(make, collation):
    """Ids, types and companies written in different ways meet under a collation."""
    by = lambda frame: tables.collated(frame, collation)
    users = by(make.users([("Ann", "C1", "2018-01-01"), ("bob", "c2 ", "2018-01-01"), ("own", "ACME", "2018-01-01")]))
    events = by(make.events([
        ("ann", "SandboxDeployed", "2018-01-05"), ("ANN ", "SANDBOXDEPLOYED", "2018-02-05"),
        ("Ann", "SandboxDeployed", "2018-02-06"), ("bob", "sandboxdeployed ", "2018-01-07"),
    ]))
    company = by(make.company([("C1", "One", "t", 0, 1, 1), ("C2", "Two", "t", 1, 0, 0)]))
    known = growth.growth_users(users, internal="acme")
    got = growth.key_growth_metrics(
        known, events, company, internal="acme", retention_types=TYPES)
    found = by_key(tables.exact(got), "UserId", "CompanyType", "ActivatedWithin30days", "Retained")
    want = {
        "UTF8_BINARY": {"Ann": ("Customer", 0, 1), "bob": ("Other", 0, 0)},
        "UTF8_LCASE": {"Ann": ("Customer", 1, 1), "bob": ("Other", 0, 0)},
        "UTF8_LCASE_RTRIM": {"Ann": ("Customer", 1, 1), "bob": ("Partner", 1, 0)},
    }
    assert found == want[collation]


def test_groups_and_named_columns(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("A", "X", 2), ("a ", "x", 3)], "k string, v string, n int")
    by_k = tables.collated(frame, columns=["k"])
    assert rows(by_k.groupBy("k").agg(F.sum("n").alias("n"), F.countDistinct("v").alias("v")), "n", "v") == [(6, 2)]
    assert by_k.columns == frame.columns
    assert tables.exact(by_k).schema == frame.schema


def test_partition_filters_stay(spark, make, tmp_path, collation):
    """Days are pruned by directory whatever the collation of the texts."""
    log = make.events([("u", "SandboxDeployed", f"2018-01-{d:02d}") for d in range(1, 11)])
    tables.write_event_log(log, str(tmp_path), "log")
    since = dt.date(2018, 1, 8)
    read = tables.collated(tables.read_event_log(spark, str(tmp_path), "log", since=since), collation)
    plan = read.where(F.col("EventType") == "SandboxDeployed")
    scan = next(line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line)
    assert "EventDate" in scan.split("PartitionFilters", 1)[1].split("]", 1)[0]
    assert plan.count() == 3


def test_stored_and_read(spark, make, tmp_path):
    """A stored table keeps the texts as they were written."""
    frame = spark.createDataFrame([("Ann ",), ("ann",)], "k string")
    tables.replace_table(tables.exact(tables.collated(frame)), str(tmp_path), "t")
    assert rows(tables.read_table(spark, str(tmp_path), "t")) == [("Ann ",), ("ann",)]


def test_jobs_under_a_collation(spark, tmp_path):
    """A log that writes users and event types in its own way gives the same report."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    t = Tables(spark, SF)
    log = t.platform_event()
    written = log.withColumns({
        "OpenId": F.concat(F.upper("OpenId"), F.lit("  ")), "EventType": F.lower("EventType"),
    })
    tables.replace_table(written, source, "platform_event")
    for name in ("user_current", "company_current"):
        tables.replace_table(getattr(t, name)(), source, name)
    settings = Settings(source, target, rules.INTERNAL, rules.PRODUCT, rules.QUESTION, rules.AS_OF, rules.GROWTH_SINCE,
        rules.LOG_SINCE, rules.NEW_USERS_SINCE, rules.CHALLENGES_BETWEEN, collation="UTF8_LCASE_RTRIM")
    Jobs(spark, settings).initiatives()
    report = tables.read_table(spark, target, "initiatives_kgm")
    want = REGISTRY["m06_key_growth_metrics"].spark(spark, SF)
    cast = report.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.schema])
    assert rows(cast) == rows(want)
    assert report.where("ActivatedWithin30days = 1").count() > 0
    stored = tables.read_event_log(spark, target, "initiatives_events")
    assert stored.schema["OpenId"].dataType == StringType()
    assert stored.where(F.col("EventType") == "sandboxdeployed").count() > 0
