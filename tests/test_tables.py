import datetime as dt

import pytest

from bindings import rules
from bindings.registry import REGISTRY
from bindings.spark_views import Tables
from cohortia.operators import growth
from cohortia.operators import relational as rel
from cohortia.plans.jobs import Jobs, Settings
from cohortia.sources import tables, taxonomy
from tests.conftest import day, rows

import bindings.queries  # noqa: F401  (fills the registry)

SF = "/root/testdata/sf0.001"


def test_replace_create_and_append(spark, make, tmp_path):
    root = str(tmp_path)
    result = lambda d, v: make.table("CurrentDate date, Metric string, Zscore double", [(day(d), "m", v)])
    tables.replace_table(result("2019-01-01", 1.0), root, "t")
    tables.replace_table(result("2019-01-02", 2.0), root, "t")
    assert rows(tables.read_table(spark, root, "t"), "Zscore") == [(2.0,)]
    with pytest.raises(Exception, match="(?i)exists"):
        tables.create_table(result("2019-01-03", 3.0), root, "t")
    tables.create_table(result("2019-01-03", 3.0), root, "new")
    for d, v in (("2019-01-01", 1.0), ("2019-01-02", 2.0), ("2019-01-02", 2.5), ("2019-01-03", 3.0)):
        tables.append_day(result(d, v), root, "history", value=day(d))
    # a rerun of a day that finds nothing replaces it as well
    tables.append_day(result("2019-01-03", 3.0).where("false"), root, "history", value=day("2019-01-03"))
    assert rows(tables.read_table(spark, root, "history"), "CurrentDate", "Zscore") == [
        (day("2019-01-01"), 1.0), (day("2019-01-02"), 2.5),
    ]


def values(spark, root):
    return sorted(r.a for r in tables.read_table(spark, root, "t").collect())


def test_a_failed_replacement_leaves_the_old_rows(spark, make, tmp_path):
    root = str(tmp_path)
    tables.replace_table(make.table("a int", [(1,), (2,)]), root, "t")
    # some tasks write their part before another one fails
    broken = spark.range(0, 1000, 1, 8).selectExpr(
        "CAST(IF(id = 999, raise_error('lost'), id) AS INT) AS a")
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, root, "t")
    assert values(spark, root) == [1, 2]
    tables.replace_table(make.table("a int", [(3,)]), root, "t")
    assert values(spark, root) == [3]
    kept = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("version=")]
    assert len(kept) == 2  # the current version and the one before; the failed one is gone


def test_readers_keep_the_version_they_began_with(spark, make, tmp_path):
    root = str(tmp_path)
    tables.replace_table(make.table("a int", [(1,)]), root, "t")
    begun = tables.read_table(spark, root, "t")
    tables.replace_table(make.table("a int", [(2,)]), root, "t")
    assert rows(begun) == [(1,)] and values(spark, root) == [2]
    # a table may be replaced by what is read from it, and start as a plain directory
    tables.replace_table(tables.read_table(spark, root, "t").selectExpr("a + 1 AS a"), root, "t")
    assert values(spark, root) == [3]
    make.table("a int", [(7,)]).write.parquet(f"{root}/plain")
    tables.replace_table(tables.read_table(spark, root, "plain").selectExpr("a + 1 AS a"), root, "plain")
    assert rows(tables.read_table(spark, root, "plain")) == [(8,)]


def test_event_log_is_pruned_by_day_and_filtered_in_the_scan(spark, make, tmp_path):
    events = make.events([("u", "a", "2018-01-01 10:00"), ("u", "b", "2018-01-02"), ("v", "a", "2018-01-03")])
    tables.write_event_log(events, str(tmp_path), "log")
    log = tables.read_event_log(spark, str(tmp_path), "log", since=dt.date(2018, 1, 2))
    assert rows(log, "OpenId") == [("u",), ("v",)]
    picked = log.where("EventType IN ('a', 'c')")
    assert rows(picked, "OpenId") == [("v",)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(EventDate" in plan
    assert "In(EventType" in plan.split("PushedFilters")[1]


def test_month_partitions_are_pruned_too(spark, make, tmp_path):
    events = make.events([("u", "a", "2018-01-31"), ("v", "a", "2018-02-10"), ("w", "a", "2018-02-20")])
    tables.write_event_log(events, str(tmp_path), "log", by="month")
    log = tables.read_event_log(spark, str(tmp_path), "log", since=dt.date(2018, 2, 15), by="month")
    assert rows(log, "OpenId") == [("w",)]


def test_bounds_of_an_operator_prune_the_stored_log(spark, make, tmp_path):
    events = make.events([("u", "a", "2018-01-31"), ("v", "a", "2018-02-10"), ("w", "a", "2018-03-20")])
    tables.write_event_log(events, str(tmp_path), "log")
    log = tables.read_event_log(spark, str(tmp_path), "log")
    late = rel.event_scan(log, ["a"], after=dt.date(2018, 2, 15))
    inside = rel.event_scan(log, ["a"], between=(dt.datetime(2018, 1, 1), dt.datetime(2018, 2, 10)))
    for found, want in ((late, ["w"]), (inside, ["u", "v"])):
        assert rows(found, "OpenId") == [(x,) for x in want]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(EventDate" in plan


def test_staged_rows_survive_without_lineage(spark, make, tmp_path):
    staged = tables.staged(make.table("a int", [(1,), (2,)]).selectExpr("a + 1 AS a"), str(tmp_path), "s")
    assert rows(staged) == [(2,), (3,)]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "LocalTableScan" not in plan


def test_user_chains_on_the_bucketed_log_need_no_shuffle_of_it(spark, tmp_path):
    t, types = Tables(spark, SF), taxonomy.growth_types("Acme")
    tables.write_user_log(t.platform_event(), "user_log", str(tmp_path / "log"), buckets=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        users = growth.growth_users(t.user_current(), internal="acme")
        kgm = lambda log: growth.key_growth_metrics(
            users, growth.growth_events(log, types=types, after=rules.GROWTH_SINCE),
            t.company_current(), internal="acme", retention_types=types)
        stored = kgm(spark.table("user_log"))
        text = stored._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
        keys = [line.split("hashpartitioning(")[1] for line in moved]
        assert not [k for k in keys if k.startswith(("OpenId", "DayUser", "_groupingexpression"))], keys
        assert "Bucketed: true" in text
        assert rows(stored) == rows(kgm(t.platform_event()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE user_log")


def test_jobs_build_the_same_reports_as_the_queries(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    t = Tables(spark, SF)
    for name in (
        "platform_event", "user_current", "company_current", "users_month", "projects", "user_lead", "lead_current",
        "experiment_current", "gamification",
    ):
        tables.replace_table(getattr(t, name)(), source, name)
    jobs = Jobs(spark, Settings(source, target, rules.INTERNAL, rules.PRODUCT, rules.QUESTION, rules.AS_OF,
        rules.GROWTH_SINCE, rules.LOG_SINCE, rules.NEW_USERS_SINCE, rules.CHALLENGES_BETWEEN, ("Stone",), "month"))
    jobs.initiatives()
    jobs.signups()
    jobs.significance()
    jobs.significance()  # a second run of the day replaces the first
    jobs.guided_tours()
    jobs.products()
    adhoc = jobs.challenge_reports("challenge1")
    jobs.shop()
    same = {
        "initiatives_kgm": "m06_key_growth_metrics", "signup_funnel": None, "customer_types": None,
        "onboarding_new_users": "m17_onboarding", "existing_users": "m20_existing_user_types",
        "existing_users_year": "m21_existing_users_by_year", "resurrected_users": "m22_resurrection",
        "challenges_progress": "m35_challenge_progress_output", "starter_apps": "m41_starter_app_deploys",
        "cart_events": "m43_cart_events", "flow_conversions": None, "tour_full": None, "signup_full": None, "new_users": None,
    }
    for table, query in same.items():
        written = jobs.report(table)
        if query is None:
            assert written.count() >= 0
            continue
        want = REGISTRY[query].spark(spark, SF)
        cast = written.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in want.schema])
        assert rows(cast) == rows(want), table
    assert rows(adhoc["activity"].select("OpenId", "DevActivity")) == rows(
        REGISTRY["m36_challenge_activity"].spark(spark, SF).select("OpenId", "DevActivity")
    )
    history = jobs.report("signup_significance")
    assert history.count() == history.select("Experiment", "Metric").distinct().count()
