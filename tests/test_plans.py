"""Physical plans: what must not appear at scale, and what must."""

import pytest

import bindings.queries  # noqa: F401  (fills the registry)
from bindings import rules
from bindings.registry import REGISTRY
from bindings.spark_views import Tables
from cohortia.operators import growth, signup
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they look when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_growth_chain_shuffles_the_user_rows_once(no_broadcast):
    t = Tables(no_broadcast, SF)
    types = taxonomy.growth_types("Acme")
    users = growth.growth_users(t.user_current(), internal="acme")
    text = plan(
        growth.key_growth_metrics(
            users, growth.growth_events(t.platform_event(), types=types, after=rules.GROWTH_SINCE), t.company_current(),
            internal="acme", retention_types=types,
        )
    )
    # user rows by company and by user, company rows, user-days twice (per day,
    # then per user), invites three times, receivers twice at most
    assert text.count("Exchange hashpartitioning") <= 11
    assert text.count("Exchange hashpartitioning(UserId") == 1


def test_scan_reads_only_needed_columns(spark):
    text = plan(REGISTRY["p77_first_event"].spark(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    assert "In(event_type, [purchase,signup])" in text


def test_user_days_shuffle_on_user_and_day(spark, make):
    events = make.events([("u", "a", "2018-01-01")])
    text = plan(rel.active_days(events, ["a"]))
    assert "Exchange hashpartitioning(OpenId" in text and "YearMonthDay" in text.split("Exchange hashpartitioning(")[1].split(")")[0]
    assert text.index("HashAggregate", text.index("Exchange")) > 0  # a partial step below the shuffle


def exchanges(text):
    return [line.split("Exchange hashpartitioning(")[1].split("), ")[0]
            for line in text.splitlines() if "Exchange hashpartitioning(" in line]


def test_months_are_never_the_only_shuffle_key(no_broadcast):
    for name in ("m22_resurrection", "p30_users_by_month"):
        keys = exchanges(plan(REGISTRY[name].spark(no_broadcast, SF)))
        # of the listed months themselves there is a row each; what joins them is salted
        alone = [k for k in keys if k.count("#") == 1 and "onth" in k]
        assert len(alone) <= 1, keys


def test_spans_meet_days_by_user_and_month(no_broadcast):
    text = plan(REGISTRY["m18_monthly_existing_users"].spark(no_broadcast, SF))
    assert any("UserId" in k and "SpanMonth" in k for k in exchanges(text))


def test_started_payload_is_parsed_with_one_schema(spark):
    t = Tables(spark, SF)
    text = plan(signup.started_signups(t.platform_event(), internal="acme"))
    parses = {part.split("mode")[0] for part in text.split("from_json(")[1:]}
    assert len(parses) == 1 and "CookieID" in next(iter(parses)) and "JobRole" in next(iter(parses))


@pytest.mark.parametrize("name", ["p74_p76_nested_json", "m13_form_answers"])
def test_opened_payloads_are_parsed_once(no_broadcast, name):
    text = plan(REGISTRY[name].spark(no_broadcast, SF))
    opened = [line.count("parseJson(") for line in text.splitlines() if "Generate explode(" in line]
    assert sorted(opened) == [0, 1] and "from_json(" not in text  # the outer level parses, the inner reads


def test_new_users_compute_their_inputs_once(no_broadcast):
    text = plan(REGISTRY["m16_new_users"].spark(no_broadcast, SF))
    assert text.count("LeftAnti") == 0
    assert text.count("customer.parquet") <= 3


def log_scans(frame):
    """Scans of the log that a query really ran, reused exchanges left out."""
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    return sum("FileScan" in line and "events.parquet" in line for line in final.splitlines())


def test_challenge_reports_scan_the_log_once_for_each_family(no_broadcast):
    # assignments and ends together; with activity, its events; users' first events
    assert log_scans(REGISTRY["m34_challenge_progress"].spark(no_broadcast, SF)) == 1
    assert log_scans(REGISTRY["m35_challenge_progress_output"].spark(no_broadcast, SF)) <= 2
    assert log_scans(REGISTRY["m36_challenge_activity"].spark(no_broadcast, SF)) <= 3


@pytest.mark.parametrize("name", ["m08_signup_funnel", "m12_signup_step_funnel"])
def test_signup_funnels_scan_the_log_once(no_broadcast, name):
    assert log_scans(REGISTRY[name].spark(no_broadcast, SF)) == 1


def test_readers_share_an_exchange_and_see_their_rows(no_broadcast, make):
    events = make.events([(f"u{i % 7}", "ab"[i % 2], "2018-01-01") for i in range(40)])
    shared = rel.read_together(events.groupBy("OpenId", "EventType").count())
    a = rel.part_of(shared, rel.one_of("EventType", ["a"])).select("OpenId", "count")
    b = rel.part_of(shared, rel.one_of("EventType", ["b"])).select("OpenId", "EventType")
    both = a.join(b, "OpenId")
    found = {r.OpenId: r["count"] for r in both.collect()}
    assert found == {f"u{k}": sum(i % 7 == k and i % 2 == 0 for i in range(40)) for k in range(7)}
    assert "ReusedExchange" in plan(both).split("== Initial Plan ==")[0]
