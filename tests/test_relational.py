"""Building blocks against brute force, with frequent and missing keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortia.operators import relational as rel
from tests.conftest import rows

START = dt.datetime(2019, 1, 1)


def random_log(seed, n, users):
    """Random moments; user 0 owns a third, some keys and moments are missing."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        user = "u0" if i % 3 == 0 else draw.choice(users)
        moment = START + dt.timedelta(minutes=draw.randrange(0, 60 * 24 * 20, 20))
        out.append((user, None if draw.random() < 0.02 else moment, draw.randrange(100), i))
    return out


USERS = ["u1", "u2", "u3", None]
SCHEMA = "user string, at timestamp_ntz, v int, id int"


@pytest.mark.parametrize("closed", [False, True])
def test_prefix_totals_equal_brute_force(spark, closed):
    events, probes = random_log(1, 400, USERS), random_log(2, 300, USERS)
    got = rel.prefix_totals(
        spark.createDataFrame(probes, SCHEMA).select("user", "at", "id", F.lit(closed).alias("closed")),
        spark.createDataFrame(events, SCHEMA).select("user", "at", "v", F.col("v").alias("top")),
        ["user"], {"v": "sum", "top": "max"},
    )
    want = []
    for user, moment, _, i in probes:
        seen = [
            e[2] for e in events
            if user is not None and e[0] == user and moment is not None and e[1] is not None
            and (e[1] < moment or closed and e[1] == moment)
        ]
        want.append((user, moment, i, sum(seen), max(seen, default=None)))
    key = lambda r: r[2]
    assert sorted(map(tuple, got.select("user", "at", "id", "v", "top").collect()), key=key) == sorted(want, key=key)


def test_latest_before_takes_the_largest_id_not_the_latest_time(spark):
    events = spark.createDataFrame(
        [("u", START, 9), ("u", START + dt.timedelta(hours=5), 3), ("u", START + dt.timedelta(days=3), 20)],
        "user string, at timestamp_ntz, id int",
    )
    probes = spark.createDataFrame(
        [("u", START), ("u", START + dt.timedelta(hours=6)), ("u", START + dt.timedelta(days=9)), (None, START)],
        "user string, at timestamp_ntz",
    )
    got = rel.latest_before(probes, events, ["user"], "id")
    assert rows(got, "user", "at", "id", "found_at") == [
        (None, START, None, None),
        ("u", START, None, None),
        ("u", START + dt.timedelta(hours=6), 9, START),
        ("u", START + dt.timedelta(days=9), 20, START + dt.timedelta(days=3)),
    ]


def test_latest_before_equals_brute_force(spark):
    events, probes = random_log(3, 300, USERS), random_log(4, 300, USERS)
    got = rel.latest_before(
        spark.createDataFrame(probes, SCHEMA).select("user", "at", F.col("id").alias("probe")),
        spark.createDataFrame(events, SCHEMA).select("user", "at", "id"), ["user"], "id",
    )
    want = {
        i: max(
            (e[3] for e in events if user and e[0] == user and moment and e[1] and e[1] < moment), default=None
        )
        for user, moment, _, i in probes
    }
    assert {r.probe: r.id for r in got.collect()} == want


@pytest.mark.parametrize("low_closed", [True, False])
@pytest.mark.parametrize("high_closed", [True, False])
def test_span_sums_equal_brute_force(spark, low_closed, high_closed):
    events, lines = random_log(5, 300, USERS), random_log(6, 200, USERS)
    span = rel.Span(F.col("at0"), F.col("at0") + F.expr("INTERVAL 3 DAYS"), low_closed, high_closed)
    got = rel.sum_in_spans(
        spark.createDataFrame(lines, SCHEMA).select("user", F.col("at").alias("at0"), "id"),
        spark.createDataFrame(events, SCHEMA).select("user", "at", "v"),
        ["user"], ["v"], {"in_": span},
    )
    want = {}
    for user, low, _, i in lines:
        total = 0
        for e in events:
            if user is None or low is None or e[0] != user or e[1] is None:
                continue
            high = low + dt.timedelta(days=3)
            after = e[1] >= low if low_closed else e[1] > low
            until = e[1] <= high if high_closed else e[1] < high
            total += e[2] if after and until else 0
        want[i] = total
    assert {r.id: r.in_v for r in got.collect()} == want


def test_hour_slots_bound_every_running_window(spark):
    """Rows of one key spread over its hours: no window group holds them all."""
    events = spark.range(20000).select(
        F.lit("u").alias("user"), (F.lit(START) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7).cast("int"))).alias("at"),
        F.lit(1).alias("v"),
    )
    probes = events.select("user", "at", F.lit(True).alias("closed"))
    plan = rel.prefix_totals(probes, events, ["user"], {"v": "sum"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [w.split(" ASC")[0] for w in plan.split("windowspecdefinition(")[1:] if "currentrow" in w]
    assert windows and all(w.startswith("_slot#") and "_slot#" not in w.split(",")[1] for w in windows)
    assert "_day, " in plan.split("AS _slot")[0] and "_hour, " in plan.split("AS _slot")[0]


def test_sparse_key_join_is_exact(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None), (5, "\u00007")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("\u00007", 12), (None, 13)], "rk string, v int")
    got = rel.left_join_sparse_key(left, right, "k", "rk", ["id"])
    assert rows(got, "id", "v") == [(1, 10), (1, 11), (2, None), (3, None), (4, None), (5, 12)]


def test_left_join_many_is_a_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", 7), ("a", 8), ("c", 9), (None, 5)], "k string, v int")
    got = rel.left_join_many(left, right, "k")
    assert rows(got, "x", "v") == rows(left.join(right, "k", "left"), "x", "v")


def test_repeated_rows_unfold_in_runs(spark):
    rows_ = spark.createDataFrame([("a", 2500), ("b", 1), ("c", None), ("d", 0)], "k string, n bigint")
    assert rows(rel.unfolded(rows_, "n").groupBy("k").count()) == [("a", 2500), ("b", 1), ("c", 1)]


def test_frequent_key_of_a_left_join_is_carried_as_a_count(spark):
    left = spark.createDataFrame([("hot", 1), ("cold", 2), ("none", 3)], "k string, x int")
    right = spark.range(5000).selectExpr("if(id < 4990, 'hot', 'cold') AS k", "1 AS v")
    got = rel.left_join_many(left, right, "k")
    assert rows(got.groupBy("x").count()) == [(1, 4990), (2, 10), (3, 1)]


def test_semi_join_with_few_values_is_spread(spark):
    many = spark.range(1000).selectExpr("id", "id % 3 AS m")
    known = spark.createDataFrame([(0,), (1,), (1,), (7,)], "m bigint")
    got = rel.semi_join_spread(many, known, "m", "id")
    assert got.columns == ["m", "id"] and got.count() == 667


def test_salts_follow_the_measured_rows(spark, monkeypatch):
    """A value of one row and one of 10,000: as many tasks as its rows ask for."""
    monkeypatch.setattr(rel, "SPREAD", 500)
    known = spark.range(10_000).selectExpr("id AS user", "'2018-02' AS m").union(
        spark.createDataFrame([(1, "2018-01")], "user bigint, m string"))
    many = known.union(spark.createDataFrame([(5, "2019-09")], "user bigint, m string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rel.semi_join_spread(many, known, "m", "user")
        tasks = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(t["count"] for t in tasks) == 10_001
    assert max(t["count"] for t in tasks) <= 4 * 500  # 20 salts, a few to a task by chance
    few = rel.semi_join_spread(many.where("user = 1"), known.where("user = 1"), "m", "user")
    assert rows(few) == [("2018-01", 1), ("2018-02", 1)] or rows(few, "user", "m") == [(1, "2018-01"), (1, "2018-02")]


def test_blank_keys_scatter_where_nothing_is_blank(spark):
    left = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "k string, id int")
    right = spark.createDataFrame([("a", "x")], "rk string, v string")
    got = rel.left_join_sparse_key(left, right, "k", "rk", ["id"], blanks_match=False)
    assert rows(got, "id", "v") == [(1, "x"), (2, None), (3, None)]


def test_semi_join_keeps_duplicates_and_never_fans_out(spark, make):
    users = make.users([("u", "C1", "2018-01-01"), ("u", "C2", "2018-01-01"), ("v", "Acme", "2018-01-01"), ("w", None, "2018-01-01")])
    events = spark.createDataFrame([("u", 1), ("u", 1), ("v", 2), ("w", 3), (None, 4)], "OpenId string, n int")
    assert rows(rel.keep_external(events, users, "acme")) == [("u", 1), ("u", 1)]


def test_pivot_keeps_null_group_and_unlisted_labels(spark):
    df = spark.createDataFrame([("u", "a", "x"), ("u", "a", "y"), (None, "b", "z"), ("w", "other", "q")], "k string, l string, v string")
    got = rel.pivot_max(df, ["k"], F.col("l"), F.col("v"), {"A": "a", "B": "b"})
    assert rows(got) == [(None, None, "z"), ("u", "y", None), ("w", None, None)]


def test_company_type_priority(make):
    company = make.company([
        ("p", "", "", 1, 1, 1), ("c", "", "", 0, 1, 1), ("u", "", "", 0, 0, 1), ("o", "", "", 0, 0, 0),
        ("m", "", "", 0, 0, 1), ("m", "", "", 0, 1, 0), ("n", "", "", None, None, None),
    ])
    assert rows(rel.company_types(company)) == [
        ("c", "Customer"), ("m", "Customer"), ("n", "Other"), ("o", "Other"), ("p", "Partner"), ("u", "University"),
    ]


def test_active_days_are_distinct(make):
    events = make.events([("u", "a", "2018-01-01 01:00"), ("u", "b", "2018-01-01 23:00"), ("u", "x", "2018-01-02"), (None, "a", "2018-01-03")])
    assert rows(rel.active_days(events, ["a", "b"])) == [("u", dt.date(2018, 1, 1))]
