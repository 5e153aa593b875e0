"""One check per rule that differs from plain Spark behaviour."""

import datetime as dt

from pyspark.sql import functions as F

from cohortia.functions import dates, payload, text
from cohortia.operators import experiments
from cohortia.operators import relational as rel
from tests.conftest import at, rows


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(value):
    return F.lit(value).cast("timestamp_ntz")


def test_month_difference_counts_month_starts(spark):
    got = one(
        spark,
        dates.month_diff(ts("2018-01-31"), ts("2018-02-01")),
        dates.month_diff(ts("2018-12-31 23:59:59"), ts("2019-01-01")),
        dates.month_diff(ts("2018-03-01"), ts("2018-03-31")),
        dates.month_diff(ts("2018-03-01"), ts("2017-12-31")),
    )
    assert got == (1, 1, 0, -3)


def test_hour_minute_and_day_differences_count_marks(spark):
    got = one(
        spark,
        dates.minute_diff(ts("2018-01-01 10:59:59"), ts("2018-01-01 11:00:00")),
        dates.hour_diff(ts("2018-01-01 10:59:59"), ts("2018-01-01 11:00:00")),
        dates.hour_diff(ts("2018-01-01 10:00:00"), ts("2018-01-01 10:59:59")),
        dates.hour_diff(ts("2018-01-02 00:10:00"), ts("2018-01-01 23:50:00")),
        dates.day_diff(ts("2018-01-01 23:59:59"), ts("2018-01-02 00:00:01")),
    )
    assert got == (1, 1, 0, -1, 1)


def test_differences_ignore_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # a daylight-saving night there
        got = one(spark, dates.hour_diff(ts("2018-03-11 00:30:00"), ts("2018-03-11 06:30:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == (6,)


def test_truncation_and_plus_days_keep_or_drop_time_as_asked(spark):
    got = one(
        spark,
        dates.month_start(ts("2018-05-17 12:00:00")),
        dates.plus_days(ts("2018-05-17 12:00:00"), 30),
        dates.plus_days(ts("2018-05-17 12:00:00"), 30) >= ts("2018-06-16"),
    )
    assert got == (dt.date(2018, 5, 1), at("2018-06-16 12:00"), True)


def test_masking_waits_for_the_boundary(spark):
    today = F.lit(dt.date(2018, 6, 1))
    day = lambda d: F.lit(dt.date(2018, 5, d))
    got = one(
        spark,
        dates.once_mature(F.date_add(day(1), 30), today, F.lit(1)),
        dates.once_mature(F.date_add(day(2), 30), today, F.lit(1)),
        dates.once_mature(F.lit(None).cast("date"), today, F.lit(1)),
    )
    assert got == (1, None, None)


def test_month_finished_is_strict(spark):
    got = one(
        spark,
        dates.month_finished(F.lit(dt.date(2018, 5, 1)), dt.date(2018, 6, 30)),
        dates.month_finished(F.lit(dt.date(2018, 6, 1)), dt.datetime(2018, 6, 30, 12)),
    )
    assert got == (True, False)


def test_negated_contains_drops_null_and_ignores_case(spark):
    df = spark.createDataFrame([("ACME x",), ("other",), (None,), ("acm",)], "c string")
    assert rows(df.where(text.lacks(F.col("c"), "Acme"))) == [("acm",), ("other",)]
    strict = df.where(text.lacks(F.col("c"), "Acme", case_insensitive=False))
    assert rows(strict) == [("ACME x",), ("acm",), ("other",)]


def test_like_signs_in_the_pattern_are_plain_text(spark):
    df = spark.createDataFrame([("50% off",), ("50x off",)], "c string")
    assert rows(df.where(text.contains(F.col("c"), "50%"))) == [("50% off",)]


def test_not_blank_ignores_trailing_blanks(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), (" x",)], "c string")
    assert rows(df.where(text.not_blank(F.col("c")))) == [(" x",)]


def test_concat_counts_null_as_empty(spark):
    assert one(spark, text.concat_blank(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == ("ab",)


def test_tutorial_names(spark):
    df = spark.createDataFrame(
        [("journey_A:4",), ("plain",), ("x:1",), ("a_b",), (None,)], "t string"
    ).select("t", text.tutorial_experiment(F.col("t")), text.tutorial_group(F.col("t")))
    assert rows(df) == [
        (None, "", None), ("a_b", "a_a_b", "b"), ("journey_A:4", "journey_4", "A"),
        ("plain", "plain", "p"), ("x:1", "1", "x"),
    ]


def test_equality_without_wildcards(spark):
    assert one(spark, text.same_text(F.lit("Closed"), "closed"), text.same_text(F.lit("Closed "), "closed")) == (True, False)


def test_json_scalars_and_containers(spark):
    doc = F.lit('{"a":{"b":1},"l":[1],"s":"[x]","t":true,"n":null,"A":"up"}')
    got = one(
        spark,
        *[payload.json_value(doc, p) for p in ("$.a", "$.l", "$.s", "$.t", "$.n", "$.a.b", "$.z", "$.A")],
        payload.json_query(doc, "$.a"), payload.json_query(doc, "$.l"), payload.json_query(doc, "$.s"),
    )
    assert got == (None, None, "[x]", "true", None, "1", None, "up", '{"b":1}', "[1]", None)


def test_json_fields_match_single_lookups(spark):
    df = spark.createDataFrame(
        [('{"x":"1","y":{"z":2}}',), ("not json",), ("",), (None,), ('{"X":"9"}',)], "d string"
    )
    fields = payload.json_fields(F.col("d"), ["x", "y"])
    got = df.select(fields["x"].alias("x"), fields["y"].alias("y"))
    assert rows(got) == [(None, None)] * 4 + [("1", None)]


def test_is_json_wants_a_container(spark):
    values = ['{"a":1}', " [1]", "5", '"x"', "{bad", "", None]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = [r[0] for r in df.select(payload.is_json(F.col("d"))).collect()]
    assert got == [True, True, False, False, False, False, False]


def test_is_json_skips_all_leading_white_space(spark):
    df = spark.createDataFrame([("\n {\"a\":1}",), ("\t\r\n[1]",), (" \n x",), ("\n",)], "d string")
    assert [r[0] for r in df.select(payload.is_json(F.col("d"))).collect()] == [True, True, False, False]


def test_open_json_row_counts(spark):
    values = {"object": '{"a":"1"}', "array": '[{"a":"1"},{"a":"2"}]', "empty": "[]", "blank": "", "null": None, "bad": "{"}
    df = spark.createDataFrame(list(values.items()), "name string, d string")
    out = df.select("name", F.explode(payload.open_json(F.col("d"), "struct<a:string>")).alias("j"))
    assert rows(out, "name", "j.a") == [("array", "1"), ("array", "2"), ("object", "1")]


def test_open_variant_row_counts(spark):
    values = {
        "object": '{"a":"1"}', "array": '[{"a":"1"},{"a":2}]', "empty": "[]", "blank": "", "null": None, "bad": "{",
        "scalar": "3", "text": '"[1]"', "json null": "null", "repeated key": '{"a":1,"a":2}', "mixed": '[{"a":"1"},7,null]',
    }
    df = spark.createDataFrame(list(values.items()), "name string, d string")
    out = df.select("name", F.explode(payload.open_variant(F.col("d"))).alias("j"))
    got = out.select("name", payload.scalar_at(F.col("j"), "$.a").alias("a"))
    assert rows(got) == [
        ("array", "1"), ("array", "2"), ("mixed", None), ("mixed", None), ("mixed", "1"), ("object", "1")]


def test_variant_scalars_and_levels(spark):
    doc = '{"a":{"b":1},"l":[1],"s":"[x]","v":"[1]","t":true,"n":null,"A":"up","e":"","d":1.50,"i":1.0}'
    value = F.try_parse_json(F.lit(doc))
    paths = ("$.a", "$.l", "$.s", "$.v", "$.t", "$.n", "$.a.b", "$.z", "$.A", "$.e", "$.d", "$.i")
    assert one(spark, *[payload.scalar_at(value, p) for p in paths]) == (
        None, None, "[x]", "[1]", "true", None, "1", None, "up", "", "1.5", "1")
    sizes = [F.size(payload.members(payload.at(value, p))) for p in ("$.a", "$.l", "$.s", "$.n", "$.z")]
    assert one(spark, *sizes) == (1, 1, None, None, None)


def test_unpivot_drops_null(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, None)], "id int, a int, b int")
    assert rows(rel.unpivot_values(df, ["id"], ["a", "b"])) == [(1, "a", 5)]


def test_zero_root_and_single_member_give_null(spark):
    long = spark.createDataFrame(
        [("A", "e", "m", 1), ("A", "e", "m", 1), ("B", "e", "m", 0), ("B", "e", "m", 0),
         ("A", "single", "m", 1), ("B", "single", "m", 0)],
        "ExperimentGroup string, Experiment string, Metric string, Value int",
    )
    got = experiments.ab_significance(long, as_of=dt.date(2019, 1, 1))
    assert rows(got, "Experiment", "N1", "Mu1", "Zscore") == [("e", 2, 1.0, None), ("single", 1, 1.0, None)]


def test_list_predicate_quotes(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("c",)], "EventType string")
    assert rows(df.where(rel.one_of("EventType", ["it's", "a\\b"]))) == [("a\\b",), ("it's",)]
