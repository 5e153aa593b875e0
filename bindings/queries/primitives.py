"""Building blocks on their own, straight over the benchmark tables."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings.queries.signup import elements, nested, value
from bindings.registry import register
from cohortia.functions import dates, payload, text
from cohortia.operators import relational as rel


def order_days(t):
    """Orders as dated events of a customer."""
    return t.raw("orders").select(
        F.col("o_custkey").alias("user"), F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("at"), "o_orderstatus", "o_orderpriority", "o_totalprice",
    )


def ship_days(t):
    """Line items as dated events of the user with the part's number."""
    return t.raw("lineitem").select(
        F.col("l_partkey").alias("user"), F.col("l_shipdate").alias("at"), "l_quantity",
        "l_returnflag", "l_orderkey", "l_linenumber",
    )


# --- scans and predicates ---------------------------------------------------------


@register(
    "p02_event_scan", "event_id:int user_id:int event_type ts:time", "",
    "result AS (SELECT * FROM events WHERE event_type IN ('purchase', 'signup'))",
)
def event_scan(t):
    log = t.raw("events").withColumnRenamed("event_type", "EventType")
    return rel.event_scan(log, ["purchase", "signup"]).withColumnRenamed("EventType", "event_type")


@register(
    "p03_time_bounded_scan", "event_id:int event_type ts:time", "",
    """result AS (SELECT * FROM events WHERE event_type IN ('click', 'view')
      AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 12:00:00')""",
)
def time_bounded_scan(t):
    log = t.raw("events").withColumnsRenamed({"event_type": "EventType", "ts": "Timestamp"})
    bounds = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12, 12))
    return rel.event_scan(log, ["click", "view"], between=bounds).withColumnsRenamed(
        {"EventType": "event_type", "Timestamp": "ts"}
    )


@register(
    "p13_p22_predicates_and_labels",
    "p_partkey:int p_name priority size_class brand_known:int missing_note", "",
    """result AS (
  SELECT p_partkey, p_name, CASE WHEN p_size > 40 THEN 'big' WHEN p_size > 20 THEN 'medium' ELSE 'small' END AS size_class,
    CASE WHEN p_type = 'ECONOMY' THEN 'Economy' WHEN p_brand LIKE 'Brand#1%' THEN 'First brands' ELSE 'Other' END AS priority,
    CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 1 ELSE 0 END AS brand_known, CAST(NULL AS VARCHAR) AS missing_note
  FROM part WHERE p_name NOT ILIKE '%RED%' AND rtrim(p_brand) <> '' AND p_size BETWEEN 5 AND 45
    AND (p_type <> 'SMALL' OR p_retailprice > 950) AND p_brand IS NOT NULL)""",
)
def predicates(t):
    size = F.col("p_size")
    return t.raw("part").where(
        text.lacks(F.col("p_name"), "RED") & text.not_blank(F.col("p_brand"))
        & size.between(5, 45)
        & ((F.col("p_type") != "SMALL") | (F.col("p_retailprice") > 950))
        & F.col("p_brand").isNotNull()
    ).select(
        "p_partkey", "p_name",
        F.when(size > 40, "big").when(size > 20, "medium").otherwise("small").alias("size_class"),
        F.when(F.col("p_type") == "ECONOMY", "Economy")
        .when(F.col("p_brand").startswith("Brand#1"), "First brands")
        .otherwise("Other")
        .alias("priority"),
        rel.flag(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")).alias("brand_known"),
        F.lit(None).cast("string").alias("missing_note"),
    )


@register(
    "p24_p25_defaults_and_masking", "o_orderkey:int comment_length:int masked:double", "",
    """result AS (
  SELECT o_orderkey, coalesce(n_chars, 0) AS comment_length,
    CASE WHEN o_orderdate + INTERVAL 30 DAY < TIMESTAMP '1999-01-01' THEN o_totalprice END AS masked
  FROM orders LEFT JOIN documents ON doc_id = o_orderkey)""",
)
def defaults_and_masking(t):
    docs = t.raw("documents").select(F.col("doc_id").alias("o_orderkey"), "n_chars")
    until = dates.plus_days(F.col("o_orderdate"), 30)
    return t.raw("orders").join(docs, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("n_chars", F.lit(0)).alias("comment_length"),
        dates.once_mature(until, dates.as_instant(dt.date(1999, 1, 1)), F.col("o_totalprice")).alias(
            "masked"
        ),
    )


@register(
    "p26_internal_exclusion", "c_custkey:int c_mktsegment", "",
    "result AS (SELECT * FROM customer WHERE c_mktsegment NOT ILIKE '%build%')",
)
def internal_exclusion(t):
    return t.raw("customer").where(text.lacks(F.col("c_mktsegment"), "BUILD"))


@register(
    "p08_staged_table", "event_type days:int users:int", "",
    """result AS (SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT user_id) AS users FROM events GROUP BY 1)""",
)
def staged_table(t):
    """The distinct user days that a job would stage, and what is read from them; the
    write itself is tested with a folder of its own."""
    days = t.raw("events").select("event_type", "user_id", F.to_date("ts").alias("day")).distinct()
    return days.groupBy("event_type").agg(
        F.countDistinct("day").alias("days"), F.countDistinct("user_id").alias("users")
    )


# --- joins ------------------------------------------------------------------------


@register(
    "p27_left_join", "c_custkey:int orders:int spent:double", "",
    """result AS (
  SELECT c_custkey, coalesce(n, 0) AS orders, s AS spent FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON c_custkey = o_custkey)""",
)
def left_join(t):
    spent = (
        t.raw("orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spent"))
    )
    return t.raw("customer").join(spent, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), "spent"
    )


@register(
    "p28_left_join_two_keys", "c_nationkey:int c_mktsegment customers:int suppliers:int", "",
    """result AS (
  SELECT a.c_nationkey, a.c_mktsegment, customers, suppliers
  FROM (SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer GROUP BY ALL) a
  LEFT JOIN (SELECT s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS segment, count(*) AS suppliers
    FROM supplier GROUP BY ALL) b ON a.c_nationkey = b.s_nationkey AND a.c_mktsegment = b.segment)""",
)
def left_join_two_keys(t):
    keys = ["c_nationkey", "c_mktsegment"]
    customers = t.raw("customer").groupBy(*keys).agg(F.count(F.lit(1)).alias("customers"))
    segment = F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY")
    suppliers = (
        t.raw("supplier")
        .groupBy(F.col("s_nationkey").alias("c_nationkey"), segment.alias("c_mktsegment"))
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )
    return customers.join(suppliers, keys, "left")


@register(
    "p29_right_join", "user_id:int event_id:int c_custkey:int", "",
    """result AS (SELECT user_id, event_id, c_custkey FROM (SELECT * FROM events WHERE event_type = 'purchase')
      RIGHT JOIN customer ON user_id = c_custkey)""",
)
def right_join(t):
    bought = t.raw("events").where("event_type = 'purchase'").select("user_id", "event_id")
    users = t.raw("customer").select("c_custkey", F.col("c_custkey").alias("key"))
    return rel.left_join_many(users, bought.withColumn("key", F.col("user_id")), "key")


@register(
    "p30_users_by_month", "user:int month:date orders:int", "",
    """
first AS (SELECT o_custkey AS user, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS start FROM orders GROUP BY 1),
months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
result AS (
  SELECT f.user, m.month, count(o_orderkey) AS orders FROM first f, months m
  LEFT JOIN orders ON o_custkey = f.user AND date_trunc('month', o_orderdate) = m.month
  WHERE f.start <= m.month GROUP BY f.user, m.month)""",
)
def users_by_month(t):
    """Every month of the table since the first order, unfolded per user instead of
    crossing users with a calendar."""
    monthly = order_days(t).groupBy("user", dates.month_start(F.col("at")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    last = monthly.agg(F.max("month")).scalar()
    spine = monthly.groupBy("user").agg(F.min("month").alias("start")).select(
        "user",
        F.explode(F.sequence("start", last, F.expr("interval 1 month"))).alias("month"),
    )
    return (
        rel.semi_join_spread(spine, monthly, "month", "user")
        .join(monthly, ["user", "month"], "left")
        .select("user", "month", F.coalesce("orders", F.lit(0)).alias("orders"))
    )


def _spans(low_closed: bool, high_closed: bool):
    def build(t):
        orders = order_days(t).select("user", "id", "at")
        shipped = ship_days(t).select("user", "at", F.lit(1).alias("n"), "l_quantity")
        rows = orders.withColumnRenamed("at", "ordered")
        span = rel.Span(
            dates.plus_days(F.col("ordered"), -30), dates.plus_days(F.col("ordered"), 30),
            low_closed, high_closed,
        )
        return rel.sum_in_spans(rows, shipped, ["user"], ["n", "l_quantity"], {"": span})

    return build


def _spans_sql(above: str, below: str) -> str:
    return f"""result AS (
  SELECT o_custkey AS user, o_orderkey AS id, o_orderdate AS ordered, count(l_shipdate) AS n, coalesce(sum(l_quantity), 0) AS l_quantity
  FROM orders LEFT JOIN lineitem ON l_partkey = o_custkey AND l_shipdate {above} o_orderdate - INTERVAL 30 DAY
    AND l_shipdate {below} o_orderdate + INTERVAL 30 DAY
  GROUP BY 1, 2, 3)"""


_SPAN_SCHEMA = "user:int id:int ordered:time n:int l_quantity:double"
register("p31_closed_window_sums", _SPAN_SCHEMA, "", _spans_sql(">=", "<="))(_spans(True, True))
register("p32_open_window_sums", _SPAN_SCHEMA, "", _spans_sql(">", "<"))(_spans(False, False))


@register(
    "p33_latest_before", "user:int l_orderkey:int l_linenumber:int at:time id:int found_at:time", "",
    """
last AS (
  SELECT l_partkey, l_shipdate, max(o_orderkey) AS id
  FROM (SELECT DISTINCT l_partkey, l_shipdate FROM lineitem) JOIN orders ON o_custkey = l_partkey AND o_orderdate < l_shipdate
  GROUP BY ALL),
result AS (
  SELECT l.l_partkey AS user, l_orderkey, l_linenumber, l.l_shipdate AS at, id, o_orderdate AS found_at
  FROM lineitem l LEFT JOIN last m ON l.l_partkey = m.l_partkey AND l.l_shipdate = m.l_shipdate LEFT JOIN orders ON id = o_orderkey)""",
)
def latest_before(t):
    """Line items of a user on one day ask the same question once."""
    shipped = ship_days(t).select("user", "at", "l_orderkey", "l_linenumber")
    asked = shipped.select("user", "at").distinct()
    found = rel.latest_before(asked, order_days(t).select("user", "at", "id"), ["user"], "id")
    return shipped.join(found, ["user", "at"], "left")


@register(
    "p34_last_earlier_month", "user:int month:date last_before:date gap:int", "",
    """
monthly AS (
  SELECT o_custkey AS user, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(max(o_orderdate) AS DATE) AS last
  FROM orders GROUP BY 1, 2),
result AS (
  SELECT a.user, a.month, max(b.last) AS last_before, date_diff('month', max(b.last), a.month) AS gap
  FROM monthly a LEFT JOIN monthly b ON a.user = b.user AND b.month < a.month GROUP BY 1, 2)""",
)
def last_earlier_month(t):
    monthly = order_days(t).groupBy("user", dates.month_start(F.col("at")).alias("month")).agg(
        F.to_date(F.max("at")).alias("last")
    )
    earlier = (
        Window.partitionBy("user")
        .orderBy(dates.month_index(F.col("month")))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return monthly.withColumn("last_before", F.max("last").over(earlier)).withColumn(
        "gap", dates.month_diff(F.col("last_before"), F.col("month"))
    )


@register(
    "p35_semi_join", "o_orderkey:int o_custkey:int", "",
    """result AS (SELECT o_orderkey, o_custkey FROM orders a WHERE o_custkey =
      (SELECT max(c_custkey) FROM customer b WHERE a.o_custkey = b.c_custkey AND c_mktsegment NOT ILIKE '%build%'))""",
)
def semi_join(t):
    keep = t.raw("customer").where(text.lacks(F.col("c_mktsegment"), "build"))
    return t.raw("orders").join(keep, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@register(
    "p36_anti_join", "c_custkey:int c_name", "",
    """result AS (SELECT c.* FROM customer c LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') e
      ON c_custkey = user_id WHERE user_id IS NULL)""",
)
def anti_join(t):
    bought = t.raw("events").where("event_type = 'purchase'").select("user_id").distinct()
    return t.raw("customer").join(bought, F.col("c_custkey") == F.col("user_id"), "left_anti")


@register(
    "p37_p38_star_join", "o_orderkey:int c_name n_name r_name events:int", "",
    """result AS (
  SELECT o_orderkey, c_name, n_name, r_name, coalesce(e.n, 0) AS events
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON user_id = o_custkey
  WHERE r_name <> 'ASIA')""",
)
def star_join(t):
    seen = t.raw("events").groupBy(F.col("user_id").alias("o_custkey")).agg(F.count(F.lit(1)).alias("n"))
    places = t.raw("nation").join(
        t.raw("region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    people = (
        t.raw("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .withColumnRenamed("c_custkey", "o_custkey")
        .join(seen, "o_custkey", "left")
    )
    return (
        t.raw("orders").join(people, "o_custkey", "inner")
        .select("o_orderkey", "c_name", "n_name", "r_name", F.coalesce("n", F.lit(0)).alias("events"))
    )


@register(
    "p27_left_join_sparse_key", "o_orderkey:int owner c_name", "",
    """result AS (
  SELECT o_orderkey, owner, c_name FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS owner FROM orders)
  LEFT JOIN customer ON owner = CAST(c_custkey AS VARCHAR))""",
)
def left_join_sparse_key(t):
    """Two thirds of the keys are NULL; they scatter instead of meeting in one task."""
    rows = t.raw("orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).alias("owner")
    )
    people = t.raw("customer").select(F.col("c_custkey").cast("string").alias("person"), "c_name")
    return rel.left_join_sparse_key(rows, people, "owner", "person", ["o_orderkey"])


# --- aggregates --------------------------------------------------------------------


@register(
    "p40_p47_aggregates",
    "l_returnflag l_linestatus rows:int large:int any_discount:int suppliers:int dated:int mean:double whole_mean:int first:time last:time",
    "",
    """result AS (
  SELECT l_returnflag, l_linestatus, count(*) AS rows, sum(CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END) AS large,
    max(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS any_discount, count(DISTINCT l_suppkey) AS suppliers, count(l_shipdate) AS dated,
    avg(l_extendedprice) AS mean, trunc(avg(l_linenumber)) AS whole_mean, min(l_shipdate) AS first, max(l_shipdate) AS last
  FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
)
def aggregates(t):
    return t.raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"),
        rel.count_if(F.col("l_quantity") > 30).alias("large"),
        F.max(rel.flag(F.col("l_discount") > 0.09)).alias("any_discount"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.count("l_shipdate").alias("dated"),
        F.avg("l_extendedprice").alias("mean"),
        F.avg("l_linenumber").cast("int").alias("whole_mean"),
        F.min("l_shipdate").alias("first"),
        F.max("l_shipdate").alias("last"),
    )


@register(
    "p44_conditional_pivot", "event_type first_half:double second_half:double users_first:int", "",
    """result AS (
  SELECT event_type, sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END) AS first_half,
    sum(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END) AS second_half,
    count(DISTINCT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN user_id END) AS users_first
  FROM events GROUP BY event_type)""",
)
def conditional_pivot(t):
    early = F.col("ts") < dates.as_instant(dt.date(2024, 1, 16))
    return t.raw("events").groupBy("event_type").agg(
        F.sum(F.when(early, F.col("value"))).alias("first_half"),
        F.sum(F.when(~early, F.col("value"))).alias("second_half"),
        F.countDistinct(F.when(early, F.col("user_id"))).alias("users_first"),
    )


@register(
    "p48_p51_distinct_and_two_levels", "year:int month:date active_users:int user_days:int", "",
    """
days AS (SELECT DISTINCT o_custkey AS user, CAST(o_orderdate AS DATE) AS day FROM orders),
result AS (
  SELECT year(day) AS year, date_trunc('month', day) AS month, count(DISTINCT "user") AS active_users, count(*) AS user_days
  FROM days GROUP BY 1, 2)""",
)
def two_levels(t):
    log = t.raw("orders").select(
        F.col("o_custkey").alias("OpenId"), F.col("o_orderdate").alias("Timestamp"),
        F.col("o_orderstatus").alias("EventType"),
    )
    days = rel.active_days(log, ["F", "O", "P"], "day")
    return days.groupBy(F.year("day").alias("year"), dates.month_start(F.col("day")).alias("month")).agg(
        F.countDistinct("OpenId").alias("active_users"), F.count(F.lit(1)).alias("user_days")
    )


@register(
    "p52_sample_variance", "o_orderpriority o_orderstatus n:int mean:double variance:double", "",
    """
moments AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n, avg(o_totalprice / 1000) AS mean FROM orders GROUP BY ALL),
result AS (
  SELECT o_orderpriority, o_orderstatus, n, mean, CASE WHEN n > 1 THEN sum(power(o_totalprice / 1000 - mean, 2)) / (n - 1) END AS variance
  FROM orders JOIN moments USING (o_orderpriority, o_orderstatus) GROUP BY o_orderpriority, o_orderstatus, n, mean)""",
)
def sample_variance(t):
    price = F.col("o_totalprice") / 1000
    return t.raw("orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.avg(price).alias("mean"), F.var_samp(price).alias("variance")
    )


# --- sets and reshaping ---------------------------------------------------------------


@register(
    "p53_union_distinct", "user:int", "",
    "result AS (SELECT user_id AS user FROM events WHERE event_type = 'purchase' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def union_distinct(t):
    bought = t.raw("events").where("event_type = 'purchase'").select(F.col("user_id").alias("user"))
    pending = t.raw("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user"))
    return bought.union(pending).distinct()


_PRIORITY = {"urgent": "1-URGENT", "high": "2-HIGH", "low": "5-LOW"}


@register(
    "p55_pivot", "o_custkey:int urgent:double high:double low:double", "",
    """result AS (
  SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
    max(o_totalprice) FILTER (WHERE o_orderpriority = '2-HIGH') AS high, max(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS low
  FROM orders GROUP BY o_custkey)""",
)
def pivot(t):
    return rel.pivot_max(
        t.raw("orders"), ["o_custkey"], F.col("o_orderpriority"), F.col("o_totalprice"), _PRIORITY
    )


@register(
    "p56_unpivot", "o_custkey:int Metric Value:double", "",
    """result AS (SELECT o_custkey, 'urgent' AS Metric, max(o_totalprice) AS Value FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
  UNION ALL SELECT o_custkey, 'high', max(o_totalprice) FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1
  UNION ALL SELECT o_custkey, 'low', max(o_totalprice) FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1)""",
)
def unpivot(t):
    return rel.unpivot_values(pivot(t), ["o_custkey"], list(_PRIORITY))


# --- expressions ---------------------------------------------------------------------


@register(
    "p57_p65_dates",
    "event_id:int day:date month:date shifted:time year:int days:int months:int hours:int minutes:int finished:bool",
    "",
    """result AS (
  SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('month', ts) AS month, ts + INTERVAL 30 DAY AS shifted, year(ts) AS year,
    date_diff('day', TIMESTAMP '2024-01-10 10:59:59', ts) AS days, date_diff('month', TIMESTAMP '2023-12-31 23:00:00', ts) AS months,
    date_diff('hour', TIMESTAMP '2024-01-10 10:59:59', ts) AS hours, date_diff('minute', TIMESTAMP '2024-01-10 10:59:59', ts) AS minutes,
    date_trunc('month', ts) < DATE '2024-02-01' AS finished
  FROM events)""",
)
def date_functions(t):
    ts, mark = F.col("ts"), dates.as_instant(dt.datetime(2024, 1, 10, 10, 59, 59))
    eve = dates.as_instant(dt.datetime(2023, 12, 31, 23))
    month = dates.month_start(ts)
    return t.raw("events").select(
        "event_id", F.to_date(ts).alias("day"), month.alias("month"),
        dates.plus_days(ts, 30).alias("shifted"), F.year(ts).alias("year"),
        dates.day_diff(mark, ts).alias("days"), dates.month_diff(eve, ts).alias("months"),
        dates.hour_diff(mark, ts).alias("hours"), dates.minute_diff(mark, ts).alias("minutes"),
        dates.month_finished(month, dt.date(2024, 2, 3)).alias("finished"),
    )


@register(
    "p66_p69_text_and_math",
    "c_custkey:int label experiment grp position:int rooted:double squared:double whole:int unreadable:int", "",
    """result AS (
  SELECT c_custkey, coalesce(c_name, '') || ' - ' || coalesce(c_mktsegment, '') AS label,
    left(tag, position('_' IN tag)) || substr(tag, position(':' IN tag) + 1) AS experiment, substr(tag, position('_' IN tag) + 1, 1) AS grp,
    position('#' IN c_name) AS position, sqrt(abs(c_acctbal)) AS rooted, power(c_acctbal, 2) AS squared,
    CAST(CAST(c_custkey AS VARCHAR) AS INTEGER) AS whole, TRY_CAST(c_name AS INTEGER) AS unreadable
  FROM (SELECT *, CASE WHEN c_custkey % 9 = 8 THEN 'plain' ELSE 'journey_' || chr(CAST(65 + c_custkey % 2 AS INTEGER)) || ':' || (c_custkey % 5) END AS tag
    FROM customer))""",
)
def text_and_math(t):
    tag = F.expr(
        "if(c_custkey % 9 = 8, 'plain', concat('journey_', chr(65 + c_custkey % 2), ':', c_custkey % 5))"
    )
    return t.raw("customer").withColumn("tag", tag).select(
        "c_custkey",
        text.concat_blank(F.col("c_name"), F.lit(" - "), F.col("c_mktsegment")).alias("label"),
        text.tutorial_experiment(F.col("tag")).alias("experiment"),
        text.tutorial_group(F.col("tag")).alias("grp"),
        F.locate("#", "c_name").alias("position"),
        F.sqrt(F.abs("c_acctbal")).alias("rooted"),
        F.pow("c_acctbal", F.lit(2)).alias("squared"),
        F.col("c_custkey").cast("string").cast("int").alias("whole"),
        F.col("c_name").try_cast("int").alias("unreadable"),
    )


_PAYLOAD = """(CASE WHEN event_id % 11 = 10 THEN 'not json' WHEN event_id % 13 = 12 THEN ''
    ELSE '{"props":' || props || ',"type":"' || event_type || '","list":[1,2]}' END)"""


@register(
    "p70_p73_json_values", "event_id:int k type_name object_as_scalar object array valid:bool", "",
    f"""result AS (
  SELECT event_id, {value('doc', '$.props.k')} AS k, {value('doc', '$.type')} AS type_name, {value('doc', '$.props')} AS object_as_scalar,
    replace({nested('doc', '$.props')}, ' ', '') AS object, {nested('doc', '$.list')} AS "array",
    json_valid(doc) AND doc <> '' AS valid
  FROM (SELECT event_id, {_PAYLOAD} AS doc FROM events))""",
)
def json_values(t):
    doc = F.expr(
        """CASE WHEN event_id % 11 = 10 THEN 'not json' WHEN event_id % 13 = 12 THEN ''
           ELSE concat('{"props":', props, ',"type":"', event_type, '","list":[1,2]}') END"""
    )
    return t.raw("events").withColumn("doc", doc).select(
        "event_id",
        payload.json_value(F.col("doc"), "$.props.k").alias("k"),
        payload.json_value(F.col("doc"), "$.type").alias("type_name"),
        payload.json_value(F.col("doc"), "$.props").alias("object_as_scalar"),
        payload.json_query(F.col("doc"), "$.props").alias("object"),
        payload.json_query(F.col("doc"), "$.list").alias("array"),
        payload.is_json(F.col("doc")).alias("valid"),
    )


_NESTED = (
    """'[{"flag":"' || l_returnflag || '","items":[{"line":' || l_linenumber || '},{"line":"' || l_linestatus || '"}]}]'"""
)


@register(
    "p74_p76_nested_json", "l_returnflag line rows:int orders:int", "",
    f"""
docs AS (SELECT l_orderkey, {_NESTED} AS doc FROM lineitem),
outer_rows AS (SELECT l_orderkey, unnest({elements('doc')}) AS o FROM docs),
inner_rows AS (SELECT l_orderkey, {value('o', '$.flag')} AS l_returnflag, unnest({elements("json_extract(o, '$.items')")}) AS i FROM outer_rows),
result AS (
  SELECT l_returnflag, {value('i', '$.line')} AS line, count(*) AS rows, count(DISTINCT l_orderkey) AS orders FROM inner_rows GROUP BY 1, 2)""",
)
def nested_json(t):
    doc = F.expr(
        """concat('[{"flag":"', l_returnflag, '","items":[{"line":', l_linenumber, '},{"line":"', l_linestatus, '"}]}]')"""
    )
    outer = t.raw("lineitem").select(
        "l_orderkey", F.explode(payload.open_variant(doc)).alias("o")
    )
    inner = outer.select(
        "l_orderkey", payload.scalar_at(F.col("o"), "$.flag").alias("l_returnflag"),
        F.explode(payload.members(payload.at(F.col("o"), "$.items"))).alias("i"),
    )
    return inner.groupBy("l_returnflag", payload.scalar_at(F.col("i"), "$.line").alias("line")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("l_orderkey").alias("orders")
    )


# --- business predicates -----------------------------------------------------------------


@register(
    "p77_first_event", "OpenId:int first:time", "",
    "result AS (SELECT user_id AS OpenId, min(ts) AS first FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1)",
)
def first_event(t):
    log = t.raw("events").withColumnsRenamed(
        {"user_id": "OpenId", "event_type": "EventType", "ts": "Timestamp"}
    )
    return rel.first_event(log, ["purchase", "signup"], "first")


@register(
    "p78_active_day_flags", "OpenId:int Day:date buys:int looks:int", "",
    """result AS (
  SELECT user_id AS OpenId, CAST(ts AS DATE) AS Day, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS buys,
    max(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS looks
  FROM events WHERE event_type IN ('purchase', 'view', 'click') GROUP BY 1, 2)""",
)
def active_day_flags(t):
    log = t.raw("events").withColumnsRenamed(
        {"user_id": "OpenId", "event_type": "EventType", "ts": "Timestamp"}
    )
    return rel.day_flags(log, {"buys": ["purchase"], "looks": ["view", "click"]})


@register(
    "p80_company_types", "CompanyId CompanyType", "company_current",
    """result AS (
  SELECT CompanyId, CASE WHEN sum(IsPartner) > 0 THEN 'Partner' WHEN sum(IsCustomer) > 0 THEN 'Customer'
    WHEN sum(IsUniversity) > 0 THEN 'University' ELSE 'Other' END AS CompanyType FROM company_current GROUP BY 1)""",
)
def company_types(t):
    return rel.company_types(t.company_current())
