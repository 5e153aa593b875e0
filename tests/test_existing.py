import datetime as dt
import random

from pyspark.sql import functions as F

from bindings import rules
from bindings.spark_views import Tables
from cohortia.operators import existing
from cohortia.operators import relational as rel
from cohortia.sources import tables, taxonomy
from tests.conftest import by_key, day, rows

TYPES = taxonomy.activity_types("Acme")


def rules_types():
    return taxonomy.activity_types(rules.PRODUCT)


AS_OF = dt.date(2019, 6, 15)


def monthly(make, months, users, events=()):
    return existing.monthly_existing_users(
        make.months(months), make.users(users), make.events(list(events)), types=TYPES, internal="acme"
    )


USERS = [("u", "C1", "2018-01-10 09:00"), ("n", "C1", None), ("own", "Acme", "2018-01-01"), ("", "C1", "2018-01-01")]


def test_existing_after_more_than_thirty_days(make):
    got = monthly(
        make,
        [("u", "2018-02-01", "2018-02-09"), ("u", "2018-03-01", "2018-02-10"), ("n", "2018-03-01", "2018-03-05"),
         ("u", "2018-04-01", "2018-04-05", "Business", "Inactive"), ("own", "2018-03-01", "2018-03-05", "x", "Active", "ACME hq"),
         ("", "2018-03-01", "2018-03-05"), ("u", "2018-05-01", "2018-05-05", "x", "Active", None)],
        USERS,
    )
    assert rows(got, "UserId", "MonthYear", "ExistingUser") == [
        ("n", day("2018-03-01"), 0), ("u", day("2018-02-01"), 0), ("u", day("2018-03-01"), 1),
    ]


def test_two_user_types_in_a_month_make_one_row(make):
    got = monthly(make, [("u", "2018-03-01", "2018-03-05", "Business"), ("u", "2018-03-01", "2018-03-05", "Developer")], USERS)
    assert rows(got, "UserId", "IsDeveloper") == [("u", 1)]


def test_second_month_window_is_closed(make):
    events = [("u", "AppLogin", t) for t in (
        "2018-04-03 23:00", "2018-04-04 10:00", "2018-04-04 11:00", "2018-05-04 23:59", "2018-05-05")]
    got = monthly(make, [("u", "2018-03-01", "2018-03-05")], USERS, [*events, ("u", "Unlisted", "2018-04-20"), (None, "AppLogin", "2018-04-20")])
    assert rows(got, "DaysActiveInSecondMonth") == [(2,)]


def flags(make, months, users=USERS, events=()):
    return existing.existing_user_churn_flags(monthly(make, months, users, events), as_of=AS_OF)


def test_churn_needs_a_gap_over_one_month(make):
    got = flags(make, [("u", "2018-03-01", "2018-03-05"), ("u", "2018-04-01", "2018-04-05"), ("u", "2018-06-01", "2018-06-05")])
    assert by_key(got, "MonthYear", "LastActiveDateBeforeMonth", "IsChurner") == {
        day("2018-03-01"): (None, 0), day("2018-04-01"): (day("2018-03-05"), 0), day("2018-06-01"): (day("2018-04-05"), 1),
    }


def test_earlier_months_count_even_if_inactive_but_not_before_signup(make):
    got = flags(make, [
        ("u", "2017-12-01", "2017-12-20"), ("u", "2018-02-01", "2018-02-25", "x", "Inactive"), ("u", "2018-03-01", "2018-03-20"),
        ("u", "2018-08-01", "2018-10-09", "x", "Inactive"), ("u", "2018-09-01", "2018-09-02"),
    ])
    assert by_key(got, "MonthYear", "LastActiveDateBeforeMonth", "IsChurner") == {
        day("2018-03-01"): (day("2018-02-25"), 0),
        day("2018-09-01"): (day("2018-10-09"), 0),  # an inactive month may carry a later date
    }


def test_unfinished_and_immature_months(make):
    got = flags(make, [("u", f"2019-{m:02}-01", f"2019-{m:02}-02") for m in (2, 3, 4, 5, 6)],
                events=[("u", "AppLogin", "2019-04-10")])
    # 2 Mar + 30 days .. + 60 days holds 10 Apr; so does 2 Feb's second month not.
    assert by_key(got, "MonthYear", "DaysActiveInSecondMonth", "ExistingUsersActiveInSecondMonth", "ExistingUsersNotActiveInSecondMonth") == {
        day("2019-02-01"): (0, 0, 1), day("2019-03-01"): (1, 1, 0), day("2019-04-01"): (0, 0, 0), day("2019-05-01"): (0, 0, 0),
    }


def test_user_types_and_certificates(make, spark):
    months = [("u", "2018-03-01", "2018-03-05"), ("u", "2018-04-01", "2018-04-05"), ("u", "2018-08-01", "2018-08-05"), ("u", "2019-01-01", "2019-01-05")]
    users = make.users(USERS).selectExpr(
        "* EXCEPT (RapidCertifiedDate, ExpertCertifiedDate)", "DATE'2018-04-01' AS RapidCertifiedDate", "DATE'2018-12-31' AS ExpertCertifiedDate"
    )
    rows_ = flags(make, months)
    got = existing.existing_users_certified(rows_, users)
    assert by_key(got, "MonthYear", "ExistingUserType", "Certification") == {
        day("2018-03-01"): ("New Existing User", "NotCertified"),
        day("2018-04-01"): ("Existing User", "NotCertified"),  # the same day is not before
        day("2018-08-01"): ("Resurrected Existing User", "RapidCertified"),
        day("2019-01-01"): ("Resurrected Existing User", "ExpertCertified"),
    }
    yearly = existing.existing_users_by_year(rows_, users)
    assert by_key(yearly, "Year", "Certification") == {2018: "ExpertCertified", 2019: "NotCertified"}


def resurrected(make, months, users=USERS):
    return existing.resurrection(make.months(months), make.users(users), as_of=AS_OF, internal="acme")


def calendar(first, last):
    """A quiet filler user with a row in every month, to make the months known."""
    out, at = [], dt.date.fromisoformat(first)
    while at <= dt.date.fromisoformat(last):
        out.append(("filler", at.isoformat(), at.isoformat()))
        at = (at.replace(day=28) + dt.timedelta(days=5)).replace(day=1)
    return out


def test_resurrection_gaps(make):
    got = resurrected(make, [
        *calendar("2017-12-01", "2019-06-01"), ("u", "2018-02-01", "2018-02-20"), ("u", "2018-05-01", "2018-05-09"),
        ("u", "2019-06-01", "2019-06-09"),
    ])
    found = by_key(got, "MonthYear", "IsCurrentChurner", "IsNonCurrentChurner", "Resurrected", "CurrentChurnersResurrected")
    assert found[day("2018-04-01")] == (1, 0, 0, 0)
    assert found[day("2018-05-01")] == (1, 0, 1, 1)
    assert day("2018-06-01") not in found  # one month after activity
    assert found[day("2019-05-01")] == (1, 0, 0, 0)  # gap 12
    assert day("2019-06-01") not in found  # unfinished
    assert sorted(found)[0] == day("2018-04-01")


def test_resurrection_of_an_older_churner_and_a_silent_month(make):
    months = [m for m in calendar("2017-12-01", "2019-06-01") if m[1] != "2018-06-01"]
    found = by_key(
        resurrected(make, [*months, ("u", "2018-02-01", "2018-02-20"), ("u", "2019-03-01", "2019-03-09")]),
        "MonthYear", "IsCurrentChurner", "IsNonCurrentChurner", "Resurrected", "NonCurrentChurnersResurrected",
    )
    assert found[day("2019-03-01")] == (0, 1, 1, 1)  # gap 13
    assert day("2018-06-01") not in found  # a month nobody was active in


def test_resurrection_matches_the_crossed_form(make, spark):
    """Random months against the literal users x months formulation in SQL."""
    draw = random.Random(11)
    people = [f"u{i}" for i in range(12)]
    users = [(u, "C1", draw.choice(["2017-11-15", "2018-03-01", "2018-07-20 10:00", None])) for u in people]
    months = []
    for u in people:
        for m in draw.sample(range(20), 6):
            first = dt.date(2017 + (10 + m) // 12, (10 + m) % 12 + 1, 1)
            for _ in range(draw.choice([1, 1, 2])):
                last = first + dt.timedelta(days=draw.randrange(0, 50))
                months.append((u, first.isoformat(), last.isoformat(), "x", draw.choice(["Active", "Inactive"]),
                               draw.choice(["C1", "C1", "Acme", None])))
    make.months(months).createOrReplaceTempView("um")
    make.users(users).createOrReplaceTempView("uc")
    want = spark.sql("""
      WITH seen AS (
        SELECT s.UserId, s.MonthYear, max(b.LastActiveDateInMonth) AS last, s.SignupDate
        FROM (SELECT DISTINCT u.UserId, m.MonthYear, c.OldSignupDate AS SignupDate
              FROM (SELECT DISTINCT MonthYear FROM um) m CROSS JOIN
                   (SELECT DISTINCT UserId FROM um WHERE NOT lower(CompanyId) LIKE '%acme%') u
              JOIN uc c ON c.OpenId = u.UserId WHERE c.OldSignupDate <= m.MonthYear) s
        JOIN um b ON b.UserId = s.UserId AND b.MonthYear < s.MonthYear AND b.LastActiveDateInMonth >= s.SignupDate
        GROUP BY s.UserId, s.MonthYear, s.SignupDate),
      gaps AS (SELECT *, (year(MonthYear) - year(last)) * 12 + month(MonthYear) - month(last) AS gap FROM seen
        WHERE datediff(last, SignupDate) > 30 AND MonthYear < DATE'2019-06-01')
      SELECT UserId, MonthYear, int(gap <= 12) AS c, int(EXISTS (SELECT 1 FROM um b WHERE b.UserId = gaps.UserId
        AND b.MonthYear = gaps.MonthYear AND b.ActiveMonth = 'Active')) AS r FROM gaps WHERE gap >= 2""")
    got = resurrected(make, months, users)
    assert got.count() > 20
    assert rows(got, "UserId", "MonthYear", "IsCurrentChurner", "Resurrected") == rows(want)


def test_months_one_by_one_equal_the_whole_history(spark, tmp_path):
    t, root = Tables(spark, "/root/testdata/sf0.01"), str(tmp_path)
    tables.write_event_log(t.platform_event(), root, "log", by="month")
    log = tables.read_event_log(spark, root, "log", by="month")
    months, users = tables.staged(t.users_month(), root, "months"), tables.staged(t.user_current(), root, "users")
    whole = existing.monthly_existing_users(months, users, log, types=rules_types(), internal=rules.INTERNAL)
    want_flags = existing.existing_user_churn_flags(whole, as_of=rules.AS_OF)
    want_types = existing.existing_user_types(want_flags)
    state = spark.createDataFrame([], existing.STATE)
    found, typed = [], []
    for (month,) in sorted(months.select("MonthYear").distinct().collect()):
        own = existing.existing_users_of_month(
            state, months, users, log, month=month, types=rules_types(), internal=rules.INTERNAL)
        own = spark.createDataFrame(own.collect(), own.schema)  # cuts the lineage
        found += own.collect()
        flags = existing.existing_user_churn_flags(own, as_of=rules.AS_OF)
        typed += existing.existing_user_types(flags, state).collect()
        after = existing.state_after_month(state, own, months, users, month=month, internal=rules.INTERNAL)
        state = spark.createDataFrame([tuple(r) for r in after.collect()], existing.STATE)
    assert len(found) > 500 and len({r.ExistingUserType for r in typed}) == 3
    assert sorted(map(str, found)) == sorted(map(str, whole.collect()))
    assert sorted(map(str, typed)) == sorted(map(str, want_types.collect()))


def test_span_bits_equal_sets_of_days(spark):
    draw = random.Random(8)
    start = dt.datetime(2018, 1, 1)
    rows_ = []
    for i in range(300):
        low = start + dt.timedelta(days=draw.randrange(90), hours=draw.choice((0, 0, 9)))
        rows_.append((i, low, low + dt.timedelta(days=draw.choice((-1, 0, 30, 61)))))
    days = [(d,) for d in (start + dt.timedelta(days=draw.randrange(150), hours=5) for _ in range(60))]
    active = spark.createDataFrame(days, "at timestamp_ntz").groupBy(F.trunc("at", "MM").alias("month")).agg(
        rel.day_bits(F.col("at")).alias("days"))
    spans = spark.createDataFrame(rows_, "i int, low timestamp_ntz, high timestamp_ntz")
    # months that do not touch the span, or come twice, change nothing
    got = spans.join(active.union(active)).groupBy("i").agg(
        rel.days_in_span(F.col("days"), F.col("month"), F.col("low"), F.col("high")).alias("n"))
    whole = {dt.datetime.combine(d.date(), dt.time()) for (d,) in days}
    assert {r.i: r.n for r in got.collect()} == {i: sum(a <= d <= b for d in whole) for i, a, b in rows_}
