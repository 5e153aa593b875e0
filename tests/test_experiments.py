import datetime as dt
import math
import random
import statistics

import pytest

from cohortia.operators import experiments
from tests.conftest import at, by_key, rows

AS_OF = dt.date(2019, 6, 30)
LONG = "ExperimentGroup string, Experiment string, Metric string, Value int"


def test_unpivot_has_its_own_denominator_per_metric(make):
    wide = make.table(
        "FirstSignupPageVisit date, ExperimentGroup string, Experiment string, SignupStarted int, SignupCompleted int, Activated int",
        [(None, "A", "e", 1, None, None), (None, "A", "e", 0, 1, None)],
    )
    got = experiments.unpivot_metrics(wide, date_column="FirstSignupPageVisit", metrics=experiments.SIGNUP_METRICS)
    assert rows(got, "Metric", "Value") == [("SignupCompleted", 1), ("SignupStarted", 0), ("SignupStarted", 1)]


def test_z_score_uses_all_groups(make):
    draw = random.Random(3)
    data = {g: [int(draw.random() < p) for _ in range(n)] for g, p, n in (("A", 0.3, 50), ("B", 0.5, 40), ("C", 0.9, 30))}
    long = make.table(LONG, [(g, "e", "m", v) for g, vs in data.items() for v in vs] + [("", "e", "m", 1), (" ", "e", "m", 1), (None, "e", "m", 1)])
    got = experiments.ab_significance(long, as_of=AS_OF).collect()
    assert len(got) == 1
    row = got[0]
    means = [statistics.mean(v) for v in data.values()]
    z = (max(means) - min(means)) / math.sqrt(sum(statistics.variance(v) / len(v) for v in data.values()))
    assert (row.CurrentDate, row.G1, row.G2, row.N1, row.N2) == (AS_OF, "A", "B", 50, 40)
    assert (row.Mu1, row.Mu2, row.Zscore) == pytest.approx((means[0], means[1], z))


def test_missing_experiment_keeps_a_row_without_numbers(make):
    long = make.table(LONG, [("A", None, "m", 1), ("A", None, "m", 0), ("B", None, "m", 1), ("B", None, "m", 0)])
    assert rows(experiments.ab_significance(long, as_of=AS_OF), "Experiment", "G1", "G2", "N1", "Mu1", "Zscore") == [
        (None, "A", "B", None, None, None)
    ]


def test_gate(make):
    tracker = make.table("UniqueId string, StartDate timestamp_ntz, EndDate timestamp_ntz", [
        ("open", at("2019-01-01"), None), ("future", at("2019-07-01"), None), ("today", at("2019-06-30"), None),
        ("closed29", at("2019-01-01"), at("2019-06-01")), ("closed30", at("2019-01-01"), at("2019-05-31")),
        ("unstarted", None, None), ("odd", None, at("2018-01-01")),
    ])
    names = ["open", "future", "today", "closed29", "closed30", "unstarted", "odd", "untracked"]
    long = make.table(LONG, [(g, n, "m", v) for n in names for g in "AB" for v in (0, 1)])
    got = experiments.active_experiments(experiments.ab_significance(long, as_of=AS_OF), tracker)
    assert sorted(by_key(got, "Experiment", "Metric")) == ["closed29", "odd", "open", "unstarted", "untracked"]


def test_weights_stand_for_repeated_rows(make):
    draw = random.Random(8)
    rows_ = [(g, e, "m", draw.randrange(3), draw.randrange(1, 6)) for g in "ABC" for e in ("e", None, "f") for _ in range(7)]
    rows_.append(("A", "single", "m", 1, 1))
    weighted = make.table(LONG + ", Copies bigint", rows_)
    repeated = make.table(LONG, [r[:4] for r in rows_ for _ in range(r[4])])
    rounded = lambda f: rows(f.selectExpr("Experiment", "N1", "N2", "round(Mu1, 9)", "round(Zscore, 9)"))
    assert rounded(experiments.ab_significance(weighted, as_of=AS_OF, weight="Copies")) == rounded(
        experiments.ab_significance(repeated, as_of=AS_OF)
    )
