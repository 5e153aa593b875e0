"""Unpivoted metrics, significance and the active-experiment gate."""

from bindings import rules
from bindings.queries.growth import AS_OF, KGM_VIEWS
from bindings.queries.signup import TEST_SQL, test_rows
from bindings.queries.tours import SIGNIFICANCE_SQL, significance_rows
from bindings.registry import register
from cohortia.operators import experiments

VIEWS = KGM_VIEWS + " experiment_current"


def unpivot_sql(source: str, date: str, metrics) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {date}, ExperimentGroup, Experiment, '{m}' AS Metric, {m} AS Value FROM {source} WHERE {m} IS NOT NULL"
        for m in metrics
    )
    return f"long AS ({parts})"


# The built-in sample variance, as a check on the weighted sums of the operator.  Rows
# without an experiment have no group moments, as their key equals nothing.
MOMENTS = f"""
moments AS (
  SELECT Experiment, Metric, ExperimentGroup AS grp, if(Experiment IS NULL, NULL, count(*)) AS n,
    if(Experiment IS NULL, NULL, avg(Value)) AS mean, if(Experiment IS NULL, NULL, var_samp(Value)) AS variance
  FROM long WHERE trim(ExperimentGroup) <> '' GROUP BY Experiment, Metric, ExperimentGroup),
tested AS (
  SELECT {AS_OF}::DATE AS CurrentDate, Experiment, Metric,
    any_value(grp) FILTER (grp = 'A') AS G1, any_value(grp) FILTER (grp = 'B') AS G2,
    any_value(n) FILTER (grp = 'A') AS N1, any_value(n) FILTER (grp = 'B') AS N2,
    any_value(mean) FILTER (grp = 'A') AS Mu1, any_value(mean) FILTER (grp = 'B') AS Mu2,
    (max(mean) - min(mean)) / nullif(sqrt(sum(variance / n)), 0) AS Zscore
  FROM moments GROUP BY Experiment, Metric),
gated AS (
  SELECT t.* FROM tested t LEFT JOIN experiment_current e ON e.UniqueId = t.Experiment
  WHERE StartDate IS NULL OR coalesce(CurrentDate < EndDate::DATE + 30, CurrentDate > StartDate::DATE))"""

SIGNUP = TEST_SQL + "," + unpivot_sql("joined", "FirstSignupPageVisit", experiments.SIGNUP_METRICS)
TOUR = SIGNIFICANCE_SQL + "," + unpivot_sql("significance_rows", "FirstStartDate", experiments.TOUR_METRICS)
_LONG = "{0}:date ExperimentGroup Experiment Metric Value:int"
_RESULT = "CurrentDate:date Experiment Metric G1 G2 N1:int N2:int Mu1:double Mu2:double Zscore:double"


def signup_long(t):
    return experiments.unpivot_metrics(
        test_rows(t), date_column="FirstSignupPageVisit", metrics=experiments.SIGNUP_METRICS
    )


def signup_significance(t):
    """Repeated completions and mails enter as weights, not as rows."""
    long = experiments.unpivot_metrics(
        test_rows(t, copies="Copies"), date_column="FirstSignupPageVisit",
        metrics=experiments.SIGNUP_METRICS, weight="Copies",
    )
    return experiments.ab_significance(long, as_of=rules.AS_OF, weight="Copies")


def tour_long(t):
    return experiments.unpivot_metrics(
        significance_rows(t), date_column="FirstStartDate", metrics=experiments.TOUR_METRICS
    )


@register("m30_unpivot_signup", _LONG.format("FirstSignupPageVisit"), KGM_VIEWS,
          SIGNUP + ", result AS (SELECT * FROM long)")
def unpivot_signup(t):
    return signup_long(t)


@register("m30_unpivot_tour", _LONG.format("FirstStartDate"), KGM_VIEWS,
          TOUR + ", result AS (SELECT * FROM long)")
def unpivot_tour(t):
    return tour_long(t)


@register("m31_significance_signup", _RESULT, VIEWS,
          SIGNUP + "," + MOMENTS + ", result AS (SELECT * FROM tested)")
def significance_signup(t):
    return signup_significance(t)


@register("m31_significance_tour", _RESULT, VIEWS,
          TOUR + "," + MOMENTS + ", result AS (SELECT * FROM tested)")
def significance_tour(t):
    return experiments.ab_significance(tour_long(t), as_of=rules.AS_OF)


@register("m32_active_experiments_signup", _RESULT, VIEWS,
          SIGNUP + "," + MOMENTS + ", result AS (SELECT * FROM gated)")
def active_experiments_signup(t):
    return experiments.active_experiments(signup_significance(t), t.experiment_current())


@register("m32_active_experiments_tour", _RESULT, VIEWS,
          TOUR + "," + MOMENTS + ", result AS (SELECT * FROM gated)")
def active_experiments_tour(t):
    return experiments.active_experiments(
        experiments.ab_significance(tour_long(t), as_of=rules.AS_OF), t.experiment_current()
    )
