"""Guided tutorials and product tours."""

from bindings import rules
from bindings.queries.growth import AS_OF, KGM, KGM_SCHEMA, KGM_VIEWS, kgm
from bindings.queries.signup import ANSWERS, customer_types
from bindings.registry import register
from cohortia.operators import tours


def log(t):
    return t.platform_event()


def progress(t):
    return tours.tour_progress(log(t))


def conversion(t, anchor):
    return tours.tour_conversion(progress(t), log(t), anchor=anchor)


# One aggregate of the steps of each user and tutorial; what happened in the week after
# a day is asked of the log by EXISTS.
TUTORIAL = """
step AS (
  SELECT OpenId, ExtraInfo2 AS Tutorial, ExtraInfo1 AS name, "Timestamp"::DATE AS day FROM platform_event
  WHERE EventType = 'WmIntroTutorialStep'),
journey AS (
  SELECT OpenId, Tutorial, min(day) FILTER (name = 'welcome1') AS FirstStartDate, min(day) AS FinishDate,
    count(DISTINCT name) AS CompletedSteps, count(*) FILTER (name = 'Finished') AS GuidanceFinished
  FROM step GROUP BY OpenId, Tutorial),
broken_day AS (
  SELECT DISTINCT OpenId, "Timestamp"::DATE AS BrokenDate, 1 AS BrokenEvents FROM platform_event
  WHERE EventType = 'WmIntroTutorialBroken'),
choice AS (SELECT DISTINCT OpenId, name AS StepName FROM step WHERE starts_with(lower(name), 'continue'))"""


def within_week(anchor: str, types: str) -> str:
    """1 if the user has an event of the types on days 1 to 8 after the anchor."""
    return (
        f"(EXISTS (SELECT 1 FROM platform_event e WHERE e.OpenId = j.OpenId AND e.EventType IN {types} "
        f"AND e.\"Timestamp\"::DATE - {anchor} BETWEEN 1 AND 8))::INTEGER"
    )


def conversion_sql(anchor: str) -> str:
    return f"""
conversion AS (
  SELECT *, {anchor} + 1 AS LowerBoundary, {anchor} + 8 AS UpperBoundary,
    {within_week(anchor, "('OnlineLectureCompleted')")} AS LectureCompleted,
    {within_week(anchor, "('SandboxDeployed', 'WmDeploySucceeded')")} AS WmActivated
  FROM journey j WHERE {anchor} IS NOT NULL)"""


def guidance_sql(anchor: str, choices: bool = True) -> str:
    """Journeys with a start, named by experiment and group, of users in their first week.

    Anchored on the finish, conversions count only once the journey is finished, and
    steps only until then.
    """
    shown = f"{AS_OF} > c.UpperBoundary"
    steps = "CompletedSteps"
    if anchor == "FinishDate":
        shown += " AND c.GuidanceFinished > 0"
        steps = "if(c.GuidanceFinished = 0, CompletedSteps, NULL) AS CompletedSteps"
    picked = "(StepName IS NOT DISTINCT FROM '{}')::INTEGER AS {}"
    flags = ", ".join(
        picked.format(*x) for x in (("Continue with learn", "Learn"), ("Continue working in app", "WorkInApp"))
    )
    return f"""{conversion_sql(anchor)},
week AS (
  SELECT c.OpenId, FirstStartDate, Tutorial,
    regexp_extract(Tutorial, '^[^_]*_') || regexp_replace(Tutorial, '^[^:]*:', '') AS Experiment,
    left(regexp_replace(Tutorial, '^[^_]*_', ''), 1) AS ExperimentGroup,
    (c.GuidanceFinished > 0)::INTEGER AS GuidanceFinished, if({shown}, LectureCompleted, NULL) AS LectureCompleted,
    if({shown}, WmActivated, NULL) AS WmActivated, {flags + "," if choices else ""} {steps}, kgm.*, 1 AS WithinFirstWeek
  FROM conversion c JOIN kgm ON UserId = c.OpenId {"LEFT JOIN choice ON choice.OpenId = c.OpenId" if choices else ""}
  WHERE FirstStartDate - SignupDate < 8)"""


# The shared table names of the growth steps and the answer steps do not clash.
TOUR_SQL = KGM + "," + TUTORIAL + ","

_TOUR = "OpenId FirstStartDate:date Tutorial Experiment ExperimentGroup GuidanceFinished:int LectureCompleted:int WmActivated:int"
_CHOICE = "Learn:int WorkInApp:int"
SIGNIFICANCE_SCHEMA = f"{_TOUR} {_CHOICE} CompletedSteps:int {KGM_SCHEMA} WithinFirstWeek:int"
SIGNIFICANCE_SQL = TOUR_SQL + guidance_sql("FirstStartDate") + """,
significance_rows AS (SELECT * FROM week WHERE Experiment <> '1')"""


@register("m24_tour_started", "OpenId FirstStartDate:date Tutorial", "platform_event",
          TUTORIAL + ", result AS (SELECT * FROM journey WHERE FirstStartDate IS NOT NULL)")
def tour_started(t):
    return tours.tour_started(progress(t))


@register("m25_tour_steps_completed", "OpenId Tutorial CompletedSteps:int", "platform_event",
          TUTORIAL + ", result AS (SELECT * FROM journey)")
def tour_steps(t):
    return tours.tour_steps_completed(progress(t))


@register("m26_tour_finished", "OpenId Tutorial FinishDate:date GuidanceFinished:int", "platform_event",
          TUTORIAL + ", result AS (SELECT * FROM journey)")
def tour_finished(t):
    return tours.tour_finished(progress(t))


@register("m27_tour_broken", "OpenId BrokenDate:date BrokenEvents:int", "platform_event",
          TUTORIAL + ", result AS (SELECT * FROM broken_day)")
def tour_broken(t):
    return tours.tour_broken(log(t))


@register("m27_tour_broken_daily", "BrokenDate:date BrokenEventsByDay:int", "platform_event",
          TUTORIAL + ", result AS (SELECT BrokenDate, count(*) AS BrokenEventsByDay FROM broken_day GROUP BY 1)")
def tour_broken_daily(t):
    return tours.tour_broken_daily(tours.tour_broken(log(t)))


@register("m27_tour_continue", "OpenId StepName", "platform_event",
          TUTORIAL + ", result AS (SELECT * FROM choice)")
def tour_continue(t):
    return tours.tour_continue(log(t))


_CONVERSION = "LowerBoundary:date UpperBoundary:date LectureCompleted:int WmActivated:int"


@register("m28_tour_conversion_start", f"OpenId Tutorial FirstStartDate:date {_CONVERSION}", "platform_event",
          TUTORIAL + "," + conversion_sql("FirstStartDate") + ", result AS (SELECT * FROM conversion)")
def tour_conversion_start(t):
    return conversion(t, "start")


@register("m28_tour_conversion_finish", f"OpenId Tutorial FinishDate:date GuidanceFinished:int {_CONVERSION}", "platform_event",
          TUTORIAL + "," + conversion_sql("FinishDate") + ", result AS (SELECT * FROM conversion)")
def tour_conversion_finish(t):
    return conversion(t, "finish")


@register(
    "m29_tour_full",
    f"{SIGNIFICANCE_SCHEMA} GuidanceStarted:int ChosenLearn:int ChosenWorkInApp:int StageCompletion:int Maxsteps:int "
    "Activated:int BrokenDate:date BrokenEvents:int",
    KGM_VIEWS,
    TOUR_SQL + guidance_sql("FirstStartDate") + """, result AS (
  SELECT week.*, BrokenDate, BrokenEvents, 1 AS GuidanceStarted, Learn AS ChosenLearn, WorkInApp AS ChosenWorkInApp,
    if(GuidanceFinished = 0, CompletedSteps, NULL) AS StageCompletion, CompletedSteps AS Maxsteps, ActivatedWithin30days AS Activated
  FROM week LEFT JOIN broken_day USING (OpenId))""",
)
def tour_full(t):
    return tours.tour_output(
        conversion(t, "start"), kgm(t), as_of=rules.AS_OF,
        continued=tours.tour_continue(log(t)), broken=tours.tour_broken(log(t)),
    )


@register(
    "m29_tour_output", f"{SIGNIFICANCE_SCHEMA} CustomerType", KGM_VIEWS,
    TOUR_SQL + ANSWERS + "," + guidance_sql("FinishDate") + """, result AS (
  SELECT week.*, CustomerType FROM week LEFT JOIN ctypes USING (OpenId) WHERE Experiment <> '1')""",
)
def tour_output(t):
    return tours.tour_output(
        conversion(t, "finish"), kgm(t), as_of=rules.AS_OF, require_finished=True,
        continued=tours.tour_continue(log(t)), customer_types=customer_types(t),
        not_experiment="1",
    )


@register(
    "m29_tour_journey",
    f"{_TOUR} CompletedSteps:int {KGM_SCHEMA} WithinFirstWeek:int GuidanceStarted:int Activated:int BrokenEvents:int CustomerType",
    KGM_VIEWS,
    TOUR_SQL + ANSWERS + "," + guidance_sql("FirstStartDate", choices=False) + """, result AS (
  SELECT week.*, 1 AS GuidanceStarted, ActivatedWithin30days AS Activated, BrokenEvents, CustomerType
  FROM week LEFT JOIN broken_day USING (OpenId) LEFT JOIN ctypes USING (OpenId) WHERE Experiment = 'journey_4')""",
)
def tour_journey(t):
    return tours.tour_output(
        conversion(t, "start"), kgm(t), as_of=rules.AS_OF, experiment="journey_4",
        broken=tours.tour_broken(log(t)), customer_types=customer_types(t),
    )


def significance_rows(t):
    return tours.tour_output(
        conversion(t, "start"), kgm(t), as_of=rules.AS_OF, not_experiment="1",
        continued=tours.tour_continue(log(t)),
    )


@register("m29_tour_significance_rows", SIGNIFICANCE_SCHEMA, KGM_VIEWS,
          SIGNIFICANCE_SQL + ", result AS (SELECT * FROM significance_rows)")
def tour_significance_rows(t):
    return significance_rows(t)


@register(
    "m33_flow_conversion",
    "OpenId FlowID Revision FirstStartDate:date TimesStarted:int CountCompleted:int CountClosed:int Started:int LastStep:int",
    "platform_event",
    """
flow AS (
  SELECT OpenId, ExtraInfo1 AS FlowID, count(OpenId) FILTER (EventType = 'GuidanceTourStarted') AS TimesStarted,
    min("Timestamp"::DATE) FILTER (EventType = 'GuidanceTourStarted') AS FirstStartDate,
    max(ExtraInfo3) FILTER (EventType = 'GuidanceTourStarted') AS Revision,
    count(*) FILTER (EventType = 'GuidanceTourEnded' AND lower(ExtraInfo2) = 'completed') AS CountCompleted,
    count(*) FILTER (EventType = 'GuidanceTourEnded' AND lower(ExtraInfo2) = 'closed') AS CountClosed,
    trunc(avg(if(coalesce(lower(ExtraInfo2) = 'closed', false), TRY_CAST(ExtraInfo3 AS INTEGER), 1000))
      FILTER (EventType = 'GuidanceTourEnded')) AS LastStep
  FROM platform_event WHERE EventType IN ('GuidanceTourStarted', 'GuidanceTourEnded') AND OpenId IS NOT NULL GROUP BY ALL),
result AS (
  SELECT *, 1 AS Started FROM flow WHERE TimesStarted > 0 AND CountCompleted + CountClosed < 2
  UNION ALL BY NAME
  SELECT NULL AS OpenId, ExtraInfo1 AS FlowID, 0 AS TimesStarted, min("Timestamp"::DATE) AS FirstStartDate, max(ExtraInfo3) AS Revision,
    0 AS CountCompleted, 0 AS CountClosed, NULL AS LastStep, 0 AS Started
  FROM platform_event WHERE EventType = 'GuidanceTourStarted' AND OpenId IS NULL GROUP BY ExtraInfo1)""",
)
def flow_conversion(t):
    return tours.flow_conversion(t.platform_event())
