import datetime as dt

from cohortia.operators import tours
from tests.conftest import by_key, day, rows

STEP, BROKEN = "WmIntroTutorialStep", "WmIntroTutorialBroken"


def step(user, name, time, tutorial="journey_A:4"):
    return (user, STEP, time, name, tutorial)


BASE = [
    step("u", "intro", "2018-01-01 09:00"), step("u", "welcome1", "2018-01-02 09:00"), step("u", "welcome1", "2018-01-03"),
    step("u", "Finished", "2018-01-05"), step("u", "continue with learn", "2018-01-05"), step("u", "Continue working in app", "2018-01-05"),
    step("u", "welcome1", "2018-01-04", "journey_B:4"), step("u", None, "2018-01-04", "journey_B:4"),
    step("u", "welcome1", "2018-01-02", None), step("w", "Finished", "2018-01-02"),
]


def test_progress(make):
    got = tours.tour_progress(make.events(BASE))
    assert rows(got, "OpenId", "Tutorial", "FirstStartDate", "CompletedSteps", "FinishDate", "GuidanceFinished") == [
        ("u", None, day("2018-01-02"), 1, day("2018-01-02"), 0),
        ("u", "journey_A:4", day("2018-01-02"), 5, day("2018-01-01"), 1),  # finish date is the first day of any step
        ("u", "journey_B:4", day("2018-01-04"), 1, day("2018-01-04"), 0),
        ("w", "journey_A:4", None, 1, day("2018-01-02"), 1),
    ]
    assert len(rows(tours.tour_started(got))) == 3


def test_broken_and_continue(make):
    events = make.events([*BASE, ("u", BROKEN, "2018-01-02 01:00"), ("u", BROKEN, "2018-01-02 02:00"), ("w", BROKEN, "2018-01-02")])
    broken = tours.tour_broken(events)
    assert rows(broken) == [("u", day("2018-01-02"), 1), ("w", day("2018-01-02"), 1)]
    assert rows(tours.tour_broken_daily(broken)) == [(day("2018-01-02"), 2)]
    assert rows(tours.tour_continue(events)) == [("u", "Continue working in app"), ("u", "continue with learn")]


def converted(make, offsets, kind, anchor="start"):
    base = dt.datetime(2018, 1, 2, 23)
    extra = [("u", kind, (base + dt.timedelta(days=d)).isoformat()) for d in offsets]
    events = make.events([step("u", "welcome1", "2018-01-02 23:00"), *extra])
    got = tours.tour_conversion(tours.tour_progress(events), events, anchor=anchor)
    return rows(got, "LectureCompleted", "WmActivated")


def test_conversion_window_is_days_one_to_eight(make):
    assert converted(make, [0, 9], "SandboxDeployed") == [(0, 0)]
    assert converted(make, [1], "WmDeploySucceeded") == [(0, 1)]
    assert converted(make, [8, 8], "OnlineLectureCompleted") == [(1, 0)]
    assert converted(make, [1], "OnlineLectureStarted", "finish") == [(0, 0)]


def output(make, events, signups, as_of=dt.datetime(2018, 3, 1), anchor="start", **options):
    growth = make.table(
        "UserId string, SignupDate date, ActivatedWithin30days int", [(u, day(d), 1) for u, d in signups.items()]
    )
    frame = make.events(events)
    conversion = tours.tour_conversion(tours.tour_progress(frame), frame, anchor=anchor)
    named = {
        "continued": tours.tour_continue(frame) if options.pop("continued", True) else None,
        "broken": tours.tour_broken(frame) if options.pop("broken", False) else None,
    }
    return tours.tour_output(conversion, growth, as_of=as_of, **named, **options)


def test_output_fans_out_over_continue_steps_and_broken_days(make):
    events = [*BASE, ("u", BROKEN, "2018-01-02"), ("u", BROKEN, "2018-01-09")]
    got = output(make, events, {"u": "2018-01-01"}, broken=True)
    counts = {r.Tutorial: r["count"] for r in got.groupBy("Tutorial").count().collect()}
    # two continue steps x two broken days; the tutorial without a name matches no continue step
    assert counts == {"journey_A:4": 4, "journey_B:4": 4, None: 2}
    assert rows(got.where("Tutorial = 'journey_A:4'").select("WorkInApp", "ChosenWorkInApp", "StageCompletion", "Maxsteps").distinct()) == [
        (0, 0, None, 5), (1, 1, None, 5),
    ]
    assert rows(got.where("Tutorial IS NULL").select("Experiment", "GuidanceFinished", "CompletedSteps").distinct()) == [("", 0, None)]


def test_repeated_steps_are_a_number_until_all_joins_are_done(make, spark):
    """One user owns most continue steps and broken days: rows go through the joins once."""
    events = [*BASE, *[("u", BROKEN, f"2018-01-{d:02}") for d in range(2, 12)]]
    frame = make.events(events)
    conversion = tours.tour_conversion(tours.tour_progress(frame), frame, anchor="start")
    growth = make.table("UserId string, SignupDate date, ActivatedWithin30days int", [("u", day("2018-01-01"), 1)])
    many = tours.tour_continue(frame).join(spark.range(3_000).select("id")).drop("id")
    options = dict(as_of=dt.datetime(2018, 3, 1), continued=many, broken=tours.tour_broken(frame))
    counted = tours.tour_output(conversion, growth, copies="times", **options)
    # tutorials x two step names x ten days, each with its number of repetitions
    assert counted.count() == 2 * 2 * 10 + 10
    assert {r.times for r in counted.select("times").distinct().collect()} == {3_000, 1}
    whole = tours.tour_output(conversion, growth, **options)
    assert whole.count() == 2 * 2 * 10 * 3_000 + 10
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sequence(1") < plan.index("Join")  # copies unfold above every join


def test_only_the_first_week_after_signup(make):
    events = [step(u, "welcome1", "2018-01-10") for u in ("d7", "d8", "before", "unknown")]
    got = output(make, events, {"d7": "2018-01-03", "d8": "2018-01-02", "before": "2018-02-01"}, continued=False)
    assert rows(got, "OpenId") == [("before",), ("d7",)]


def test_masking_until_the_window_has_passed(make):
    events = [step("u", "welcome1", "2018-01-10"), ("u", "SandboxDeployed", "2018-01-12")]
    ask = lambda when: rows(output(make, events, {"u": "2018-01-09"}, as_of=when, continued=False), "WmActivated")
    assert ask(dt.datetime(2018, 1, 18)) == [(None,)]  # the bound is the midnight of day 8
    assert ask(dt.datetime(2018, 1, 18, 0, 0, 1)) == [(1,)]


def test_finish_anchor_masks_unfinished(make):
    events = [
        step("f", "welcome1", "2018-01-10"), step("f", "Finished", "2018-01-11"), step("g", "welcome1", "2018-01-10"),
        ("f", "SandboxDeployed", "2018-01-12"), ("g", "SandboxDeployed", "2018-01-12"),
        step("h", "Finished", "2018-01-10"),
    ]
    got = output(make, events, dict.fromkeys("fgh", "2018-01-09"), anchor="finish", require_finished=True, continued=False)
    assert by_key(got, "OpenId", "WmActivated", "CompletedSteps", "GuidanceFinished") == {"f": (1, None, 1), "g": (None, 1, 0)}


def test_experiment_filters(make):
    events = [step("u", "welcome1", "2018-01-10", t) for t in ("journey_A:4", "x:1", "journey_B:3")]
    names = lambda **o: rows(output(make, events, {"u": "2018-01-09"}, continued=False, **o), "Experiment", "ExperimentGroup")
    assert names(not_experiment="1") == [("journey_3", "B"), ("journey_4", "A")]
    assert names(experiment="journey_4") == [("journey_4", "A")]


def test_flow_conversion(make):
    start = lambda u, flow="f", rev="1": (u, "GuidanceTourStarted", "2018-01-02 10:00", flow, None, rev)
    end = lambda u, how, last="3", flow="f": (u, "GuidanceTourEnded", "2018-01-03", flow, how, last)
    events = make.events([
        start("none"), start("one"), start("one", rev="2"), end("one", "Completed"),
        start("two"), end("two", "completed"), end("two", "closed"), end("unstarted", "closed"),
        start("text"), end("text", "closed", "n/a"), start("mean"), end("mean", "closed", "4"), end("mean", "other", "4"),
    ])
    got = tours.flow_conversion(events)
    assert by_key(got, "OpenId", "Revision", "TimesStarted", "CountCompleted", "CountClosed", "LastStep") == {
        "none": ("1", 1, 0, 0, None), "one": ("2", 2, 1, 0, 1000), "text": ("1", 1, 0, 1, None), "mean": ("1", 1, 0, 1, 502),
    }
