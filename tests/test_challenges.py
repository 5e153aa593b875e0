import datetime as dt

from bindings import rules
from cohortia.operators import challenges
from cohortia.sources import taxonomy
from tests.conftest import at, by_key, day, rows

ASSIGNED, DONE, EXPIRED, CLAIMED = (
    taxonomy.CHALLENGE_ASSIGNED, taxonomy.CHALLENGE_COMPLETED, taxonomy.CHALLENGE_EXPIRED, taxonomy.CHALLENGE_CLAIMED,
)
CATEGORIES = taxonomy.challenge_categories("Acme")


def event(user, kind, time, challenge="c", id_=None):
    return (user, kind, time, challenge, None, None, "C1", id_)


PROGRESS = [
    event("u", ASSIGNED, "2018-12-01 10:00", id_=1), event("u", ASSIGNED, "2018-12-05 10:00", id_=2),
    event("u", DONE, "2018-12-03 11:59", id_=3), event("u", DONE, "2018-12-03 11:59", id_=4), event("u", EXPIRED, "2018-12-09", id_=5),
    event("late", DONE, "2018-12-01", id_=6), event("late", ASSIGNED, "2018-12-01", id_=7),
    event("odd", ASSIGNED, "2018-12-02", id_=20), event("odd", ASSIGNED, "2018-12-04", id_=10), event("odd", DONE, "2018-12-06", id_=21),
    event("other", ASSIGNED, "2018-12-01", "d", id_=30), event("other", DONE, "2018-12-02", "e", id_=31),
    event("twice", ASSIGNED, "2018-12-01", id_=40), event("twice", ASSIGNED, "2018-12-01", id_=41),
    event(None, DONE, "2018-12-02", id_=50),
]


def test_progress_matches_ends_to_the_latest_earlier_assignment(make):
    got = rows(challenges.challenge_progress(make.events(PROGRESS)), "OpenId", "ChallengeId", "Status", "TimeChallengeAssigned", "LastChallengeEventChangedId")
    assert got == sorted([
        (None, "c", "Completed", None, None),
        ("late", "c", "Completed", None, None), ("late", "c", "Currently Active", at("2018-12-01"), None),
        ("odd", "c", "Completed", at("2018-12-02"), 20), ("odd", "c", "Currently Active", at("2018-12-04"), None),
        ("other", "d", "Currently Active", at("2018-12-01"), None), ("other", "e", "Completed", None, None),
        ("twice", "c", "Currently Active", at("2018-12-01"), None),
        ("u", "c", "Completed", at("2018-12-01 10:00"), 1), ("u", "c", "Expired", at("2018-12-05 10:00"), 2),
    ], key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_progress_output_external_with_hours(make):
    users = make.users([("u", "C1", "2018-01-01"), ("u", "C2", "2018-01-01"), ("odd", "ACME", "2018-01-01"), ("late", None, "2018-01-01")])
    got = challenges.challenge_progress_output(challenges.challenge_progress(make.events(PROGRESS)), users, internal="acme")
    assert rows(got, "OpenId", "Status", "DateEnded", "TimeDiff") == [
        ("u", "Completed", day("2018-12-03"), 49), ("u", "Expired", day("2018-12-09"), 86),
    ]


def test_activity_window_is_closed_and_bounded_by_the_log_range(make):
    progress = make.table(
        "OpenId string, ChallengeId string, Status string, TimeChallengeAssigned timestamp_ntz, DateTimeEnded timestamp_ntz, "
        "LastChallengeEventChangedId bigint, DateChallengeAssigned date, DateEnded date, TimeDiff int",
        [("u", "c", "Expired", at("2018-11-10 10:00"), None, 1, None, None, None),
         ("u", "d", "Expired", at("2018-12-20"), None, 2, None, None, None),
         ("u", "e", "Completed", None, None, None, None, None, None), ("idle", "c", "Expired", at("2018-11-10"), None, 3, None, None, None)],
    )
    events = make.events([
        ("u", "TeamserverCommit", "2018-11-10 10:00"), ("u", "TeamserverCommit", "2018-12-10 10:00"), ("u", "TeamserverCommit", "2018-12-10 10:00:01"),
        ("u", "TeamserverCommit", "2018-11-10 09:59:59"), ("u", "OnlineLectureStarted", "2018-11-20"), ("u", "OnlineLectureStarted", "2018-11-20"),
        ("u", "AcmeReviewAdded", "2019-01-01"), ("u", "AcmeReviewAdded", "2019-01-02"), ("u", "Unlisted", "2018-11-20"),
    ])
    got = challenges.challenge_activity(
        progress, events, categories=CATEGORIES, between=rules.CHALLENGES_BETWEEN)
    assert rows(got, "OpenId", "ChallengeId", "DevActivity", "LearnActivity", "SocialActivity") == [
        ("idle", "c", 0, 0, 0), ("u", "c", 2, 2, 0), ("u", "d", 0, 0, 1), ("u", "e", 0, 0, 0),
    ]


def test_user_profile(make):
    as_of = dt.datetime(2019, 2, 1, 12)
    events = make.events([
        event("u", ASSIGNED, "2018-12-01", "a"), event("u", ASSIGNED, "2018-12-09", "a"), event("u", ASSIGNED, "2018-12-01", "b"),
        event("u", DONE, "2018-12-02", "a"), event("u", ASSIGNED, "2018-11-01", "old"), event("u", CLAIMED, "2018-11-01 00:01", None),
        ("u", "QuestionPosted", "2019-01-02 12:00"), ("u", "QuestionPosted", "2019-01-02 12:01"), ("u", "AppPublished", "2019-01-05"),
        event("x", DONE, "2018-12-02", "a"),
    ])
    points = make.table("OpenId string, HighestCert string, Level int, Total_points int", [("u", "gold", 3, 70)])
    got = challenges.challenge_user_profile(
        events, make.users([("u", "C1", "2018-01-01")]), make.company(), points, categories=CATEGORIES, as_of=as_of,
        after=rules.CHALLENGES_BETWEEN[0],
    )
    assert by_key(
        got, "OpenId", "CountChallengeAssigned", "CountChallengeCompleted", "CountChallengeCreditsClaimed", "CountCurrentlyActive",
        "ExploreActivityLast30Days", "KnowledgeShareActivityLast30Days", "DisplayName", "MxLevel",
    ) == {"u": (2, 1, 1, 1, 1, 1, "One", 3), "x": (0, 1, 0, -1, 0, 0, None, None)}


def test_credits(make):
    events = make.events([
        event("u", DONE, "2018-12-01"), event("u", DONE, "2018-12-01"), event("u", DONE, "2018-12-02"), event("u", CLAIMED, "2018-12-03"),
        event("u", CLAIMED, "2018-12-03"), event("v", DONE, "2018-12-01"), event("w", CLAIMED, "2018-12-01"),
        event("own", DONE, "2018-12-01"), event("ghost", DONE, "2018-12-01"),
    ])
    users = make.users([("u", "C1", "2018-01-01"), ("v", "C1", "2018-01-01"), ("own", "Acme", "2018-01-01")])
    assert rows(challenges.credits_claimed(events, users, internal="acme")) == [("u", "c", 2, 2), ("v", "c", 1, 0)]
    assert len(rows(challenges.credits_claimed_raw(events))) == 3


def test_before_and_after(make):
    assigned = at("2018-12-31 12:00")
    offsets = {-30: 0, -29: 1, 29: 1, 30: 0}
    learn = [("u", "OnlineLectureStarted", (dt.datetime(2018, 12, 31, 23) + dt.timedelta(days=d)).isoformat()) for d in offsets]
    events = make.events([
        event("u", ASSIGNED, assigned.isoformat(), "KEY-1"), event("u", ASSIGNED, "2018-12-31", "no"), event("u", CLAIMED, "2019-01-02", "KEY-1"),
        *learn, ("u", "OnlineLectureCompleted", assigned.isoformat()), ("u", "OnlineLectureCompleted", "2018-12-31 11:59"), ("u", "AppLogin", "2019-01-01"),
        event("new", ASSIGNED, assigned.isoformat(), "KEY-1"), event("fresh", ASSIGNED, "2019-03-01", "KEY-1"), event("own", ASSIGNED, assigned.isoformat(), "KEY-1"),
        event("calm", ASSIGNED, assigned.isoformat(), "KEY-1"),
    ])
    users = make.users([
        ("u", "C1", "2018-01-01"), ("new", "C1", "2018-12-01"), ("fresh", "C1", "2018-01-01"), ("own", "acme", "2018-01-01"), ("calm", "C1", "2018-11-30"),
    ])
    got = challenges.before_after_activity(events, users, challenge_prefix="key", internal="acme",
        as_of=dt.datetime(2019, 3, 15), after=rules.CHALLENGES_BETWEEN[0])
    assert by_key(got, "OpenId", challenges.BEFORE, "LearnActivityAfterChallenge", "DiffLearnActivity", "CountCreditsClaimed") == {
        "u": (2, 1, -1, 1), "calm": (0, 0, 0, 0),
    }
