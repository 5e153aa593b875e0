import datetime as dt
import random

from cohortia.operators import growth, onboarding
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy
from tests.conftest import by_key, day, rows

INTERNAL = "acme"
TYPES = taxonomy.growth_types("Acme")


def test_initiative_events_filters_type_and_time(make):
    events = make.events([
        ("u", "SandboxDeployed", "2016-12-01"), ("u", "SandboxDeployed", "2016-12-01 00:00:01"), ("u", "Other", "2018-01-01"),
    ])
    assert rows(growth.initiative_events(events, after=dt.date(2016, 12, 1)), "ChangedId") == [(1,)]


def users(make):
    return growth.growth_users(
        make.users([
            ("midnight", "C1", "2018-01-01"), ("ten", "C1", "2018-01-01 10:00"), ("silent", "C9", "2018-01-01"),
            ("own", "ACME labs", "2018-01-01"), ("nowhere", None, "2018-01-01"), ("", "C1", "2018-01-01"),
            ("  ", "C1", "2018-01-01"), ("early", "C1", "2018-03-01"), ("unsigned", "C1", None),
        ]),
        internal=INTERNAL,
    )


def test_growth_users_keeps_known_external(make):
    assert sorted(by_key(users(make), "UserId", "SignupDate")) == ["early", "midnight", "silent", "ten", "unsigned"]


def test_activation_counts_early_events_and_day_thirty(make):
    events = make.events([
        ("midnight", "SandboxDeployed", "2018-01-31 23:00"), ("ten", "WmDeploySucceeded", "2018-02-01"),
        ("early", "SandboxDeployed", "2018-02-20"), ("early", "SandboxDeployed", "2018-05-20"),
        ("silent", "AppLogin", "2018-01-02"), ("unsigned", "SandboxDeployed", "2018-01-02"),
    ])
    got = growth.activation(users(make), events, make.company())
    assert by_key(got, "UserId", "CompanyType", "ActivatedWithin30days") == {
        "midnight": ("Customer", 1), "ten": ("Customer", 0), "early": ("Customer", 1),
        "silent": ("Other", 0), "unsigned": ("Customer", 0),
    }


def test_retention_window_keeps_the_time_of_day(make):
    """Day 30 counts for a midnight signup only; day 60 counts for both."""
    both = [
        (u, "AppLogin", t) for u in ("midnight", "ten")
        for t in ("2018-01-31 08:00", "2018-02-10 08:00", "2018-02-10 09:00", "2018-03-02 23:00", "2018-03-03")
    ]
    events = make.events([*both, (None, "AppLogin", "2018-02-10"), ("silent", "Unlisted", "2018-02-10")])
    got = growth.retention_second_month(users(make), events, make.company(), types=TYPES)
    assert by_key(got, "UserId", "DaysActiveInSecondMonth", "Retained") == {
        "midnight": (3, 1), "ten": (2, 1), "silent": (0, 0), "early": (0, 0), "unsigned": (0, 0),
    }


INVITES = [
    ("s", "AppInviteSent", "2018-01-10 10:00", "nobody@x"),
    ("s", "AppInviteSent", "2018-02-20 10:00", "nobody@x"),
    ("s", "AppInviteSent", "2018-01-10 10:00", "before@x"),
    ("s", "AppInviteSent", "2018-01-10 10:00", "sameday@x"),
    ("s", "AppInviteSent", "2018-01-10 10:00", "later@x"),
    ("s", "AppInviteSent", "2018-01-10 10:00", "twins@x"),
    ("s", "AppInviteSent", "2018-01-10 10:00", None),
    ("own", "AppInviteSent", "2018-01-10 10:00", "nobody@x", None, None, "Acme"),
    ("", "AppInviteSent", "2018-01-10 10:00", "nobody@x"),
]


def invite_users(make):
    return make.users([
        ("s", "C1", "2018-01-01"), ("before", "C1", "2018-01-05"), ("sameday", "C1", "2018-01-10 18:00"),
        ("later", "C1", "2018-01-20"), ("t1", "C1", "2018-02-01", "twins@x"), ("t2", "C1", "2018-02-02", "twins@x"),
        ("far", "C1", "2018-06-01"),
    ])


def test_invites_to_non_members(make):
    users_ = growth.growth_users(invite_users(make), internal=INTERNAL)
    got = growth.invites_sent(users_, make.events(INVITES), make.company(), internal=INTERNAL)
    found = by_key(got, "OpenIdSender", "NumberInvitesToNonMembers", "NumberInvitesToNonMembersWithinFirst30Days")
    # unknown twice, later once, each twin once, the missing address once
    assert found["s"] == (6, 5)
    assert set(found) == {"s", "before", "sameday", "later", "t1", "t2", "far"}
    assert all(v == (0, 0) for k, v in found.items() if k != "s")


def test_invite_conversion(make):
    events = make.events([
        ("s", "AppInviteSent", "2018-01-10 10:00", "later@x"), ("s", "AppInviteSent", "2018-01-20", "later@x"),
        ("s", "AppInviteSent", "2018-05-02", "far@x"), ("s", "AppInviteSent", "2018-05-01 23:59", "far@x"),
        ("s", "AppInviteSent", "2018-01-10 10:00", "nobody@x"), ("s", "AppInviteSent", "2018-01-10 10:00", "before@x"),
        ("s", "AppInviteSent", "2018-06-03", "nobody@x"),
    ])
    got = growth.invite_conversion(invite_users(make), events, internal=INTERNAL, as_of=dt.date(2018, 6, 30))
    assert rows(got, "EmailAddressRetriever", "MonthYear", "InviteToNonMember", "InviteToNonMemberLeadingToSignup") == [
        ("before@x", day("2018-01-01"), 0, 0),
        ("far@x", day("2018-05-01"), 1, 0),  # 31 days
        ("far@x", day("2018-05-01"), 1, 1),  # 30 days
        ("later@x", day("2018-01-01"), 0, 0),  # same instant
        ("later@x", day("2018-01-01"), 1, 1),
        ("nobody@x", day("2018-01-01"), 1, 0),
    ]


def test_key_growth_metrics_equal_their_parts(make):
    users_ = growth.growth_users(invite_users(make), internal=INTERNAL)
    events = make.events([
        *INVITES, ("s", "SandboxDeployed", "2018-01-15"), ("later", "AppLogin", "2018-03-01"), ("t1", "SandboxDeployed", "2018-09-01"),
    ])
    company = make.company()
    whole = growth.key_growth_metrics(users_, events, company, internal=INTERNAL, retention_types=TYPES)
    parts = {
        "ActivatedWithin30days": growth.activation(users_, events, company),
        "Retained": growth.retention_second_month(users_, events, company, types=TYPES),
    }
    for column, part in parts.items():
        assert rows(whole, "UserId", "CompanyType", column) == rows(part, "UserId", "CompanyType", column)
    invites = growth.invites_sent(users_, events, company, internal=INTERNAL)
    assert rows(whole, "UserId", "NumberInvitesToNonMembers") == rows(invites, "OpenIdSender", "NumberInvitesToNonMembers")


def test_repeated_user_rows_collapse(make):
    users_ = growth.growth_users(make.users([("u", "C1", "2018-01-01")] * 2), internal=INTERNAL)
    events = make.events([("u", "SandboxDeployed", "2018-02-05")])
    got = growth.key_growth_metrics(users_, events, make.company(), internal=INTERNAL, retention_types=TYPES)
    assert rows(got, "UserId", "ActivatedWithin30days", "Retained") == [("u", 0, 1)]


def onboarded(make, user_rows, event_rows, company=None):
    events = make.events(event_rows)
    people = onboarding.onboarding_users(make.users(user_rows), events, company or make.company(), internal=INTERNAL)
    return onboarding.onboarding(people, events, activity=taxonomy.activity_types("Acme"))


def test_onboarding_spans(make):
    days = [0, 1, 8, 9, 14, 15, 30, 31, 60, 61]
    stamps = [(dt.datetime(2018, 1, 1, 12) + dt.timedelta(days=d)).isoformat() for d in days]
    got = onboarded(
        make, [("u", "C1", "2018-01-01 10:00"), ("quiet", "C7", "2018-01-01")],
        [("u", "TeamserverCommit", s) for s in stamps] + [("u", "ModelDeployed", stamps[1])]
        + [("u", "ModelerDownloaded", "2018-01-03"), ("u", "MessagePosted", "2018-01-04"), ("u", "Unlisted", "2018-01-05")]
        + [("u", "MemberSignupCompleted", "2018-01-01", "App Invitation"), ("u", "MemberSignupCompleted", "2018-01-01", "Admin")],
    )
    found = by_key(
        got, "UserId", "Source", "CompanyType", "ActiveFirstDayDev", "ActiveDays1To8DaysAfterSignupDev",
        "ActiveDays1To15DaysAfterSignupDev", "ActiveDays1To30DaysAfterSignupDev", "ActiveDays1To30DaysAfterSignupOther",
        "ActiveDays1To30DaysAfterSignup", "ActiveDays30To60DaysAfterSignup", "Retained",
    )
    # Downloads and messages are activity, but in no category; day 30 is in both totals.
    assert found["u"] == ("Invites", "Customer", 1, 2, 4, 6, 0, 8, 3, 1)
    assert found["quiet"] == ("Marketing Inbound", "Other", 0, 0, 0, 0, 0, 0, 0, 0)


def test_onboarding_spans_over_months(make):
    """Signups on any day of a month, events on many days and types, against sets of days;
    repeated user rows and repeated events of a day change nothing."""
    draw = random.Random(12)
    start = dt.datetime(2018, 1, 1)
    signups = {f"u{i}": start + dt.timedelta(days=draw.randrange(120), hours=draw.choice((0, 15))) for i in range(40)}
    kinds = [t for types in taxonomy.ONBOARDING.values() for t in types] + ["Unlisted"]
    log = [
        (f"u{draw.randrange(40)}", draw.choice(kinds), (start + dt.timedelta(days=draw.randrange(200), hours=23)).isoformat())
        for _ in range(3000)
    ]
    users_ = [(user, "C1", at.isoformat()) for user, at in signups.items()]
    got = {r.UserId: r for r in onboarded(make, users_ + users_[:5], log + log[:500]).collect()}
    assert got.keys() == signups.keys()
    any_ = set(taxonomy.activity_types("Acme"))
    for user, at in signups.items():
        def days(types, low, high):
            offsets = {(dt.date.fromisoformat(t[:10]) - at.date()).days for u, k, t in log if u == user and k in types}
            return sum(low <= offset <= high for offset in offsets)

        for category, types in taxonomy.ONBOARDING.items():
            for name, span in onboarding.SPANS.items():
                assert got[user][name.format(category)] == days(types, *span), (user, category, span)
        for name, span in onboarding.TOTAL_SPANS.items():
            assert got[user][name] == days(any_, *span)
        assert got[user].Retained == int(days(any_, 30, 60) > 0)


def test_onboarding_joins_months(make):
    """The join meets a row per user and month, however many days and events there are."""
    log = make.events([("u", "TeamserverCommit", f"2018-01-{d:02d} {h:02d}:00") for d in range(1, 32) for h in range(4)])
    months = rel.category_months(log, {**taxonomy.ONBOARDING, "Any": ("TeamserverCommit",)})
    assert [(r.OpenId, r.Dev, r.Any) for r in months.collect()] == [("u", 2**31 - 1, 2**31 - 1)]


def test_onboarding_activation(make):
    got = onboarded(
        make, [("a", "C1", "2018-01-01"), ("b", "C1", "2018-01-01"), ("c", "C1", "2018-01-01")],
        [("a", "SandboxDeployed", "2018-01-31 23:00"), ("b", "SandboxDeployed", "2018-02-01"), ("c", "SandboxDeployed", "2017-01-01")],
    )
    assert by_key(got, "UserId", "Activated") == {"a": 1, "b": 0, "c": 1}
