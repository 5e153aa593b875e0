import datetime as dt
import json

from cohortia.operators import signup
from tests.conftest import at, by_key, day, rows

VISIT, STARTED, COMPLETED = "MemberSignupFormVisit", "MemberSignupStartedExtended", "MemberSignupCompleted"
MAILED, STEP = "SignupConfirmationEmailSentSuccessful", "MemberSignupStep"
T = "2018-01-05 10:00"


def visit(cookie, group="A", experiment="7", time=T):
    return ("x", VISIT, time, cookie, None, json.dumps({"GroupName": group, "Experiment": {"ID": experiment}}))


def started(hash_, cookie, time=T, email="a@x", **fields):
    return ("x", STARTED, time, hash_, email, json.dumps({"CookieID": cookie, **fields}))


def completed(user, hash_, reason="Other", time=T):
    return (user, COMPLETED, time, reason, None, hash_)


def mailed(hash_):
    return ("x", MAILED, T, hash_)


def test_allocation_reads_valid_payloads_only(make):
    events = make.events([
        visit("c"), visit("c", time="2018-01-03"), visit("c", "B"), ("x", VISIT, T, "c", None, ""), ("x", VISIT, T, "c", None, None),
        ("x", VISIT, T, "d", None, '{"GroupName":"A"}'), ("x", VISIT, T, "e", None, "broken"),
    ])
    assert rows(signup.experiment_allocation(events)) == [
        ("c", "A", "7", at("2018-01-03"), 2), ("c", "B", "7", at(T), 1), ("d", "A", None, at(T), 1),
    ]


FUNNEL = [
    visit("none"), visit("started"), visit("mailed"), visit("done"), visit("done", "B"),
    started("h1", "started"), started("h2", "mailed"), mailed("h2"),
    started("h3", "done", Brand="b"), started("h2b", "done", Brand="c"), mailed("h3"), mailed("h3"),
    completed("u", "h3"), completed("u", "h3"), completed("v", None),
    visit("own"), started("h4", "own", email="x@ACME.com"),
]


def funnel(make, event_rows=FUNNEL, **options):
    return signup.signup_funnel_by_visit(make.events(event_rows), internal="acme", **options)


def test_funnel_stages(make):
    got = rows(funnel(make), "CookieId", "ExperimentGroup", "OpenId", "SignupStarted", "EmailSuccessfulSent", "SignupCompleted")
    assert got == [
        ("done", "A", "u", 1, 1, 1), ("done", "B", "u", 1, 1, 1), ("mailed", "A", None, 1, 1, 0), ("none", "A", None, 0, 0, None),
        ("own", "A", None, 0, 0, None), ("started", "A", None, 1, 0, None),
    ]


def test_funnel_takes_the_maximum_of_each_attribute(make):
    assert by_key(funnel(make).where("ExperimentGroup = 'B'"), "CookieId", "Brand", "CountSignupPageVisits") == {"done": ("c", 1)}


def test_early_form_fans_out_and_test_form_counts_visits(make):
    assert len(rows(funnel(make, dedupe=False).where("CookieId = 'done' AND ExperimentGroup = 'A'"))) == 4
    got = funnel(make, [visit("c"), visit("c"), visit("c")], cap_visits=False, dedupe=False, profile=[])
    assert rows(got, "CountSignupPageVisits") == [(3,)]


def test_copies_count_what_the_early_form_repeats(make):
    counted = funnel(make, dedupe=False, copies="n")
    repeated = funnel(make, dedupe=False).groupBy("CookieId", "ExperimentGroup").count()
    assert rows(counted, "CookieId", "ExperimentGroup", "n") == rows(repeated)
    assert set(rows(funnel(make, copies="n"), "n")) == {(1,)}


def test_unique_signups_counts(make):
    got = signup.unique_signups(make.events(FUNNEL), internal="acme")
    assert by_key(got, "CookieId", "NumberOfSignups") == {"started": 0, "mailed": 0, "done": 2}


def growth_table(make, rows_):
    return make.table(
        "UserId string, CompanyType string, SignupDate date, ActivatedWithin30days int, Retained int", rows_
    )


def test_growth_is_masked_until_mature(make):
    signups = {"w30": "2018-05-02", "w31": "2018-05-01", "w60": "2018-04-02", "w61": "2018-04-01"}
    events = [e for u in signups for e in (visit(f"c{u}"), started(f"h{u}", f"c{u}"), mailed(f"h{u}"), completed(u, f"h{u}"))]
    growth = growth_table(make, [(u, "Other", day(d), 1, 1) for u, d in signups.items()])
    got = signup.signup_with_growth(funnel(make, events), growth, as_of=dt.datetime(2018, 6, 1, 23))
    assert by_key(got, "OpenId", "Activated", "Retained1") == {
        "w30": (None, None), "w31": (1, None), "w60": (1, None), "w61": (1, 1),
    }


def test_visits_after_signup_are_dropped_only_in_the_current_form(make):
    events = [visit("c"), started("h", "c"), mailed("h"), completed("u", "h"), visit("d")]
    growth = growth_table(make, [("u", "Other", day("2018-01-04"), 1, 1)])
    keep = lambda **o: rows(
        signup.signup_with_growth(funnel(make, events), growth, as_of=dt.date(2018, 6, 1), **o), "CookieId"
    )
    assert keep() == [("d",)]
    assert keep(visit_before_signup=False) == [("c",), ("d",)]


LEAD = ("L", "Co", "Marketing - Inbound", "Open", day("2018-01-01"), True, False, "West", "Ann")
LEAD_SCHEMA = (
    "_Id string, Company string, LeadSource string, Status string, MQL_Date_Enter__c date, MQL__c boolean, "
    "Converted_to_SO__c boolean, Sales_Unit__c string, Lead_Owner_String__c string"
)


def test_lead_filters(make):
    def lead(id_, **changes):
        values = dict(zip(["_Id", "Company", "LeadSource", "Status", "MQL", "m", "c", "unit", "owner"], LEAD))
        values.update(changes, _Id=id_)
        return tuple(values.values())

    leads = make.table(LEAD_SCHEMA, [
        lead("good"), lead("unlinked"), lead("source", LeadSource="Sales"), lead("status", Status="Partner"),
        lead("nullstatus", Status=None), lead("own", Company="The ACME"), lead("nullcompany", Company=None),
        lead("unknown", unit="unknown"), lead("channel", unit="Channel 4"), lead("nullunit", unit=None),
        lead("owner", owner="J. Stone"), lead("nullowner", owner=None), lead("nodate", MQL=None),
    ])
    ids = [r[0] for r in leads.collect() if r[0] != "unlinked"]
    links = make.table("OpenId string, LeadId string", [(f"u-{i}", i) for i in ids] + [(None, "good"), ("w", "absent")])
    got = signup.qualified_leads(links, leads, internal="acme", excluded_owners=["Stone"])
    assert rows(got, "OpenId", "LeadId", "MQL__c", "Converted_to_SO__c") == [("u-good", "good", 1, 0)]


def test_signup_full_adds_type_and_leads(make):
    rows_ = make.table("CookieId string, ExperimentGroup string, Experiment string, OpenId string",
                       [("c", "A", "7", "u"), ("d", "A", "7", None)])
    types = make.table("OpenId string, CustomerType string", [("u", "Low-code"), (None, "No-code")])
    leads = make.table("OpenId string, MQL__c int, MQL_Date_Enter__c date, Converted_to_SO__c int", [("u", 1, None, 0), ("u", 0, None, 1)])
    got = signup.signup_full(rows_, types, leads)
    assert rows(got, "CookieId", "CustomerType", "MQL__c") == [("c", "Low-code", 0), ("c", "Low-code", 1), ("d", None, None)]


def test_step_funnel(make):
    events = make.events([
        started("h", "c", time="2018-02-01"), started("g", "c", time="2018-01-01"), mailed("h"), completed("u", "h"),
        ("x", STEP, T, "h", "AgreeToEmail"), ("x", STEP, T, "h", "AgreeToEmail"), ("x", STEP, T, None, "AgreeToEmail"),
        started("n", "quiet"),
    ])
    got = signup.signup_step_funnel(events, internal="acme")
    assert by_key(got, "CookieId", "SignupDateStarted", "SignupCompleted", "AgreeToEmail", "ProjectCreated") == {
        "c": (day("2018-01-01"), 1, 1, 0), "quiet": (day(T[:10]), None, None, None),
    }


QUESTION = "Where to?"


def step(hash_, page, payload):
    text = payload if isinstance(payload, (str, type(None))) else json.dumps(payload)
    return ("x", STEP, T, hash_, page, text)


def question(name, **chosen):
    return {"QuestionName": name, "Answers": [
        {"AnswerContent": a.replace("_", "-"), "SortOrder": i, "Selected": v} for i, (a, v) in enumerate(chosen.items())]}


ANSWERED = [
    step("h", "p", {"PageStatus": "done", "Questions": [question(QUESTION, No_code="false", Low_code="true")]}),
    step("h", "bad", "not json"), step("h", "empty", {"PageStatus": "s", "Questions": []}), step("h", "null", {"PageStatus": "s"}),
    step(None, "p", {"Questions": [question(QUESTION, No_code="true")]}),
    step("g", "p", {"PageStatus": "s", "Questions": question("Single", X=True)}),
    step("k", "p", {"PageStatus": "s", "Questions": [question(QUESTION, No_code="true", Low_code="true"), question("Other", Z="true")]}),
    started("h", "c", time="2018-01-07"), started("i", "c", time="2018-01-06"), started("k", "d"),
    completed("u", "h"), completed("w", "k"),
]


def test_form_answers(make):
    got = signup.form_answers(make.events(ANSWERED), internal="acme")
    assert rows(got, "ConfirmationHash", "CookieId", "SignupDate", "QuestionName", "AnswerContent", "AnswerSortOrder", "AnswerSelected") == [
        ("g", None, None, "Single", "X", 0, "true"),
        ("h", "c", day("2018-01-06"), QUESTION, "Low-code", 1, "true"),
        ("h", "c", day("2018-01-06"), QUESTION, "No-code", 0, "false"),
        ("k", "d", day("2018-01-05"), "Other", "Z", 0, "true"),
        ("k", "d", day("2018-01-05"), QUESTION, "Low-code", 1, "true"),
        ("k", "d", day("2018-01-05"), QUESTION, "No-code", 0, "true"),
    ]


def test_page_info_counts_cookies_and_choices(make):
    got = signup.page_info_daily(signup.form_answers(make.events(ANSWERED), internal="acme"))
    assert rows(got.where("AnswerContent = 'Low-code'"), "SignupDate", "UniqueCountPageStatus", "ChosenAnswer") == [
        (day("2018-01-05"), 1, 1), (day("2018-01-06"), 1, 1),
    ]


def test_customer_type_priority_and_null_user(make):
    events = make.events(ANSWERED)
    got = signup.customer_types(signup.form_answers(events, internal="acme"), events, question=QUESTION)
    assert rows(got) == [(None, None), ("u", "Low-code"), ("w", "No-code")]


def test_new_users(make):
    users = make.users([("u", "C1", "2018-01-05"), ("old", "C1", "2017-01-01"), ("plain", "C7", "2018-01-05"), ("own", "Acme", "2018-01-05")])
    events = make.events([
        started("h", "c", HasStudentDomain="true"), completed("u", "h", "App Invitation"), completed("u", None, "Admin"),
        completed("own", "unknown"), completed(None, "h"),
    ])
    growth = growth_table(make, [("u", "Customer", day("2018-01-05"), 1, 1)])
    got = signup.new_users(users, events, growth, make.company(), internal="acme", since=dt.date(2017, 1, 1))
    assert rows(got, "Email", "OpenId", "SignupSource", "HasStudentDomain", "SignupCompleted", "CompanyType", "DisplayName") == [
        ("own@x", "own", "Marketing Inbound", None, 1, None, None),
        ("plain@x", None, None, None, None, None, None),
        ("u@x", "u", "Invites", "true", 1, "Customer", "One"),
        ("u@x", "u", "Marketing Inbound", None, 0, "Customer", "One"),
    ]
