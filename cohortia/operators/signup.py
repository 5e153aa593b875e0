"""Signup funnels, form answers, customer types, leads and new users."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions import dates, payload, text
from cohortia.operators import relational as rel
from cohortia.sources import taxonomy

_VISIT_PAYLOAD = "struct<GroupName:string,Experiment:struct<ID:string>>"


# --- experiment allocation -------------------------------------------------------


def _visits(events: DataFrame) -> DataFrame:
    return (
        rel.event_scan(events, [taxonomy.FORM_VISIT])
        .where(text.not_blank(F.col("ExtraInfo3")))
        .select(
            F.col("ExtraInfo1").alias("CookieId"),
            "Timestamp",
            F.explode(payload.open_json(F.col("ExtraInfo3"), _VISIT_PAYLOAD)).alias("J"),
        )
        .select(
            "CookieId",
            "Timestamp",
            payload.scalar_text(F.col("J.GroupName")).alias("GroupName"),
            payload.scalar_text(F.col("J.Experiment.ID")).alias("ExperimentId"),
        )
    )


def experiment_allocation(events: DataFrame) -> DataFrame:
    """First visit and number of visits per cookie, group and experiment."""
    return _visits(events).groupBy("CookieId", "GroupName", "ExperimentId").agg(
        F.min("Timestamp").alias("FirstSignupPageVisit"),
        F.count("Timestamp").alias("NumberOfSignupPageVisits"),
    )


# --- funnel ------------------------------------------------------------------------

_STARTED_FIELDS = (
    "CookieID", "HasStudentDomain", "StudentType", "Brand", "Source", "IpAddress",
    "AreaOfFocus", "JobRole",
)


def started_signups(events: DataFrame, *, internal: str) -> DataFrame:
    """Started signups of external e-mail addresses with the decoded payload."""
    fields = payload.json_fields(F.col("ExtraInfo3"), _STARTED_FIELDS)
    return (
        rel.event_scan(events, [taxonomy.SIGNUP_STARTED])
        .where(text.lacks(F.col("ExtraInfo2"), internal))
        .select(
            F.col("ExtraInfo1").alias("ConfirmationHash"),
            F.col("ExtraInfo2").alias("Email"),
            F.to_date("Timestamp").alias("SignupDateStarted"),
            fields["CookieID"].alias("CookieId"),
            *[fields[n].alias(n) for n in _STARTED_FIELDS[1:]],
        )
    )


def unique_signups(events: DataFrame, *, internal: str) -> DataFrame:
    """One signup per cookie: the maximum of every attribute, each by itself."""
    kept = ["HasStudentDomain", "StudentType", "Brand", "Source", "ConfirmationHash",
            "Email", "AreaOfFocus", "JobRole"]
    return (
        started_signups(events, internal=internal)
        .groupBy("CookieId")
        .agg(
            *[F.max(c).alias(c) for c in kept],
            F.count("Brand").alias("NumberOfSignups"),
            F.min("SignupDateStarted").alias("SignupDateStarted"),
        )
    )


def _completed(events: DataFrame) -> DataFrame:
    return rel.event_scan(events, [taxonomy.SIGNUP_COMPLETED]).select(
        "OpenId", F.col("ExtraInfo3").alias("CompletedHash")
    )


def signup_facts(
    events: DataFrame, *, internal: str, families: Sequence[str],
    step_flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Visits, starts, completions, mails and steps of signups from one scan of the log.

    ``families`` are the event types wanted.  One typed aggregation combines each family
    by what it is joined on, map-side: visits by cookie, group and experiment, starts by
    cookie and hash, completions by hash and user, mails and steps by hash.  Read the
    families with ``relational.part_of``.
    """
    type_, text3 = F.col("EventType"), F.col("ExtraInfo3")

    def of(*types: str) -> Column:
        return rel.one_of("EventType", types)

    def when(family: str, value: Column) -> Column:
        return F.when(type_ == family, value)

    visit, start = taxonomy.FORM_VISIT, taxonomy.SIGNUP_STARTED
    done, mail, step = taxonomy.SIGNUP_COMPLETED, taxonomy.EMAIL_SENT, taxonomy.SIGNUP_STEP
    wanted = (
        (type_ == visit) & text.not_blank(text3)
        | (type_ == start) & text.lacks(F.col("ExtraInfo2"), internal)
        | of(done, mail)
        | (type_ == step) & F.col("ExtraInfo1").isNotNull()
    )
    fields = payload.json_fields(when(start, text3), _STARTED_FIELDS)
    flags = step_flags or {}
    rows = (
        rel.event_scan(events, families)
        .where(wanted)
        .select(
            "EventType", "OpenId", "Timestamp", "ExtraInfo1", "ExtraInfo2", "ExtraInfo3",
            F.explode_outer(payload.open_json(when(visit, text3), _VISIT_PAYLOAD)).alias("J"),
        )
        .where((type_ != visit) | F.col("J").isNotNull())
        .select(
            type_.alias("Family"),
            when(visit, F.col("ExtraInfo1")).otherwise(fields["CookieID"]).alias("CookieId"),
            F.when(of(start, mail, step), F.col("ExtraInfo1")).when(type_ == done, text3).alias("Hash"),
            when(done, F.col("OpenId")).alias("OpenId"),
            payload.scalar_text(F.col("J.GroupName")).alias("GroupName"),
            payload.scalar_text(F.col("J.Experiment.ID")).alias("ExperimentId"),
            "Timestamp",
            when(start, F.col("ExtraInfo2")).alias("Email"),
            *[fields[n].alias(n) for n in _SIGNUP_FIELDS],
            *[when(step, rel.flag(F.col("ExtraInfo2") == page)).alias(n) for n, page in flags.items()],
        )
    )
    facts = rows.groupBy(*_FACT_KEYS).agg(
        F.count(F.lit(1)).alias("Times"), F.min("Timestamp").alias("First"),
        F.count("Brand").alias("Brands"),
        *[F.max(c).alias(c) for c in ("Email", *_SIGNUP_FIELDS, *flags)],
    )
    return rel.read_together(facts)


_FACT_KEYS = ["Family", "CookieId", "Hash", "OpenId", "GroupName", "ExperimentId"]
_SIGNUP_FIELDS = [n for n in _STARTED_FIELDS if n not in ("CookieID", "IpAddress")]


def _family(facts: DataFrame, family: str) -> DataFrame:
    return rel.part_of(facts, F.col("Family") == family)


def _signups_of(facts: DataFrame) -> DataFrame:
    """:func:`unique_signups` from facts."""
    return (
        _family(facts, taxonomy.SIGNUP_STARTED)
        .groupBy("CookieId")
        .agg(
            *[F.max(c).alias(c) for c in (*_SIGNUP_FIELDS, "Email")],
            F.max("Hash").alias("ConfirmationHash"),
            F.sum("Brands").alias("NumberOfSignups"),
            F.to_date(F.min("First")).alias("SignupDateStarted"),
        )
    )


def _progress_of(facts: DataFrame, signups: DataFrame) -> DataFrame:
    """Signups with the completions and mails of the facts."""
    completed = _family(facts, taxonomy.SIGNUP_COMPLETED).select(
        "OpenId", F.col("Hash").alias("CompletedHash"), F.col("Times").alias("_completions"))
    emails = _family(facts, taxonomy.EMAIL_SENT).select(
        F.col("Hash").alias("EmailHash"), F.col("Times").alias("_mails"))
    return _with_progress(signups, completed, emails)


def _with_progress(signups: DataFrame, completed: DataFrame, emails: DataFrame) -> DataFrame:
    """Attach completion and confirmation mail to signups, by hash.

    Completions and mails come as distinct rows with counts, ``_completions`` and
    ``_mails``: what one frequent hash repeats is carried as a number.
    The joins run on the signups before any visit is involved: most visits never
    sign up, and joining those on their NULL hash would pile up in one task.
    """
    hash_ = F.col("ConfirmationHash")
    return (
        signups.join(completed, hash_ == F.col("CompletedHash"), "left")
        .join(emails, hash_ == F.col("EmailHash"), "left")
        .withColumn("SignupStarted", rel.flag(hash_.isNotNull()))
        .withColumn("EmailSuccessfulSent", rel.flag(F.col("EmailHash").isNotNull()))
        .withColumn(
            "SignupCompleted",
            F.when(F.col("EmailHash").isNotNull(), rel.flag(F.col("CompletedHash").isNotNull())),
        )
    )


def _repetitions() -> Column:
    """How often completions and mails repeat a signup."""
    one = F.lit(1)
    return F.coalesce("_completions", one) * F.coalesce("_mails", one)


_FUNNEL_PROFILE = ["HasStudentDomain", "StudentType", "Brand", "Source"]
_FUNNEL_EXTRA = ["AreaOfFocus", "JobRole"]


def signup_funnel_by_visit(
    events: DataFrame,
    *,
    internal: str,
    profile: Sequence[str] = (*_FUNNEL_PROFILE, *_FUNNEL_EXTRA),
    dedupe: bool = True,
    cap_visits: bool = True,
    copies: str | None = None,
) -> DataFrame:
    """Signup progress per cookie, experiment group and experiment.

    ``SignupCompleted`` is NULL until the confirmation mail was sent.  With
    ``dedupe=False`` repeated completions and mails fan out, as in the older
    form; ``cap_visits=False`` keeps the number of visits, as in the test form.

    ``copies`` names a column that counts the repetitions of a row instead of
    repeating it.  Completions times mails of one signup can be very many, so
    statistics over the older forms should use it as their weight.  Without it the
    repetitions unfold after all joins.
    """
    facts = signup_facts(
        events, internal=internal,
        families=[taxonomy.FORM_VISIT, taxonomy.SIGNUP_STARTED, taxonomy.SIGNUP_COMPLETED,
                  taxonomy.EMAIL_SENT],
    )
    visits = _family(facts, taxonomy.FORM_VISIT).select(
        "CookieId",
        F.col("GroupName").alias("ExperimentGroup"),
        F.col("ExperimentId").alias("Experiment"),
        F.to_date("First").alias("FirstSignupPageVisit"),
        F.when(F.col("CookieId").isNull(), 0).otherwise(F.col("Times")).alias("CountSignupPageVisits"),
    )
    if cap_visits:
        visits = visits.withColumn(
            "CountSignupPageVisits", rel.flag(F.col("CountSignupPageVisits") > 0)
        )
    progress = _progress_of(facts, _signups_of(facts).withColumnRenamed("CookieId", "SignupCookie"))
    started = F.coalesce("SignupStarted", F.lit(0))
    mailed = F.coalesce("EmailSuccessfulSent", F.lit(0))
    count = F.lit(1) if dedupe else _repetitions()
    rows = visits.join(
        progress, F.col("CookieId") == F.col("SignupCookie"), "left"
    ).select(
        "CookieId",
        "OpenId",
        *profile,
        "FirstSignupPageVisit",
        "ExperimentGroup",
        "Experiment",
        "Email",
        "CountSignupPageVisits",
        started.alias("SignupStarted"),
        mailed.alias("EmailSuccessfulSent"),
        "SignupCompleted",
        count.cast("bigint").alias(copies or "_copies"),
    )
    if copies is not None:
        return rows
    return rows.drop("_copies") if dedupe else rel.unfolded(rows, "_copies")


def signup_with_growth(
    funnel: DataFrame,
    growth: DataFrame,
    *,
    as_of: dt.date | dt.datetime,
    visit_before_signup: bool = True,
    with_retained: bool = True,
) -> DataFrame:
    """Funnel rows with growth metrics, shown only once their window has closed.

    ``visit_before_signup`` keeps rows whose first visit is not later than the
    signup day (or that have no signup).  Most funnel rows carry no user id, so
    the join scatters the NULL keys.
    """
    today = dates.as_day(as_of)
    joined = rel.left_join_sparse_key(
        funnel, growth, "OpenId", "UserId", ["CookieId", "ExperimentGroup", "Experiment"],
        blanks_match=False,
    )
    if visit_before_signup:
        joined = joined.where(
            F.col("SignupDate").isNull()
            | (F.col("FirstSignupPageVisit") <= F.col("SignupDate"))
        )
    signup = F.col("SignupDate")
    out = joined.withColumn(
        "Activated",
        dates.once_mature(F.date_add(signup, 30), today, F.col("ActivatedWithin30days")),
    )
    if with_retained:
        out = out.withColumn(
            "Retained1", dates.once_mature(F.date_add(signup, 60), today, F.col("Retained"))
        )
    return out


# --- leads -------------------------------------------------------------------------


def qualified_leads(
    user_leads: DataFrame,
    leads: DataFrame,
    *,
    internal: str,
    sources: Iterable[str] = ("Marketing - Inbound",),
    excluded_status: Iterable[str] = ("Bad data", "Education", "Partner"),
    excluded_units: Iterable[str] = ("Unknown", "Channel"),
    excluded_owners: Iterable[str] = (),
) -> DataFrame:
    """Marketing-qualified leads linked to a user, with the converted flag.

    Excluded units and owners are substrings.  As every exclusion uses
    three-valued logic, a lead with NULL in a filtered column is dropped.
    """
    kept = (
        F.col("LeadSource").isin(*sources)
        & ~F.col("Status").isin(*excluded_status)
        & text.lacks(F.col("Company"), internal)
        & F.col("MQL_Date_Enter__c").isNotNull()
    )
    for part in excluded_units:
        kept = kept & text.lacks(F.col("Sales_Unit__c"), part)
    for part in excluded_owners:
        kept = kept & text.lacks(F.col("Lead_Owner_String__c"), part)
    qualified = leads.where(kept).select(
        F.col("_Id").alias("LeadId"), "Company", "LeadSource", "Status",
        F.col("MQL__c").cast("int").alias("MQL__c"), "MQL_Date_Enter__c",
    )
    converted = leads.select(
        F.col("_Id").alias("LeadId"),
        F.col("Converted_to_SO__c").cast("int").alias("Converted_to_SO__c"),
    )
    linked = user_leads.where(F.col("OpenId").isNotNull()).select("OpenId", "LeadId")
    return (
        linked.join(qualified, "LeadId", "inner")
        .join(converted, "LeadId", "left")
        .select(
            "OpenId", "LeadId", "Company", "LeadSource", "Status",
            "MQL__c", "MQL_Date_Enter__c", "Converted_to_SO__c",
        )
    )


def signup_full(signups: DataFrame, customer_types: DataFrame, leads: DataFrame) -> DataFrame:
    """Signup rows with customer type and lead progress."""
    types = customer_types.select(F.col("OpenId").alias("_type_user"), "CustomerType")
    linked = leads.select(
        F.col("OpenId").alias("_lead_user"), "MQL__c", "MQL_Date_Enter__c", "Converted_to_SO__c"
    )
    spread = ["CookieId", "ExperimentGroup", "Experiment"]
    typed = rel.left_join_sparse_key(signups, types, "OpenId", "_type_user", spread)
    return rel.left_join_sparse_key(typed, linked, "OpenId", "_lead_user", spread).drop(
        "_type_user", "_lead_user"
    )


# --- step funnel ---------------------------------------------------------------------


def signup_step_funnel(
    events: DataFrame,
    *,
    internal: str,
    step_flags: Mapping[str, str] = taxonomy.SIGNUP_STEP_FLAGS,
) -> DataFrame:
    """Signup progress and page flags per cookie.

    ``step_flags`` maps output column to page name; a flag is NULL when the
    signup has no step event at all.
    """
    facts = signup_facts(
        events, internal=internal, step_flags=step_flags,
        families=[taxonomy.SIGNUP_STARTED, taxonomy.SIGNUP_COMPLETED, taxonomy.EMAIL_SENT,
                  taxonomy.SIGNUP_STEP],
    )
    signups = _signups_of(facts).select("CookieId", "SignupDateStarted", "ConfirmationHash", "Email")
    steps = _family(facts, taxonomy.SIGNUP_STEP).select(F.col("Hash").alias("StepHash"), *step_flags)
    progress = _progress_of(facts, signups)
    rows = progress.join(
        steps, F.col("ConfirmationHash") == F.col("StepHash"), "left"
    ).select(
        "CookieId", "SignupDateStarted", "OpenId", "Email",
        "SignupStarted", "EmailSuccessfulSent", "SignupCompleted", *step_flags,
        _repetitions().alias("_copies"),
    )
    return rel.unfolded(rows, "_copies")


# --- form answers ----------------------------------------------------------------------


def form_answers(events: DataFrame, *, internal: str) -> DataFrame:
    """One row per answer offered on a signup page.

    Per signup and page the smallest status and question list are used, then
    questions and answers are unfolded.  Cookie and signup day come from the
    smallest hash of each cookie and are NULL for other signups.
    """
    pages = (
        rel.event_scan(events, [taxonomy.SIGNUP_STEP])
        .where(payload.is_json(F.col("ExtraInfo3")) & F.col("ExtraInfo1").isNotNull())
        .groupBy(
            F.col("ExtraInfo1").alias("ConfirmationHash"),
            F.col("ExtraInfo2").alias("SignupFormPage"),
        )
        .agg(
            F.min(payload.json_value(F.col("ExtraInfo3"), "$.PageStatus")).alias("PageStatus"),
            F.min(payload.json_query(F.col("ExtraInfo3"), "$.Questions")).alias("Questions"),
        )
    )
    question, answer = F.col("Q"), F.col("A")
    questions = pages.select(
        "ConfirmationHash", "SignupFormPage", "PageStatus",
        F.explode(payload.open_variant(F.col("Questions"))).alias("Q"),
    )
    answers = questions.select(
        "ConfirmationHash", "SignupFormPage", "PageStatus",
        payload.scalar_at(question, "$.QuestionName").alias("QuestionName"),
        F.explode(payload.members(payload.at(question, "$.Answers"))).alias("A"),
    ).select(
        "ConfirmationHash", "SignupFormPage", "PageStatus", "QuestionName",
        payload.scalar_at(answer, "$.AnswerContent").alias("AnswerContent"),
        payload.scalar_at(answer, "$.SortOrder").try_cast("int").alias("AnswerSortOrder"),
        payload.scalar_at(answer, "$.Selected").alias("AnswerSelected"),
    )
    cookies = (
        rel.event_scan(events, [taxonomy.SIGNUP_STARTED])
        .where(
            text.lacks(F.col("ExtraInfo2"), internal) & text.not_blank(F.col("ExtraInfo3"))
        )
        .groupBy(payload.json_value(F.col("ExtraInfo3"), "$.CookieID").alias("CookieId"))
        .agg(
            F.min("ExtraInfo1").alias("ConfirmationHash"),
            F.min(F.to_date("Timestamp")).alias("SignupDate"),
        )
    )
    return answers.join(cookies, "ConfirmationHash", "left").select(
        "CookieId", "SignupDate", "ConfirmationHash", "SignupFormPage", "PageStatus",
        "QuestionName", "AnswerContent", "AnswerSortOrder", "AnswerSelected",
    )


def page_info_daily(answers: DataFrame) -> DataFrame:
    """Distinct cookies and chosen answers per day, page, question and answer."""
    return answers.groupBy(
        "SignupDate", "SignupFormPage", "QuestionName", "AnswerContent", "PageStatus"
    ).agg(
        F.countDistinct("CookieId").alias("UniqueCountPageStatus"),
        rel.count_if(F.col("AnswerSelected") == "true").alias("ChosenAnswer"),
    )


CUSTOMER_TYPES = ("No-code", "Low-code", "Project management")


def answer_pivot(
    answers: DataFrame, events: DataFrame, labels: Mapping[str, str]
) -> DataFrame:
    """Per user one column per label ``question - answer`` with the largest
    selection text.  Answers of unfinished signups share the NULL user."""
    users = _completed(events).where(F.col("CompletedHash").isNotNull()).distinct()
    owned = answers.join(
        users, F.col("ConfirmationHash") == F.col("CompletedHash"), "left"
    )
    label = text.concat_blank(F.col("QuestionName"), F.lit(" - "), F.col("AnswerContent"))
    return rel.pivot_max(owned, ["OpenId"], label, F.col("AnswerSelected"), labels)


def customer_types(
    answers: DataFrame,
    events: DataFrame,
    *,
    question: str,
    priority: Sequence[str] = CUSTOMER_TYPES,
) -> DataFrame:
    """Customer type per user: the first chosen answer of ``question`` in
    priority order, NULL when none was chosen."""
    columns = {f"_t{i}": f"{question} - {answer}" for i, answer in enumerate(priority)}
    pivot = answer_pivot(answers, events, columns)
    chosen = [F.when(F.col(c) == "true", F.lit(a)) for c, a in zip(columns, priority)]
    return pivot.select("OpenId", F.coalesce(*chosen).alias("CustomerType"))


# --- new users ---------------------------------------------------------------------------

_NEW_USER_PROFILE = ["HasStudentDomain", "StudentType"]


def new_users(
    users: DataFrame,
    events: DataFrame,
    growth: DataFrame,
    company: DataFrame,
    *,
    internal: str,
    since: dt.date,
    profile: Sequence[str] = (*_NEW_USER_PROFILE, *_FUNNEL_EXTRA),
    invite_reasons: Iterable[str] = taxonomy.INVITE_REASONS,
) -> DataFrame:
    """Users who signed up after ``since`` with source, company and type.

    One row per user and completed signup.  ``SignupCompleted`` is 1 for every
    completed event with a hash, whether or not its start is known.
    """
    started = rel.counted(
        started_signups(events, internal=internal).select(
            F.col("ConfirmationHash").alias("StartedHash"), *profile
        ),
        "_starts",
    )
    completed = rel.event_scan(events, [taxonomy.SIGNUP_COMPLETED]).where(
        F.col("OpenId").isNotNull()
    ).select(
        "OpenId",
        F.col("ExtraInfo3").alias("CompletedHash"),
        F.col("ExtraInfo1").alias("SignupReason"),
        F.when(F.col("ExtraInfo1").isin(*invite_reasons), "Invites")
        .otherwise("Marketing Inbound")
        .alias("SignupSource"),
    )
    signups = completed.join(
        started, F.col("CompletedHash") == F.col("StartedHash"), "left"
    ).select(
        F.col("OpenId").alias("UserKey"), "OpenId", *profile, "SignupReason", "SignupSource",
        rel.flag(F.col("CompletedHash").isNotNull()).alias("SignupCompleted"), "_starts",
    )
    repeated = signups.groupBy(*[c for c in signups.columns if c != "_starts"]).agg(
        F.sum(F.coalesce("_starts", F.lit(1))).alias("_copies")
    )
    recent = users.where(F.to_date("SignupDate") > F.lit(since)).select(
        F.col("OpenId").alias("UserKey"), "Country",
        F.to_date("SignupDate").alias("SignupDateUser"), "Brand", "CompanyId",
        F.col("email").alias("Email"),
    )
    types = growth.select(F.col("UserId").alias("UserKey"), "CompanyType")
    names = company.select("CompanyId", "DisplayName")
    known = recent.join(names, "CompanyId", "left").join(types, "UserKey", "left")
    return rel.unfolded(known.join(repeated, "UserKey", "left"), "_copies").select(
        "OpenId", *profile, "SignupReason", "SignupSource", "SignupCompleted",
        "CompanyType", "Country", "SignupDateUser", "Brand", "CompanyId", "Email",
        "DisplayName",
    )
