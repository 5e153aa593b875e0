"""Growth metrics, onboarding, existing users, resurrection."""

from bindings import rules
from bindings.registry import in_list, register
from cohortia.operators import existing, growth, onboarding
from cohortia.sources import taxonomy

GROWTH = taxonomy.growth_types(rules.PRODUCT)
ACTIVITY = taxonomy.activity_types(rules.PRODUCT)
AS_OF = "TIMESTAMP '2019-12-15 09:30:00'"
EXTERNAL = "CompanyId NOT ILIKE '%acme%'"

def days_in(days: str, low: str, high: str) -> str:
    """How many of a list of days (NULL: none) lie in a closed range of instants."""
    return (
        f"coalesce(len(list_filter({days}, lambda d: CAST(d AS TIMESTAMP) >= {low} "
        f"AND CAST(d AS TIMESTAMP) <= {high})), 0)"
    )


# One row of facts for each external user; the growth tables are columns of it.
KGM = f"""
company_kind AS (
  SELECT CompanyId, ['Partner', 'Customer', 'University', 'Other'][
    min(list_position([IsPartner, IsCustomer, IsUniversity, 1], 1))] AS kind
  FROM company_current GROUP BY CompanyId),
ucur AS (
  SELECT OpenId AS UserId, CompanyId, email, OldSignupDate::DATE AS SignupDate,
    OldSignupDate + to_days(30) AS LowerBoundary, OldSignupDate + to_days(60) AS UpperBoundary
  FROM user_current WHERE {EXTERNAL} AND trim(OpenId) <> ''),
growth_log AS (
  SELECT OpenId, EventType, "Timestamp" AS moment, ExtraInfo1 AS receiver, CompanyId FROM platform_event
  WHERE list_contains({GROWTH}, EventType) AND "Timestamp" > TIMESTAMP '{rules.GROWTH_SINCE}'),
seen AS (
  SELECT OpenId, list(DISTINCT moment::DATE) AS days,
    min(moment) FILTER (list_contains({list(taxonomy.ACTIVATION)}, EventType)) AS deployed
  FROM growth_log GROUP BY OpenId),
sent AS (
  SELECT i.OpenId, i.moment FROM growth_log i LEFT JOIN ucur r ON r.email = i.receiver
  WHERE list_contains({list(taxonomy.INVITES)}, i.EventType) AND i.{EXTERNAL} AND i.OpenId <> ''
    AND coalesce(i.moment < r.SignupDate, true)),
sent_by AS (SELECT OpenId, list(moment::DATE) AS days FROM sent GROUP BY OpenId),
facts AS (
  SELECT u.*, coalesce(kind, 'Other') AS CompanyType, deployed AS FirstDateOfEvent,
    coalesce(deployed::DATE - u.SignupDate <= 30, false)::INTEGER AS ActivatedWithin30days,
    {days_in('seen.days', 'LowerBoundary', 'UpperBoundary')} AS DaysActiveInSecondMonth,
    coalesce(len(sent_by.days), 0) AS NumberInvitesToNonMembers,
    coalesce(len(list_filter(sent_by.days, lambda d: d - u.SignupDate <= 30)), 0) AS NumberInvitesToNonMembersWithinFirst30Days
  FROM ucur u LEFT JOIN company_kind USING (CompanyId)
    LEFT JOIN seen ON seen.OpenId = u.UserId LEFT JOIN sent_by ON sent_by.OpenId = u.UserId),
kgm AS (
  SELECT UserId, CompanyType, SignupDate, LowerBoundary, UpperBoundary, ActivatedWithin30days,
    (DaysActiveInSecondMonth > 0)::INTEGER AS Retained,
    NumberInvitesToNonMembers, NumberInvitesToNonMembersWithinFirst30Days FROM facts)
"""
KGM_VIEWS = "platform_event user_current company_current"
USER = "UserId CompanyType SignupDate:date LowerBoundary:time UpperBoundary:time"
INVITE = "NumberInvitesToNonMembers:int NumberInvitesToNonMembersWithinFirst30Days:int"
KGM_SCHEMA = f"{USER} ActivatedWithin30days:int Retained:int {INVITE}"


def growth_parts(t, types=GROWTH):
    events = growth.growth_events(t.platform_event(), types=types, after=rules.GROWTH_SINCE)
    return growth.growth_users(t.user_current(), internal=rules.INTERNAL), events


def kgm(t):
    users, events = growth_parts(t)
    return growth.key_growth_metrics(
        users, events, t.company_current(), internal=rules.INTERNAL, retention_types=GROWTH
    )


@register(
    "m01_initiative_events",
    "ChangedId:int OpenId EventType Timestamp:time CompanyId ExtraInfo1 ExtraInfo2 ExtraInfo3",
    "platform_event",
    f"""result AS (SELECT * FROM platform_event WHERE EventType IN {in_list(taxonomy.INITIATIVE_EVENTS)}
      AND "Timestamp" > TIMESTAMP '2016-12-01')""",
)
def initiative_events(t):
    return growth.initiative_events(t.platform_event(), after=rules.LOG_SINCE)


@register(
    "m02_growth_users", "UserId CompanyId email SignupDate:date LowerBoundary:time UpperBoundary:time",
    KGM_VIEWS, KGM + ", result AS (SELECT * FROM ucur)",
)
def growth_users(t):
    return growth.growth_users(t.user_current(), internal=rules.INTERNAL)


@register(
    "m03_activation", f"{USER} ActivatedWithin30days:int FirstDateOfEvent:time",
    KGM_VIEWS, KGM + ", result AS (SELECT * FROM facts)",
)
def activation(t):
    users, events = growth_parts(t, list(taxonomy.ACTIVATION))
    return growth.activation(users, events, t.company_current())


@register(
    "m04_retention_second_month", f"{USER} DaysActiveInSecondMonth:int Retained:int",
    KGM_VIEWS,
    KGM + ", result AS (SELECT f.*, Retained FROM facts f JOIN kgm USING (UserId))",
)
def retention(t):
    users, events = growth_parts(t)
    return growth.retention_second_month(users, events, t.company_current(), types=GROWTH)


@register(
    "m05_invites_sent", f"OpenIdSender SignupDateSender:date CompanyType {INVITE}",
    KGM_VIEWS, KGM + ", result AS (SELECT *, UserId AS OpenIdSender, SignupDate AS SignupDateSender FROM facts)",
)
def invites_sent(t):
    users, events = growth_parts(t, list(taxonomy.INVITES))
    return growth.invites_sent(users, events, t.company_current(), internal=rules.INTERNAL)


@register("m06_key_growth_metrics", KGM_SCHEMA, KGM_VIEWS, KGM + ", result AS (SELECT * FROM kgm)")
def key_growth_metrics(t):
    return kgm(t)


# --- onboarding ---------------------------------------------------------------------

def _onboarding_spans(name: str, days: str) -> str:
    """Active days of a category on the signup day and in the three spans after it."""
    at = lambda a, b: days_in(days, f"SignupDate + {a}", f"SignupDate + {b}")
    return f"""{at(0, 0)} AS ActiveFirstDay{name}, {at(1, 8)} AS ActiveDays1To8DaysAfterSignup{name},
    {at(1, 14)} AS ActiveDays1To15DaysAfterSignup{name}, {at(1, 30)} AS ActiveDays1To30DaysAfterSignup{name}"""


_KINDS = [*taxonomy.ONBOARDING.items(), ("any", ACTIVITY)]
_ONBOARDING_SCHEMA = (
    "UserId CompanyId DisplayName CompanyType Country Source MonthYear:date SignupDate:date "
    "FirstActivationDate:time Activated:int "
    + " ".join(f"{n.format(c)}:int" for c in taxonomy.ONBOARDING for n in onboarding.SPANS)
    + " "
    + " ".join(f"{n}:int" for n in onboarding.TOTAL_SPANS)
    + " Retained:int"
)


@register(
    "m17_onboarding", _ONBOARDING_SCHEMA, KGM_VIEWS,
    f"""
company_kind AS (
  SELECT CompanyId, DisplayName, ['Partner', 'Customer', 'University', 'Other'][
    min(list_position([IsPartner, IsCustomer, IsUniversity, 1], 1))] AS kind
  FROM company_current GROUP BY CompanyId, DisplayName),
history AS (
  SELECT OpenId, max(ExtraInfo1) FILTER (EventType = 'MemberSignupCompleted') AS reason,
    min("Timestamp") FILTER (list_contains({list(taxonomy.ACTIVATION)}, EventType)) AS FirstActivationDate,
    {", ".join(f'list(DISTINCT "Timestamp"::DATE) FILTER (list_contains({list(types)}, EventType)) AS days_{name}'
               for name, types in _KINDS)}
  FROM platform_event WHERE OpenId <> '' GROUP BY OpenId),
result AS (
  SELECT u.OpenId AS UserId, u.CompanyId, DisplayName, coalesce(kind, 'Other') AS CompanyType, Country,
    if(coalesce(list_contains({list(taxonomy.INVITE_REASONS)}, reason), false), 'Invites', 'Marketing Inbound') AS Source,
    date_trunc('month', OldSignupDate)::DATE AS MonthYear, OldSignupDate::DATE AS SignupDate, FirstActivationDate,
    coalesce(FirstActivationDate::DATE - OldSignupDate::DATE <= 30, false)::INTEGER AS Activated,
    {", ".join(_onboarding_spans(name, f'days_{name}') for name in taxonomy.ONBOARDING)},
    {days_in('days_any', 'SignupDate + 1', 'SignupDate + 30')} AS ActiveDays1To30DaysAfterSignup,
    {days_in('days_any', 'SignupDate + 30', 'SignupDate + 60')} AS ActiveDays30To60DaysAfterSignup,
    (ActiveDays30To60DaysAfterSignup > 0)::INTEGER AS Retained
  FROM (SELECT * REPLACE (OldSignupDate::DATE AS SignupDate) FROM user_current) u
    LEFT JOIN company_kind c ON c.CompanyId = u.CompanyId LEFT JOIN history h ON h.OpenId = u.OpenId
  WHERE u.OpenId <> '' AND u.{EXTERNAL})
""",
)
def onboard(t):
    users = onboarding.onboarding_users(
        t.user_current(),
        t.platform_event(),
        t.company_current(),
        internal=rules.INTERNAL,
    )
    return onboarding.onboarding(
        users, t.platform_event(), activity=ACTIVITY
    )


# --- existing users ------------------------------------------------------------------

EXISTING_VIEWS = "platform_event user_current users_month"
# Windows over all months of a user give what came before and what came first.
EXISTING = f"""
active_on AS (
  SELECT OpenId, list(DISTINCT "Timestamp"::DATE) AS days FROM platform_event
  WHERE list_contains({ACTIVITY}, EventType) GROUP BY OpenId),
timeline AS (
  SELECT m.*, OldSignupDate AS SignupDate,
    max(LastActiveDateInMonth) FILTER (LastActiveDateInMonth >= OldSignupDate) OVER (
      PARTITION BY UserId, OldSignupDate ORDER BY MonthYear
      RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS LastActiveDateBeforeMonth
  FROM users_month m LEFT JOIN user_current ON OpenId = UserId WHERE UserId <> ''),
monthly AS (
  SELECT DISTINCT UserId, MonthYear, LastActiveDateInMonth, ActiveDaysInMonth, SignupDate, LastActiveDateBeforeMonth,
    LastActiveDateInMonth + 30 AS LowerBoundary, LastActiveDateInMonth + 60 AS UpperBoundary,
    coalesce(LastActiveDateInMonth - SignupDate::DATE > 30, false)::INTEGER AS ExistingUser,
    max((UserTypeMonth = 'Developer')::INTEGER) OVER (
      PARTITION BY UserId, MonthYear, FirstActiveDateInMonth, LastActiveDateInMonth, ActiveDaysInMonth) AS IsDeveloper,
    {days_in('days', 'LowerBoundary', 'UpperBoundary')} AS DaysActiveInSecondMonth
  FROM timeline LEFT JOIN active_on ON OpenId = UserId WHERE ActiveMonth = 'Active' AND {EXTERNAL}),
existing AS (
  SELECT DISTINCT * EXCLUDE (SignupDate, LowerBoundary, UpperBoundary),
    coalesce(date_diff('month', LastActiveDateBeforeMonth, MonthYear) > 1, false)::INTEGER AS IsChurner,
    date_diff('month', MonthYear, {AS_OF}) > 2 AS mature,
    (mature AND DaysActiveInSecondMonth > 0)::INTEGER AS ExistingUsersActiveInSecondMonth,
    (mature AND DaysActiveInSecondMonth = 0)::INTEGER AS ExistingUsersNotActiveInSecondMonth
  FROM monthly WHERE ExistingUser = 1 AND MonthYear < date_trunc('month', {AS_OF})),
types AS (
  SELECT *, if(rank() OVER (PARTITION BY UserId ORDER BY MonthYear) = 1, 'New Existing User',
    if(IsChurner = 1, 'Resurrected Existing User', 'Existing User')) AS ExistingUserType
  FROM existing)
"""


def certificate(earned: str) -> str:
    """The highest certificate whose date passes a test, given as ``earned`` of ``d``."""
    names = ["ExpertCertified", "AdvancedCertified", "RapidCertified"]
    dates = ", ".join(f"{name}Date" for name in names)
    tests = f"list_transform([{dates}], lambda d: coalesce({earned}, false))"
    return f"coalesce({names}[list_position({tests}, true)], 'NotCertified') AS Certification"


_MONTH = "UserId MonthYear:date LastActiveDateInMonth:date ActiveDaysInMonth:int"


def monthly(t):
    return existing.monthly_existing_users(
        t.users_month(), t.user_current(), t.platform_event(),
        types=ACTIVITY, internal=rules.INTERNAL,
    )


def existing_rows(t):
    return existing.existing_user_churn_flags(monthly(t), as_of=rules.AS_OF)


@register(
    "m18_monthly_existing_users",
    f"{_MONTH} LowerBoundary:date UpperBoundary:date SignupDate:time ExistingUser:int IsDeveloper:int DaysActiveInSecondMonth:int",
    EXISTING_VIEWS, EXISTING + ", result AS (SELECT * FROM monthly)",
)
def monthly_existing_users(t):
    return monthly(t)


@register(
    "m19_existing_user_churn",
    f"{_MONTH} LastActiveDateBeforeMonth:date IsChurner:int ExistingUser:int IsDeveloper:int DaysActiveInSecondMonth:int "
    "ExistingUsersActiveInSecondMonth:int ExistingUsersNotActiveInSecondMonth:int",
    EXISTING_VIEWS, EXISTING + ", result AS (SELECT * FROM existing)",
)
def existing_user_churn(t):
    return existing_rows(t)


@register(
    "m20_existing_user_types",
    f"{_MONTH} LastActiveDateBeforeMonth:date IsDeveloper:int ExistingUsersActiveInSecondMonth:int "
    "DaysActiveInSecondMonth:int ExistingUserType Certification",
    EXISTING_VIEWS,
    EXISTING + f", result AS (SELECT t.*, {certificate('d < MonthYear')} FROM types t LEFT JOIN user_current ON OpenId = UserId)",
)
def existing_user_types(t):
    return existing.existing_users_certified(existing_rows(t), t.user_current())


@register(
    "m21_existing_users_by_year", "UserId IsDeveloper:int Year:int Certification",
    EXISTING_VIEWS,
    EXISTING + f""", result AS (
  SELECT y.*, {certificate('year(d) = "Year"')}
  FROM (SELECT UserId, year(MonthYear) AS "Year", max(IsDeveloper) AS IsDeveloper FROM existing GROUP BY 1, 2) y
    LEFT JOIN user_current ON OpenId = UserId)""",
)
def existing_users_by_year(t):
    return existing.existing_users_by_year(existing_rows(t), t.user_current())


@register(
    "m22_resurrection",
    "MonthYear:date UserId IsCurrentChurner:int IsNonCurrentChurner:int IsExistingUser:int Resurrected:int ExistingChurners:int "
    "CurrentChurnersResurrected:int NonCurrentChurnersResurrected:int",
    "user_current users_month",
    f"""
people AS (
  SELECT DISTINCT UserId, OldSignupDate AS signed FROM users_month JOIN user_current ON OpenId = UserId
  WHERE UserId <> '' AND OldSignupDate IS NOT NULL AND users_month.{EXTERNAL}),
last_seen AS (
  SELECT UserId, signed, MonthYear, max(max(LastActiveDateInMonth) FILTER (LastActiveDateInMonth >= signed)) OVER (
    PARTITION BY UserId, signed ORDER BY MonthYear) AS seen
  FROM users_month JOIN people USING (UserId) GROUP BY UserId, signed, MonthYear),
ahead AS (
  SELECT p.UserId, c.MonthYear, p.signed FROM people p JOIN (SELECT DISTINCT MonthYear FROM users_month) c
    ON c.MonthYear >= p.signed AND c.MonthYear < date_trunc('month', {AS_OF})),
churned AS (
  SELECT a.UserId, a.MonthYear, date_diff('month', seen, a.MonthYear) AS gap,
    ((a.UserId, a.MonthYear) IN (SELECT (UserId, MonthYear) FROM users_month WHERE ActiveMonth = 'Active'))::INTEGER AS back
  FROM ahead a ASOF JOIN last_seen l ON l.UserId = a.UserId AND l.signed = a.signed AND l.MonthYear < a.MonthYear
  WHERE seen - a.signed::DATE > 30),
result AS (
  SELECT UserId, MonthYear, (gap <= 12)::INTEGER AS IsCurrentChurner, (gap > 12)::INTEGER AS IsNonCurrentChurner,
    1 AS IsExistingUser, back AS Resurrected, IsCurrentChurner AS ExistingChurners,
    back * IsCurrentChurner AS CurrentChurnersResurrected, back * IsNonCurrentChurner AS NonCurrentChurnersResurrected
  FROM churned WHERE gap >= 2)
""",
)
def resurrection(t):
    return existing.resurrection(
        t.users_month(), t.user_current(), as_of=rules.AS_OF, internal=rules.INTERNAL
    )


@register(
    "m23_invite_conversion",
    "OpenIdSender EmailAddressRetriever MonthYear:date InviteType InviteToNonMember:int InviteToNonMemberLeadingToSignup:int",
    "platform_event user_current",
    f"""
result AS (
  SELECT e.OpenId AS OpenIdSender, e.ExtraInfo1 AS EmailAddressRetriever, date_trunc('month', e."Timestamp") AS MonthYear,
    e.EventType AS InviteType,
    CASE WHEN e."Timestamp" < u.OldSignupDate OR u.OldSignupDate IS NULL THEN 1 ELSE 0 END AS InviteToNonMember,
    CASE WHEN e."Timestamp" < u.OldSignupDate AND date_diff('day', e."Timestamp", u.OldSignupDate) <= 30 THEN 1 ELSE 0 END
      AS InviteToNonMemberLeadingToSignup
  FROM platform_event e LEFT JOIN user_current u ON e.ExtraInfo1 = u.email
  WHERE e.EventType IN {in_list(taxonomy.INVITES)} AND e.{EXTERNAL} AND e.OpenId <> ''
    AND date_trunc('month', e."Timestamp") < date_trunc('month', {AS_OF}))
""",
)
def invite_conversion(t):
    return growth.invite_conversion(
        t.user_current(), t.platform_event(),
        internal=rules.INTERNAL, as_of=rules.AS_OF,
    )


