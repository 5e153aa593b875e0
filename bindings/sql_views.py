"""The same analytics tables as SQL common table expressions."""

from __future__ import annotations

from bindings import rules


def pick(values: list[str], index: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[({index}) + 1]"


def open_id(u: str) -> str:
    return f"CASE WHEN {u} % 97 = 13 THEN '' WHEN {u} % 97 = 14 THEN NULL ELSE CAST({u} AS VARCHAR) END"


def company_id(u: str) -> str:
    return (
        f"CASE WHEN {u} % 53 = 52 THEN NULL"
        f" WHEN {u} % 23 = 22 THEN CASE WHEN {u} % 2 = 0 THEN 'Acme HQ' ELSE 'ACME labs' END"
        f" WHEN {u} % 11 = 10 THEN 'X' || {u} ELSE 'S' || ({u} // 20) END"
    )


def signup_at(u: str) -> str:
    return (
        f"CASE WHEN {u} % 61 <> 60 THEN TIMESTAMP '2016-01-01' + to_days(CAST({u} * 37 % 1500 AS INTEGER))"
        f" + to_hours({u} % 24) END"
    )


def _relative() -> str:
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    return f"""
    SELECT ((event_id // 4096) * 4096 + 4095 - event_id % 4096) * 4 AS ChangedId,
      {open_id('u')} AS OpenId, EventType,
      ts + to_days(CAST(u * 37 % 1500 - 5 + 2 * date_diff('day', TIMESTAMP '2024-01-01', ts) - 2922 AS INTEGER)) AS "Timestamp",
      {company_id('u')} AS CompanyId,
      CASE WHEN EventType = 'WmIntroTutorialStep' THEN {pick(rules.STEPS, 'k % 6')}
           WHEN EventType LIKE 'Guidance%' THEN 'flow' || (k % 3)
           WHEN EventType LIKE 'Challenge%' THEN 'challenge' || (k % 2)
           WHEN EventType LIKE '%InviteSent' THEN
             CASE WHEN k % 10 = 9 THEN 'nobody' || k || '@example.com' ELSE 'user' || (u + k * 3) || '@example.com' END
      END AS ExtraInfo1,
      CASE WHEN EventType = 'WmIntroTutorialStep' THEN {pick(rules.TUTORIALS, '(u + k % 2) % 7')}
           WHEN EventType = 'GuidanceTourEnded' THEN {pick(rules.OUTCOMES, 'k % 4')} END AS ExtraInfo2,
      CASE WHEN EventType = 'GuidanceTourStarted' THEN 'r' || (k % 5)
           WHEN EventType = 'GuidanceTourEnded' THEN
             CASE WHEN k % 17 = 0 THEN 'n/a' ELSE CAST(k % 13 AS VARCHAR) END END AS ExtraInfo3
    FROM (SELECT event_id, ts, user_id AS u, {k} AS k,
                 {pick(rules.RELATIVE_TYPES, 'event_id % 24')} AS EventType FROM events)"""


def _signup() -> str:
    cookie = "'c' || (u // 2)"
    group = (
        "CASE WHEN n % 47 = 46 THEN '' WHEN n % 23 = 22 THEN 'C'"
        " WHEN (u // 2 + CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END) % 2 = 0 THEN 'A' ELSE 'B' END"
    )
    if_turn = lambda r: f"CASE WHEN turn % 3 = {r} THEN 'true' ELSE 'false' END"
    visit = f"""CASE WHEN n % 41 = 40 THEN '' WHEN n % 43 = 42 THEN NULL
        WHEN n % 37 = 36 THEN '{{"GroupName":"' || ({group}) || '"}}'
        ELSE '{{"GroupName":"' || ({group}) || '","Experiment":{{"ID":"exp' || (u // 2 % 4) || '"}}}}' END"""
    started = f"""CASE WHEN n % 19 = 18 THEN '' WHEN n % 17 = 16 THEN '{{"HasStudentDomain":"false"}}'
        ELSE '{{"CookieID":"' || {cookie} || '","HasStudentDomain":"' || CASE WHEN u % 5 = 0 THEN 'true' ELSE 'false' END
          || '","StudentType":"t' || (n % 3) || '","Brand":"b' || (n % 4) || '","Source":'
          || CASE WHEN n % 7 = 6 THEN '{{"a":1}}' ELSE '"web"' END
          || ',"IpAddress":"10.0.0.1","AreaOfFocus":"area' || (n % 5) || '","JobRole":"role' || (n % 2) || '"}}' END"""
    step = f"""CASE WHEN n % 29 = 28 THEN 'not json'
        WHEN turn % 4 = 0 THEN '{{"PageStatus":"' || CASE WHEN n % 3 = 0 THEN 'done' ELSE 'shown' END
          || '","Questions":[{{"QuestionName":"{rules.QUESTION}","Answers":['
          || '{{"AnswerContent":"No-code","SortOrder":1,"Selected":"' || {if_turn(0)} || '"}},'
          || '{{"AnswerContent":"Low-code","SortOrder":2,"Selected":"' || {if_turn(1)} || '"}},'
          || '{{"AnswerContent":"Project management","SortOrder":3,"Selected":"'
          || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || '"}}]}}]}}'
        WHEN turn % 4 = 1 THEN '{{"PageStatus":"shown","Questions":{{"QuestionName":"Role?","Answers":'
          || '{{"AnswerContent":"Dev","SortOrder":1,"Selected":true}}}}}}'
        WHEN turn % 4 = 2 THEN '{{"PageStatus":"done","Questions":[{{"QuestionName":"AgreeToEmail?","Answers":['
          || '{{"AnswerContent":"Agree","SortOrder":1,"Selected":"' || {if_turn(0)} || '"}},'
          || '{{"AnswerContent":"Disagree","SortOrder":2,"Selected":"' || {if_turn(1)} || '"}}]}}]}}'
        ELSE '{{"PageStatus":"shown","Questions":[]}}' END"""
    return f"""
    SELECT n * 4 + 1 AS ChangedId, {open_id('u')} AS OpenId, {pick(rules.SIGNUP_TYPES, 'n % 6')} AS EventType,
      o_orderdate + INTERVAL 20 YEAR + to_hours(n % 24) AS "Timestamp", {company_id('u')} AS CompanyId,
      CASE WHEN n % 6 = 0 THEN {cookie} WHEN n % 6 = 2 THEN {pick(rules.REASONS, 'n % 4')} ELSE h END AS ExtraInfo1,
      CASE WHEN n % 6 = 1 THEN 'user' || u || CASE WHEN u % 23 = 22 THEN '@ACME.example' ELSE '@example.com' END
           WHEN n % 6 >= 4 THEN {pick(rules.PAGES, 'turn % 4')} END AS ExtraInfo2,
      CASE WHEN n % 6 = 0 THEN {visit} WHEN n % 6 = 1 THEN {started} WHEN n % 6 = 2 THEN h
           WHEN n % 6 >= 4 THEN {step} END AS ExtraInfo3
    FROM (SELECT o_orderkey AS n, o_custkey AS u, o_orderdate, o_orderkey // 6 AS turn,
            CASE WHEN o_orderkey % 31 = 30 THEN NULL WHEN o_orderkey % 13 = 12 THEN 'h' || o_custkey || 'b'
                 ELSE 'h' || o_custkey END AS h FROM orders)"""


def _activity() -> str:
    return f"""
    SELECT (n * 8 + line) * 4 + 2 AS ChangedId, {open_id('u')} AS OpenId,
      {pick(rules.ACTIVITY_TYPES, '(n + line) % 15')} AS EventType,
      l_shipdate + INTERVAL 20 YEAR + to_hours(line * 3) + to_minutes(n % 60) AS "Timestamp",
      {company_id('u')} AS CompanyId, 'P' || n AS ExtraInfo1,
      CAST(NULL AS VARCHAR) AS ExtraInfo2, CAST(NULL AS VARCHAR) AS ExtraInfo3
    FROM (SELECT l_orderkey AS n, l_partkey AS u, l_linenumber AS line, l_shipdate FROM lineitem)"""


def _shop() -> str:
    return f"""
    SELECT n * 4 + 3 AS ChangedId, {open_id('u')} AS OpenId, {pick(rules.SHOP_TYPES, 'n % 6')} AS EventType,
      o_orderdate + INTERVAL 20 YEAR + to_hours(n % 24) + to_minutes(n % 60) AS "Timestamp",
      {company_id('u')} AS CompanyId,
      CASE WHEN n % 2 <> 0 THEN 'OL' || n END AS ExtraInfo1,
      CASE WHEN n % 2 = 0 THEN o_orderpriority ELSE 'stock' || (n % 7) END AS ExtraInfo2,
      CASE WHEN n % 2 = 0 THEN 'P' || n ELSE CAST(n % 9 + 1 AS VARCHAR) END AS ExtraInfo3
    FROM (SELECT o_orderkey AS n, o_custkey AS u, o_orderdate, o_orderpriority FROM orders)"""


VIEWS: dict[str, str] = {
    "platform_event": " UNION ALL ".join([_relative(), _signup(), _activity(), _shop()]),
    "user_current": f"""
    SELECT CASE WHEN u = 13 THEN '' ELSE CAST(u AS VARCHAR) END AS OpenId, {company_id('u')} AS CompanyId,
      'user' || CASE WHEN u % 29 = 28 THEN u - 1 ELSE u END || '@example.com' AS email,
      signed + to_days(CAST(u % 3 AS INTEGER)) AS SignupDate, signed AS OldSignupDate,
      'NATION_' || c_nationkey AS Country, c_mktsegment AS Brand,
      CASE WHEN u % 2 = 0 THEN CAST(signed AS DATE) + 100 END AS RapidCertifiedDate,
      CASE WHEN u % 4 = 0 THEN CAST(signed AS DATE) + 300 END AS AdvancedCertifiedDate,
      CASE WHEN u % 8 = 0 THEN CAST(signed AS DATE) + 500 END AS ExpertCertifiedDate
    FROM (SELECT c_custkey AS u, {signup_at('c_custkey')} AS signed, c_nationkey, c_mktsegment FROM customer)""",
    "company_current": """
    SELECT 'S' || s_suppkey AS CompanyId, s_name AS DisplayName, 'type' || (s_suppkey % 4) AS CompanyType,
      CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS IsPartner,
      CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS IsCustomer,
      CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS IsUniversity
    FROM supplier""",
    "users_month": f"""
    SELECT coalesce({open_id('u')}, '') AS UserId, MonthYear, FirstDay AS FirstActiveDateInMonth,
      CASE WHEN (u + month(MonthYear)) % 7 = 0 THEN LastDay + 35 ELSE LastDay END AS LastActiveDateInMonth,
      ActiveDaysInMonth, UserTypeMonth,
      CASE WHEN (u + month(MonthYear)) % 7 = 0 THEN 'Inactive' ELSE 'Active' END AS ActiveMonth,
      {company_id('u')} AS CompanyId
    FROM (SELECT u, CAST(date_trunc('month', day) AS DATE) AS MonthYear,
            CASE WHEN line % 3 = 0 THEN 'Developer' ELSE 'Business' END AS UserTypeMonth,
            min(day) AS FirstDay, max(day) AS LastDay, CAST(count(DISTINCT day) AS INTEGER) AS ActiveDaysInMonth
          FROM (SELECT l_partkey AS u, l_linenumber AS line, CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS day FROM lineitem)
          GROUP BY ALL)""",
    "projects": f"""
    SELECT 'P' || n AS S_UUID, 'project ' || n AS ProjectName, created AS CreatedDate,
      CASE WHEN n % 11 = 10 THEN NULL ELSE {company_id('u')} END AS CreatorCompanyPlatformName,
      n % 8 = 0 AS ProjectIsDeleted, o_orderstatus AS EnvironmentType, o_orderpriority AS AppType,
      CAST(n % 6 AS INTEGER) AS ProjectMemberCount, created AS FirstSandboxLogin,
      CASE WHEN n % 4 <> 0 THEN created + to_hours(u % 100) END AS LastSandboxLogin, 'status' || (n % 3) AS AppStatus
    FROM (SELECT o_orderkey AS n, o_custkey AS u, o_orderdate + INTERVAL 20 YEAR + to_hours(o_orderkey % 24) AS created,
            o_orderstatus, o_orderpriority FROM orders) WHERE n % 3 <> 0""",
    "user_lead": """
    SELECT CASE WHEN c_custkey % 21 <> 20 THEN CAST(c_custkey AS VARCHAR) END AS OpenId,
      'L' || (c_custkey - c_custkey % 2) AS LeadId
    FROM customer WHERE c_custkey % 3 <> 1""",
    "lead_current": """
    SELECT 'L' || p AS _Id,
      CASE WHEN p % 9 = 8 THEN 'Acme Corp' WHEN p % 31 = 30 THEN NULL ELSE p_name END AS Company,
      CASE WHEN p_size % 3 <> 0 THEN 'Marketing - Inbound' ELSE 'Sales - Outbound' END AS LeadSource,
      CASE p % 14 WHEN 0 THEN 'Bad data' WHEN 2 THEN 'Education' WHEN 4 THEN 'Partner' WHEN 6 THEN NULL ELSE 'Open' END AS Status,
      CASE WHEN p % 10 <> 4 THEN DATE '2018-01-01' + CAST(p % 700 AS INTEGER) END AS MQL_Date_Enter__c,
      p % 3 = 0 AS MQL__c, p % 4 = 0 AS Converted_to_SO__c,
      CASE WHEN p % 20 = 0 THEN 'Unknown region' WHEN p % 20 = 2 THEN 'channel east' ELSE p_brand END AS Sales_Unit__c,
      CASE WHEN p % 12 = 8 THEN 'A. Stone' ELSE 'B. Field' END AS Lead_Owner_String__c
    FROM (SELECT p_partkey AS p, p_name, p_size, p_brand FROM part)""",
    "experiment_current": """
    SELECT (['exp0', 'exp1', 'exp2', 'journey_4', 'journey_3'])[r_regionkey + 1] AS UniqueId,
      CASE r_regionkey WHEN 0 THEN TIMESTAMP '2018-01-01' WHEN 1 THEN TIMESTAMP '2018-06-01'
        WHEN 2 THEN TIMESTAMP '2018-06-01' WHEN 4 THEN TIMESTAMP '2020-05-01' END AS StartDate,
      CASE r_regionkey WHEN 1 THEN TIMESTAMP '2019-11-20' WHEN 2 THEN TIMESTAMP '2019-10-01' END AS EndDate
    FROM region""",
    "gamification": """
    SELECT CAST(c_custkey AS VARCHAR) AS OpenId, 'cert' || (c_custkey % 4) AS HighestCert,
      CAST(c_custkey % 10 AS INTEGER) AS Level, CAST(floor(c_acctbal) AS INTEGER) AS Total_points
    FROM customer WHERE c_custkey % 3 <> 1""",
}


def with_views(names: str, steps: str) -> str:
    """``WITH`` clause of the named tables followed by ``steps`` (further CTEs
    and the final SELECT)."""
    ctes = [f"{name} AS ({VIEWS[name]})" for name in names.split()]
    return "WITH " + ",\n".join(ctes) + ",\n" + steps.strip()
