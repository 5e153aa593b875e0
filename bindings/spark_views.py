"""The analytics tables as Spark DataFrames over the benchmark Parquet files."""

from __future__ import annotations

from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import rules


def _pick(values: list[str], index: str) -> str:
    return "element_at(array(" + ", ".join(f"'{v}'" for v in values) + f"), int({index}) + 1)"


def _days(n: str) -> str:
    return f"make_dt_interval(int({n}))"


def _hours(n: str) -> str:
    return f"make_dt_interval(0, int({n}))"


def _later(column: str, hours: str, minutes: str = "0") -> str:
    return f"{column} + INTERVAL '20' YEAR + make_dt_interval(0, int({hours}), int({minutes}))"


def open_id(u: str) -> str:
    return f"CASE WHEN {u} % 97 = 13 THEN '' WHEN {u} % 97 <> 14 THEN string({u}) END"


def company_id(u: str) -> str:
    return (
        f"CASE WHEN {u} % 53 = 52 THEN NULL"
        f" WHEN {u} % 23 = 22 THEN if({u} % 2 = 0, 'Acme HQ', 'ACME labs')"
        f" WHEN {u} % 11 = 10 THEN concat('X', {u}) ELSE concat('S', {u} div 20) END"
    )


def signup_at(u: str) -> str:
    return (
        f"if({u} % 61 <> 60, TIMESTAMP_NTZ'2016-01-01' + {_days(f'{u} * 37 % 1500')}"
        f" + {_hours(f'{u} % 24')}, NULL)"
    )


def _once(method):
    """Build each table once per ``Tables`` object."""

    @wraps(method)
    def remembered(self, *args):
        key = (method.__name__, *args)
        if key not in self._built:
            self._built[key] = method(self, *args)
        return self._built[key]

    return remembered


class Tables:
    """Analytics tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._built = {}

    @_once
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # --- event log ---------------------------------------------------------

    @_once
    def platform_event(self) -> DataFrame:
        """The event log: every event of every source table."""
        sources = (self._relative, self._signup, self._activity, self._shop)
        return reduce(DataFrame.unionByName, [source() for source in sources])

    @_once
    def _relative(self) -> DataFrame:
        days = "u * 37 % 1500 - 5 + 2 * datediff(ts, DATE'2024-01-01') - 2922"
        step, ended = "EventType = 'WmIntroTutorialStep'", "EventType = 'GuidanceTourEnded'"
        return (
            self.raw("events")
            .selectExpr(
                "event_id", "ts", "user_id AS u", "int(get_json_object(props, '$.k')) AS k",
                _pick(rules.RELATIVE_TYPES, "event_id % 24") + " AS EventType",
            )
            .selectExpr(
                "(event_id div 4096 * 4096 + 4095 - event_id % 4096) * 4 AS ChangedId",
                f"{open_id('u')} AS OpenId",
                "EventType",
                f"ts + {_days(days)} AS Timestamp",
                f"{company_id('u')} AS CompanyId",
                f"""CASE WHEN {step} THEN {_pick(rules.STEPS, 'k % 6')}
                    WHEN EventType LIKE 'Guidance%' THEN concat('flow', k % 3)
                    WHEN EventType LIKE 'Challenge%' THEN concat('challenge', k % 2)
                    WHEN EventType LIKE '%InviteSent' THEN
                      if(k % 10 = 9, concat('nobody', k, '@example.com'), concat('user', u + k * 3, '@example.com'))
                    END AS ExtraInfo1""",
                f"""CASE WHEN {step} THEN {_pick(rules.TUTORIALS, '(u + k % 2) % 7')}
                    WHEN {ended} THEN {_pick(rules.OUTCOMES, 'k % 4')} END AS ExtraInfo2""",
                f"""CASE WHEN EventType = 'GuidanceTourStarted' THEN concat('r', k % 5)
                    WHEN {ended} THEN if(k % 17 = 0, 'n/a', string(k % 13)) END AS ExtraInfo3""",
            )
        )

    @_once
    def _signup(self) -> DataFrame:
        turn = lambda r: f"if(turn % 3 = {r}, 'true', 'false')"
        visit = """CASE WHEN n % 41 = 40 THEN '' WHEN n % 43 = 42 THEN NULL
            WHEN n % 37 = 36 THEN concat('{"GroupName":"', grp, '"}')
            ELSE concat('{"GroupName":"', grp, '","Experiment":{"ID":"exp', u div 2 % 4, '"}}') END"""
        started = """CASE WHEN n % 19 = 18 THEN '' WHEN n % 17 = 16 THEN '{"HasStudentDomain":"false"}'
            ELSE concat('{"CookieID":"', cookie, '","HasStudentDomain":"', if(u % 5 = 0, 'true', 'false'),
              '","StudentType":"t', n % 3, '","Brand":"b', n % 4, '","Source":', if(n % 7 = 6, '{"a":1}', '"web"'),
              ',"IpAddress":"10.0.0.1","AreaOfFocus":"area', n % 5, '","JobRole":"role', n % 2, '"}') END"""
        step = f"""CASE WHEN n % 29 = 28 THEN 'not json'
            WHEN turn % 4 = 0 THEN concat('{{"PageStatus":"', if(n % 3 = 0, 'done', 'shown'),
              '","Questions":[{{"QuestionName":"{rules.QUESTION}","Answers":[',
              '{{"AnswerContent":"No-code","SortOrder":1,"Selected":"', {turn(0)},
              '"}},{{"AnswerContent":"Low-code","SortOrder":2,"Selected":"', {turn(1)},
              '"}},{{"AnswerContent":"Project management","SortOrder":3,"Selected":"',
              if(n % 2 = 0, 'true', 'false'), '"}}]}}]}}')
            WHEN turn % 4 = 1 THEN concat('{{"PageStatus":"shown","Questions":{{"QuestionName":"Role?","Answers":',
              '{{"AnswerContent":"Dev","SortOrder":1,"Selected":true}}}}}}')
            WHEN turn % 4 = 2 THEN concat('{{"PageStatus":"done","Questions":[{{"QuestionName":"AgreeToEmail?",',
              '"Answers":[{{"AnswerContent":"Agree","SortOrder":1,"Selected":"', {turn(0)},
              '"}},{{"AnswerContent":"Disagree","SortOrder":2,"Selected":"', {turn(1)}, '"}}]}}]}}')
            ELSE '{{"PageStatus":"shown","Questions":[]}}' END"""
        return (
            self.raw("orders")
            .selectExpr(
                "o_orderkey AS n", "o_custkey AS u", "o_orderdate", "o_orderkey div 6 AS turn",
                "o_orderkey % 6 AS kind", "concat('c', o_custkey div 2) AS cookie",
                """CASE WHEN o_orderkey % 47 = 46 THEN '' WHEN o_orderkey % 23 = 22 THEN 'C'
                   WHEN (o_custkey div 2 + if(o_orderkey % 10 = 0, 1, 0)) % 2 = 0 THEN 'A' ELSE 'B' END AS grp""",
                """CASE WHEN o_orderkey % 31 = 30 THEN NULL WHEN o_orderkey % 13 = 12 THEN concat('h', o_custkey, 'b')
                   ELSE concat('h', o_custkey) END AS h""",
            )
            .selectExpr(
                "n * 4 + 1 AS ChangedId",
                f"{open_id('u')} AS OpenId",
                _pick(rules.SIGNUP_TYPES, "kind") + " AS EventType",
                _later("o_orderdate", "n % 24") + " AS Timestamp",
                f"{company_id('u')} AS CompanyId",
                f"CASE kind WHEN 0 THEN cookie WHEN 2 THEN {_pick(rules.REASONS, 'n % 4')} ELSE h END AS ExtraInfo1",
                f"""CASE WHEN kind = 1 THEN concat('user', u, if(u % 23 = 22, '@ACME.example', '@example.com'))
                    WHEN kind >= 4 THEN {_pick(rules.PAGES, 'turn % 4')} END AS ExtraInfo2""",
                f"CASE WHEN kind = 0 THEN {visit} WHEN kind = 1 THEN {started} WHEN kind = 2 THEN h"
                f" WHEN kind >= 4 THEN {step} END AS ExtraInfo3",
            )
        )

    @_once
    def _activity(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "(l_orderkey * 8 + l_linenumber) * 4 + 2 AS ChangedId",
            f"{open_id('l_partkey')} AS OpenId",
            _pick(rules.ACTIVITY_TYPES, "(l_orderkey + l_linenumber) % 15") + " AS EventType",
            _later("l_shipdate", "l_linenumber * 3", "l_orderkey % 60") + " AS Timestamp",
            f"{company_id('l_partkey')} AS CompanyId",
            "concat('P', l_orderkey) AS ExtraInfo1",
            "string(NULL) AS ExtraInfo2",
            "string(NULL) AS ExtraInfo3",
        )

    @_once
    def _shop(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey * 4 + 3 AS ChangedId",
            f"{open_id('o_custkey')} AS OpenId",
            _pick(rules.SHOP_TYPES, "o_orderkey % 6") + " AS EventType",
            _later("o_orderdate", "o_orderkey % 24", "o_orderkey % 60") + " AS Timestamp",
            f"{company_id('o_custkey')} AS CompanyId",
            "if(o_orderkey % 2 <> 0, concat('OL', o_orderkey), NULL) AS ExtraInfo1",
            "if(o_orderkey % 2 = 0, o_orderpriority, concat('stock', o_orderkey % 7)) AS ExtraInfo2",
            "if(o_orderkey % 2 = 0, concat('P', o_orderkey), string(o_orderkey % 9 + 1)) AS ExtraInfo3",
        )

    # --- dimensions ----------------------------------------------------------

    @_once
    def user_current(self) -> DataFrame:
        return (
            self.raw("customer")
            .selectExpr(
                "c_custkey AS u", "c_nationkey", "c_mktsegment",
                f"{signup_at('c_custkey')} AS signed",
            )
            .selectExpr(
                "if(u = 13, '', string(u)) AS OpenId",
                f"{company_id('u')} AS CompanyId",
                "concat('user', if(u % 29 = 28, u - 1, u), '@example.com') AS email",
                f"signed + {_days('u % 3')} AS SignupDate",
                "signed AS OldSignupDate",
                "concat('NATION_', c_nationkey) AS Country",
                "c_mktsegment AS Brand",
                "if(u % 2 = 0, date_add(date(signed), 100), NULL) AS RapidCertifiedDate",
                "if(u % 4 = 0, date_add(date(signed), 300), NULL) AS AdvancedCertifiedDate",
                "if(u % 8 = 0, date_add(date(signed), 500), NULL) AS ExpertCertifiedDate",
            )
        )

    @_once
    def company_current(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "concat('S', s_suppkey) AS CompanyId",
            "s_name AS DisplayName",
            "concat('type', s_suppkey % 4) AS CompanyType",
            "if(s_suppkey % 5 = 0, 1, 0) AS IsPartner",
            "if(s_suppkey % 3 = 0, 1, 0) AS IsCustomer",
            "if(s_suppkey % 2 = 0, 1, 0) AS IsUniversity",
        )

    @_once
    def users_month(self) -> DataFrame:
        idle = "(u + month(MonthYear)) % 7 = 0"
        return (
            self.raw("lineitem")
            .selectExpr(
                "l_partkey AS u", "date(l_shipdate + INTERVAL '20' YEAR) AS day",
                "if(l_linenumber % 3 = 0, 'Developer', 'Business') AS UserTypeMonth",
            )
            .selectExpr("*", "trunc(day, 'MM') AS MonthYear")
            .groupBy("u", "MonthYear", "UserTypeMonth")
            .agg(
                F.min("day").alias("first"),
                F.max("day").alias("last"),
                F.countDistinct("day").alias("days"),
            )
            .selectExpr(
                f"coalesce({open_id('u')}, '') AS UserId",
                "MonthYear",
                "first AS FirstActiveDateInMonth",
                f"if({idle}, date_add(last, 35), last) AS LastActiveDateInMonth",
                "int(days) AS ActiveDaysInMonth",
                "UserTypeMonth",
                f"if({idle}, 'Inactive', 'Active') AS ActiveMonth",
                f"{company_id('u')} AS CompanyId",
            )
        )

    @_once
    def projects(self) -> DataFrame:
        return (
            self.raw("orders")
            .selectExpr("*", _later("o_orderdate", "o_orderkey % 24") + " AS created")
            .where("o_orderkey % 3 <> 0")
            .selectExpr(
                "concat('P', o_orderkey) AS S_UUID",
                "concat('project ', o_orderkey) AS ProjectName",
                "created AS CreatedDate",
                f"if(o_orderkey % 11 = 10, NULL, {company_id('o_custkey')}) AS CreatorCompanyPlatformName",
                "o_orderkey % 8 = 0 AS ProjectIsDeleted",
                "o_orderstatus AS EnvironmentType",
                "o_orderpriority AS AppType",
                "int(o_orderkey % 6) AS ProjectMemberCount",
                "created AS FirstSandboxLogin",
                f"if(o_orderkey % 4 <> 0, created + {_hours('o_custkey % 100')}, NULL) AS LastSandboxLogin",
                "concat('status', o_orderkey % 3) AS AppStatus",
            )
        )

    @_once
    def user_lead(self) -> DataFrame:
        return self.raw("customer").where("c_custkey % 3 <> 1").selectExpr(
            "if(c_custkey % 21 <> 20, string(c_custkey), NULL) AS OpenId",
            "concat('L', c_custkey - c_custkey % 2) AS LeadId",
        )

    @_once
    def lead_current(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "concat('L', p_partkey) AS _Id",
            "CASE WHEN p_partkey % 9 = 8 THEN 'Acme Corp' WHEN p_partkey % 31 <> 30 THEN p_name END AS Company",
            "if(p_size % 3 <> 0, 'Marketing - Inbound', 'Sales - Outbound') AS LeadSource",
            "CASE p_partkey % 14 WHEN 0 THEN 'Bad data' WHEN 2 THEN 'Education' WHEN 4 THEN 'Partner'"
            " WHEN 6 THEN NULL ELSE 'Open' END AS Status",
            "if(p_partkey % 10 <> 4, date_add(DATE'2018-01-01', int(p_partkey % 700)), NULL) AS MQL_Date_Enter__c",
            "p_partkey % 3 = 0 AS MQL__c",
            "p_partkey % 4 = 0 AS Converted_to_SO__c",
            "CASE p_partkey % 20 WHEN 0 THEN 'Unknown region' WHEN 2 THEN 'channel east' ELSE p_brand END"
            " AS Sales_Unit__c",
            "if(p_partkey % 12 = 8, 'A. Stone', 'B. Field') AS Lead_Owner_String__c",
        )

    @_once
    def experiment_current(self) -> DataFrame:
        return self.raw("region").selectExpr(
            _pick(["exp0", "exp1", "exp2", "journey_4", "journey_3"], "r_regionkey") + " AS UniqueId",
            """CASE r_regionkey WHEN 0 THEN TIMESTAMP_NTZ'2018-01-01' WHEN 1 THEN TIMESTAMP_NTZ'2018-06-01'
               WHEN 2 THEN TIMESTAMP_NTZ'2018-06-01' WHEN 4 THEN TIMESTAMP_NTZ'2020-05-01' END AS StartDate""",
            """CASE r_regionkey WHEN 1 THEN TIMESTAMP_NTZ'2019-11-20'
               WHEN 2 THEN TIMESTAMP_NTZ'2019-10-01' END AS EndDate""",
        )

    @_once
    def gamification(self) -> DataFrame:
        return self.raw("customer").where("c_custkey % 3 <> 1").selectExpr(
            "string(c_custkey) AS OpenId",
            "concat('cert', c_custkey % 4) AS HighestCert",
            "int(c_custkey % 10) AS Level",
            "int(floor(c_acctbal)) AS Total_points",
        )
