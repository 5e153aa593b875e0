import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """``"2018-01-05 10:00"`` or ``"2018-01-05"`` as a datetime."""
    return None if text is None else dt.datetime.fromisoformat(text)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


class Make:
    """Small fixture tables with the production schemas."""

    def __init__(self, spark):
        self.spark = spark

    def table(self, schema, rows):
        return self.spark.createDataFrame(rows, schema)

    def events(self, rows):
        """Rows of (user, type, time, info1, info2, info3[, company[, id]])."""
        full = []
        for i, row in enumerate(rows):
            user, kind, time, *rest = row
            info = [*rest[:3], *[None] * (3 - len(rest[:3]))]
            company = rest[3] if len(rest) > 3 else "C1"
            event_id = rest[4] if len(rest) > 4 else i
            full.append((event_id, user, kind, at(time), company, *info))
        return self.table(
            "ChangedId bigint, OpenId string, EventType string, Timestamp timestamp_ntz, "
            "CompanyId string, ExtraInfo1 string, ExtraInfo2 string, ExtraInfo3 string",
            full,
        )

    def users(self, rows):
        """Rows of (user, company, signup[, email])."""
        full = []
        for row in rows:
            user, company, signup, *rest = row
            email = rest[0] if rest else f"{user}@x"
            full.append((user, company, email, at(signup), at(signup), "NL", "b", None, None, None))
        return self.table(
            "OpenId string, CompanyId string, email string, SignupDate timestamp_ntz, "
            "OldSignupDate timestamp_ntz, Country string, Brand string, RapidCertifiedDate date, "
            "AdvancedCertifiedDate date, ExpertCertifiedDate date",
            full,
        )

    def company(self, rows=(("C1", "One", "t", 0, 1, 1),)):
        return self.table(
            "CompanyId string, DisplayName string, CompanyType string, IsPartner int, "
            "IsCustomer int, IsUniversity int",
            list(rows),
        )

    def months(self, rows):
        """Rows of (user, month, last day[, type[, active[, company]]])."""
        full = []
        for row in rows:
            user, month, last, *rest = row
            kind, active, company = [*rest, *["Business", "Active", "C1"][len(rest):]]
            full.append((user, day(month), day(last), day(last), 1, kind, active, company))
        return self.table(
            "UserId string, MonthYear date, FirstActiveDateInMonth date, LastActiveDateInMonth date, "
            "ActiveDaysInMonth int, UserTypeMonth string, ActiveMonth string, CompanyId string",
            full,
        )


@pytest.fixture(scope="session")
def make(spark):
    return Make(spark)


def rows(frame, *columns):
    """Rows as a sorted list of tuples (NULL first)."""
    picked = frame.select(*columns) if columns else frame
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in picked.collect()), key=key)


def by_key(frame, key, *columns):
    """``{key: value}`` or ``{key: (values…)}`` for a frame unique on ``key``."""
    found = {}
    for r in frame.select(key, *columns).collect():
        assert r[0] not in found, f"duplicate {key} {r[0]}"
        found[r[0]] = r[1] if len(columns) == 1 else tuple(r[1:])
    return found
