"""Every registered query against its SQL at the smallest scale.

Broadcasts are off, so the plans are those of tables that are never small; none
of them may pair up rows without an equality key, or leave the JVM.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from bindings.registry import REGISTRY

SF = "/root/testdata/sf0.001"
_SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


FORBIDDEN = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "MapInPandas", "CollectLimit", "collect_list", "collect_set",
]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF}/{name}'")
    return connection


def normal(rows):
    return sorted(tuple("~" if v is None else repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(no_broadcast, sql, name):
    got = entry_points.queries()[name](no_broadcast, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    answer = sql.execute(entry_points.oracle_sql()[name])
    columns = [(c[0], str(c[1])) for c in answer.description]
    assert [(f.name, _SAME_TYPE[f.dataType.simpleString()]) for f in got.schema] == columns
    assert normal(map(tuple, got.collect())) == normal(answer.fetchall())


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_points.queries()) & set(entry_points.oracle_sql())


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
