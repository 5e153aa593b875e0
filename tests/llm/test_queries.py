"""Queries that SQL can express, against their SQL at the smallest scale."""

import duckdb
import pytest

from cohortia.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import samples


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{samples.SF}/{table}.parquet'")
    answer = connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in answer.description]
    got = QUERIES[name](spark, samples.SF)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(answer.fetchall())
