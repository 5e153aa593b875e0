"""Registered queries: a Spark callable, its result schema, and equivalent SQL.

The schema fixes names and types on both sides: integers become BIGINT and
doubles are rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.spark_views import Tables
from bindings.sql_views import with_views

_SPARK = {"text": "string", "int": "bigint", "double": "double", "date": "date",
          "time": "timestamp_ntz", "bool": "boolean"}
_SQL = {"text": "VARCHAR", "int": "BIGINT", "double": "DOUBLE", "date": "DATE",
        "time": "TIMESTAMP", "bool": "BOOLEAN"}


def _fields(schema: str) -> list[tuple[str, str]]:
    """``"A B:int C:date"`` -> names with types; text when no type is given."""
    return [(n, t or "text") for n, _, t in (part.partition(":") for part in schema.split())]


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    schema: str
    views: str
    steps: str | None

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = self.build(Tables(spark, sf_dir))
        return rows.select(
            *[
                (F.round(F.col(n).cast("double"), 6) if t == "double" else F.col(n).cast(_SPARK[t]))
                .alias(n)
                for n, t in _fields(self.schema)
            ]
        )

    def sql(self) -> str | None:
        """SQL whose last step is a CTE named ``result``."""
        if self.steps is None:
            return None
        columns = ", ".join(
            f'round(CAST("{n}" AS DOUBLE), 6) AS "{n}"'
            if t == "double"
            else f'CAST("{n}" AS {_SQL[t]}) AS "{n}"'
            for n, t in _fields(self.schema)
        )
        body = self.steps.strip()
        final = f"\nSELECT {columns} FROM result"
        return (with_views(self.views, body) if self.views else "WITH " + body) + final


REGISTRY: dict[str, Query] = {}


def register(name: str, schema: str, views: str, steps: str | None):
    """Decorator: add ``build(tables)`` under ``name``."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(build, schema, views, steps)
        return build

    return add


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"
