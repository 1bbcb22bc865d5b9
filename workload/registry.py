"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.sources.workspace import table_path
from workload.bindings import AS_OF, FEEDS, WATERMARK

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}

WM_SQL = f"TIMESTAMP '{WATERMARK}'"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its checking SQL if there is one."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = function
        if sql is not None:
            CHECK_SQL[name] = sql
        return function

    return add


def feed_sql(name: str) -> str:
    """A feed as a parenthesised SELECT over its given table."""
    source, expressions = FEEDS[name]
    columns = ", ".join(f"{e} AS {c}" for c, e in expressions.items())
    return f"(SELECT {columns} FROM {source})"


def unified_sql(name: str, condition: str = "true") -> str:
    """A feed with one pair of change columns."""
    return (
        "(SELECT * EXCLUDE (LAST_DTM, LAST_ACTION_CD, AEDATTM, OPFLAG), coalesce(AEDATTM, LAST_DTM) AS AEDATTM, "
        "CASE WHEN coalesce(OPFLAG, LAST_ACTION_CD) = 'C' THEN 'I' ELSE coalesce(OPFLAG, LAST_ACTION_CD) END AS OPFLAG "
        f"FROM {feed_sql(name)} WHERE {condition})"
    )


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder for a query that writes."""
    return table_path(spark, f"query/{name}-{uuid.uuid4().hex}")
