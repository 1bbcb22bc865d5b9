"""Scanning source tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from factloom.operators.project import prefix_columns


def scan(spark: SparkSession, name_or_path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A catalogue table by name, or a Parquet folder by path."""
    is_path = "/" in name_or_path and not name_or_path.startswith("`")
    df = spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)
    return df if columns is None else df.select(*columns)


def scan_with_prefix(
    spark: SparkSession,
    name_or_path: str,
    prefix: str,
    columns: Iterable[str] = ("LAST_DTM", "LAST_ACTION_CD"),
) -> DataFrame:
    """Scan a table and prefix its change-capture columns."""
    return prefix_columns(scan(spark, name_or_path), prefix, columns)
