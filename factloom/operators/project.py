"""Projection operators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import path_segment, source_id
from factloom.spec import quoted, renamed


def rename_projection(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep exactly the mapped columns under their new names, in mapping order."""
    repeated = sorted(name for name, n in Counter(columns.values()).items() if n > 1)
    if repeated:
        raise ValueError(f"several columns are renamed to {repeated}")
    return df.selectExpr(*renamed(columns))


def prefix_columns(df: DataFrame, prefix: str, columns: Iterable[str]) -> DataFrame:
    """Prefix the given columns so that later joins do not collide on them."""
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in columns})


def without(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All columns except the given ones; names that do not occur are ignored."""
    return df.drop(*columns)


def with_path_segment(
    df: DataFrame, name: str = "yrmono", position: int = 9, path: str = "input_file_name()"
) -> DataFrame:
    """Add a segment of the input file's path (or of another path expression) as a column."""
    return df.withColumn(name, F.expr(path_segment(path, position)))


def with_source_id(df: DataFrame, system: str, client: str = "Client", name: str = "Source_ID") -> DataFrame:
    """Add the identity of the source the row came from."""
    return df.withColumn(name, F.expr(source_id(system, quoted(client))))
