"""Lookup files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_lookup(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV file with a header line, read with a declared schema."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def explode_value(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per element of an array of structs, its fields as columns.

    Other columns are kept in front; a row with an empty or NULL array yields nothing.
    """
    others = [c for c in df.columns if c != column]
    exploded = df.select(*others, F.explode(column).alias("_element"))
    return exploded.select(*others, "_element.*")


def read_value_json(
    spark: SparkSession, path: str, element: str | T.StructType, multi_line: bool = False
) -> DataFrame:
    """JSON objects with a ``value`` array, one row per element.

    One object per line splits over tasks; ``multi_line`` reads each file as one object.
    """
    kind = element if isinstance(element, str) else element.simpleString()
    if not kind.lower().startswith("struct<"):
        kind = f"struct<{kind}>"
    raw = spark.read.schema(f"value array<{kind}>").option("multiLine", multi_line).json(path)
    return explode_value(raw)


def read_column_map(spark: SparkSession, path: str) -> dict[str, str]:
    """Source column to published name, from a CSV file with the columns input and output, sorted by name.

    A name given twice is an error. The file has a row for each column of one table.
    """
    rows = read_csv_lookup(spark, path, "input string, output string").orderBy("input", "output").collect()
    names = {r.input: r.output for r in rows}
    if len(names) < len(rows):
        raise ValueError(f"{path} names a column twice")
    return names


def read_view_columns(spark: SparkSession, path: str) -> dict[str, tuple[str, list[str]]]:
    """View to its table and columns in order, from a CSV file with the columns view, table, position, column.

    The file has a row for each column of each view. A view over two tables, or a position or column given twice, is an error.
    """
    rows = read_csv_lookup(spark, path, "view string, table string, position int, column string").collect()
    views: dict[str, tuple[str, list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r.view, r.position)):
        table, columns = views.setdefault(r.view, (r.table, []))
        if table != r.table or r.column in columns:
            raise ValueError(f"{path}: view {r.view} has two tables or names {r.column} twice")
        columns.append(r.column)
    if len({(r.view, r.position) for r in rows}) < len(rows):
        raise ValueError(f"{path} gives a position of a view twice")
    return views
