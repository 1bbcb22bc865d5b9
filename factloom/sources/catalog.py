"""Catalogue entries: external tables, reader views, inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.spec import quoted


def table_location(spark: SparkSession, name: str) -> str:
    """Folder that a table reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[-1].data_type


def _same_folder(spark: SparkSession, one: str, other: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(one).toUri().getPath() == path(other).toUri().getPath()


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> bool:
    """Create an external table over a folder, or let an existing one follow to it. True if it was created.

    A table that reads another folder, or whose columns differ from the folder's, is defined anew;
    as it is external, its old files stay.
    """
    exists = spark.catalog.tableExists(name)
    if exists:
        moved = not _same_folder(spark, table_location(spark, name), path)
        if moved or set(spark.table(name).columns) != set(spark.read.parquet(path).columns):
            spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return not exists


def reader_view(spark: SparkSession, view: str, table: str, columns: Sequence[str]) -> DataFrame:
    """Drop and recreate a view that shows an explicit list of columns."""
    names = ", ".join(quoted(c, "t") for c in columns)
    spark.sql(f"DROP VIEW IF EXISTS {view}")
    spark.sql(f"CREATE VIEW {view} AS SELECT {names} FROM {table} t")
    return spark.table(view)


def reader_views(spark: SparkSession, views: Mapping[str, tuple[str, Sequence[str]]]) -> dict[str, DataFrame]:
    """Drop and recreate several views, given as view to (table, columns). None is touched if any names a column its table lacks."""
    lacking = {
        view: gone for view, (table, columns) in views.items() if (gone := sorted(set(columns) - set(spark.table(table).columns)))
    }
    if lacking:
        raise ValueError(f"views that name missing columns: {lacking}")
    return {view: reader_view(spark, view, table, columns) for view, (table, columns) in views.items()}


def catalog_inventory(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """Which tables each schema holds: (schema_name, sorted tables)."""
    rows = [
        (schema, table.name)
        for schema in schemas
        if spark.catalog.databaseExists(schema)
        for table in spark.catalog.listTables(schema)
    ]
    listed = spark.createDataFrame(rows, "schema_name string, table_name string")
    return grouped_sets(listed, ["schema_name"], "table_name", "tables")


def grouped_sets(df: DataFrame, group: Sequence[str], column: str, name: str) -> DataFrame:
    """Distinct values per group as a sorted array, for columns with few distinct values.

    The array of a group is held by one task: for columns of many values, take distinct rows instead.
    """
    keys = [F.col(quoted(c)) for c in group]
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(quoted(column))).alias(name))


def missing_tables(inventory: DataFrame, expected: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Expected tables that the inventory lacks, per schema."""
    found = {row.schema_name: set(row.tables) for row in inventory.collect()}
    gaps = {s: sorted(set(tables) - found.get(s, set())) for s, tables in expected.items()}
    return {s: tables for s, tables in gaps.items() if tables}
