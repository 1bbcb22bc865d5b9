"""Column metadata: flattening, select expressions and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.spec import quoted

# Attributes that become tags, in order.
TAG_ATTRIBUTES = (
    "ColumnDataAggregationRisk",
    "ColumnDescription",
    "ColumnCommerciallySensitiveInformation",
    "ConfidentialTechnicalInformation",
    "ColumnDataConfidentiality",
    "ColumnPersonalData",
    "ColumnSoxScope",
)

def map_keys_found(df: DataFrame, column: str) -> list[str]:
    """Distinct keys of an array-of-maps column, sorted: one for each column they will become."""
    keys = df.select(F.explode(column).alias("_m")).select(F.explode(F.map_keys("_m")).alias("key")).distinct()
    return sorted(row.key for row in keys.collect())


def map_flatten(df: DataFrame, column: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per map of an array-of-maps column, one column per key.

    Other columns are kept. Give ``keys`` if they are known: finding them reads the data.
    Keys too many for columns stay rows in :func:`map_pairs`.
    """
    keys = map_keys_found(df, column) if keys is None else keys
    others = [c for c in df.columns if c != column]
    maps = df.select(*others, F.explode(column).alias("_m"))
    return maps.select(*others, *[F.col("_m").getItem(k).alias(k) for k in keys])


def map_pairs(df: DataFrame, column: str) -> DataFrame:
    """One row per entry of an array-of-maps column: ``key`` and ``value`` beside the other columns."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias("_m")).select(*others, F.explode("_m"))


def _after_equals(value: Column) -> Column:
    """Text between the first and second ``=``, without ``}]``; NULL if there is no ``=``."""
    return F.regexp_replace(F.get(F.split(value, "="), F.lit(1)), "\\}\\]", "")


def column_schema(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Display name, target name and skip flag of each column.

    Target name falls back to the display name, the skip flag to ``false``.
    """
    display = F.col("ColumnDisplayName")
    target, skip = F.lit(None).cast("string"), F.lit(None).cast("string")
    if "ColumnTargetName" in df.columns:
        target = _after_equals(F.col("ColumnTargetName"))
    if "SkipColumn" in df.columns:
        skip = F.regexp_replace(_after_equals(F.col("SkipColumn")), " ", "_")
    return df.select(
        *[F.col(quoted(c)) for c in keep],
        display,
        F.coalesce(target, display).alias("ColumnTargetName"),
        F.coalesce(skip, F.lit("false")).alias("SkipColumn"),
    )


def select_exprs(schema: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``display as target`` for each column that is not skipped, one row each."""
    expr = F.concat("ColumnDisplayName", F.lit(" as "), "ColumnTargetName")
    kept = schema.filter(F.col("SkipColumn") == "false")
    return kept.select(*[F.col(quoted(c)) for c in keep], expr.alias("select_expr"))


def select_expr_list(schema: DataFrame) -> list[str]:
    """The select expressions of one table as a sorted list for ``selectExpr``."""
    rows = select_exprs(schema).filter("select_expr IS NOT NULL").collect()
    return sorted(row.select_expr for row in rows)


def attribute_tag(attribute: str) -> Column:
    """``name.attribute:Value`` for one attribute; NULL when it is not set."""
    value = F.initcap(_after_equals(F.col(quoted(attribute))))
    return F.regexp_replace(F.concat(F.col("ColumnDisplayName"), F.lit(f".{attribute}:"), value), ",", "")


def metadata_tags(df: DataFrame, attributes: Sequence[str] = TAG_ATTRIBUTES) -> DataFrame:
    """Tags of each column joined by commas; columns without tags are left out."""
    present = [a for a in attributes if a in df.columns]
    tags = F.concat_ws(",", *[attribute_tag(a) for a in present])
    return df.select("ColumnDisplayName", tags.alias("tags")).filter(F.length("tags") != 0).distinct()


def tag_pairs(tags: DataFrame) -> DataFrame:
    """Tags as (name, value) rows."""
    pair = F.split("tag", ":")
    return (
        tags.select(F.explode(F.split("tags", ",")).alias("tag"))
        .select(F.get(pair, F.lit(0)).alias("name"), F.get(pair, F.lit(1)).alias("value"))
    )
