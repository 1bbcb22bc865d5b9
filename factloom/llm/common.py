"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.sources.workspace import stage
from factloom.spec import quoted

#: A word is a run of anything but ASCII white space. ``bytes.split()`` cuts UTF-8 text at the same places.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: dict[str, str]
) -> DataFrame:
    """Adds, for each ``{total: value}``, the sum of ``value`` over the rows of ``group`` that come earlier by ``order``.

    No task sorts a whole group: rows are range-partitioned by (group, order), summed within their
    partition, and moved up by what the group has in the partitions before. The partition of every row
    is fixed by writing the rows once, so a recomputed task cannot see different range bounds. Rows that
    tie in ``order`` are adjacent, in any order.
    """
    keys, sorting = [quoted(c) for c in group], [quoted(c) for c in order]
    ranged = stage(
        df.repartitionByRange(*keys, *sorting).withColumn("_range", F.spark_partition_id()), "running"
    )
    parts = ranged.groupBy("_range", *keys).agg(*[F.sum(quoted(v)).alias(f"_sum_{t}") for t, v in values.items()])
    over = f"PARTITION BY {', '.join(keys) or 'true'} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    shifts = parts.selectExpr(
        "_range AS _shift_range",
        *[f"{quoted(c)} AS {quoted('_shift_' + c)}" for c in group],
        *[f"coalesce(sum(_sum_{t}) OVER ({over}), 0) AS _shift_{t}" for t in values],
    )
    local = (
        f"OVER (PARTITION BY {', '.join(['_range', *keys])} ORDER BY {', '.join(sorting)} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    same = " AND ".join(["_range = _shift_range", *[f"{quoted(c)} <=> {quoted('_shift_' + c)}" for c in group]])
    summed = ranged.selectExpr("*", *[f"coalesce(sum({quoted(v)}) {local}, 0) AS _local_{t}" for t, v in values.items()])
    return summed.join(shifts, F.expr(same)).selectExpr(
        *[quoted(c) for c in df.columns], *[f"_local_{t} + _shift_{t} AS {quoted(t)}" for t in values]
    )


def has_repeats(docs: DataFrame) -> bool:
    """Whether two rows agree in ``doc_id`` and text."""
    keys = docs.groupBy("doc_id", F.xxhash64("text")).agg(F.count("*").alias("n"))
    return not keys.where("n > 1").isEmpty()
