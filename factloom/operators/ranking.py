"""Consecutive numbering that never sorts a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.workspace import stage
from factloom.spec import quoted


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` within ``group`` by ``order``, for groups of any size.

    Rows are range-partitioned by (group, order), so a group that holds a third of the
    table spans many partitions. Each row is numbered within its partition and moved
    up by the number of rows that its group has in the partitions before. ``order``
    must end in a unique column. The partition of every row is fixed by writing the
    rows once, so a recomputed task cannot see different range bounds.
    """
    keys, sorting = [quoted(c) for c in group], [quoted(c) for c in order]
    ranged = stage(
        df.repartitionByRange(*keys, *sorting).withColumn("_range", F.spark_partition_id()), "numbering"
    )
    sizes = ranged.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_size"))
    window = f"PARTITION BY {', '.join(keys)} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    shifts = sizes.selectExpr(
        "_range AS _shift_range",
        *[f"{quoted(c)} AS {quoted('_shift_' + c)}" for c in group],
        f"coalesce(sum(_size) OVER ({window}), 0) AS _shift",
    )
    local = f"row_number() OVER (PARTITION BY _range, {', '.join(keys)} ORDER BY {', '.join(sorting)})"
    same = " AND ".join(["_range = _shift_range", *[f"{quoted(c)} <=> {quoted('_shift_' + c)}" for c in group]])
    numbered = ranged.selectExpr("*", f"{local} AS _local").join(shifts, F.expr(same))
    return numbered.selectExpr(
        *[quoted(c) for c in df.columns if c != name], f"CAST(_local + _shift AS bigint) AS {quoted(name)}"
    )
