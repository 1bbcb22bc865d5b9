"""Operators on change feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import codes
from factloom.functions.change import effective_action, unified_action
from factloom.functions.text import literal
from factloom.operators.filters import watermark_text
from factloom.operators.keys import join_keys
from factloom.spec import ChangeColumns, quoted


def unify_cdc_columns(df: DataFrame, names: ChangeColumns = ChangeColumns()) -> DataFrame:
    """Fold the two pairs of change-capture columns into one pair and drop the other."""
    values = {
        names.time: f"coalesce({quoted(names.time)}, {quoted(names.other_time)})",
        names.action: unified_action(quoted(names.action), quoted(names.other_action)),
    }
    folded = {names.other_time, names.other_action}
    return df.selectExpr(
        *[f"{values.get(c, quoted(c))} AS {quoted(c)}" for c in df.columns if c not in folded]
    )


def with_effective_action(
    df: DataFrame, watermark, loaded: str = "ingested_at", action: str = "OPFLAG"
) -> DataFrame:
    """Keep the action of rows loaded since the watermark, set the rest to update."""
    since = watermark_text(df, loaded, watermark)
    return df.withColumn(action, F.expr(effective_action(quoted(loaded), since, quoted(action))))


def append_tombstones(rows: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Append key-only rows; every column they lack is NULL."""
    return rows.unionByName(tombstones, allowMissingColumns=True)


def tombstone_update(
    target: DataFrame,
    deleted: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    stamp: Mapping[str, str] | None = None,
    action: str = "OPFLAG",
) -> DataFrame:
    """Blank the payload of target rows whose key was deleted.

    ``keep`` (besides the keys) survives, ``stamp`` columns take the given SQL
    expressions, the action becomes D.
    """
    written = {action: literal(codes.DELETED), **(stamp or {})}
    unchanged = {*keys, *keep}

    def value(field) -> str:
        if field.name in unchanged:
            return quoted(field.name)
        blank = f"CAST({written.get(field.name, 'NULL')} AS {field.dataType.simpleString()})"
        return f"CASE WHEN _gone THEN {blank} ELSE {quoted(field.name)} END AS {quoted(field.name)}"

    marked = join_keys(deleted, keys).withColumn("_gone", F.lit(True))
    return target.join(marked, list(keys), "left").selectExpr(*[value(f) for f in target.schema.fields])
