"""Joins that keep their cost even when keys are skewed or missing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.keys import join_keys, sieved
from factloom.sources.workspace import stage
from factloom.spec import Lookup, quoted, renamed

_RIGHT = "_r_"


def _keys_named(on: Mapping[str, str]) -> dict[str, str]:
    """Right-hand key columns and the working names under which they join."""
    if len(set(on.values())) < len(on):
        raise ValueError("a right-hand column can serve one key only")
    return {right: _RIGHT + left for left, right in on.items()}


def lookup_join(left: DataFrame, lookup: Lookup, spread_by: str | None = None) -> DataFrame:
    """Left-outer enrichment: add the lookup's columns, keep every left row.

    Hot keys on the left are split at run time by adaptive skew handling, which may
    divide the preserved side. Missing keys need more care, since a chain of lookups
    produces many of them: NULL never matches, yet all NULL keys hash alike and would
    meet in one task. ``spread_by`` names a left column of (nearly) distinct values; where
    any key is missing it fills one more key, which is empty on the right and where no
    key is missing. So those rows spread evenly and stay unmatched, and the keys proper
    are compared as they are.
    """
    keys = [f"{quoted(r)} AS {quoted(_RIGHT + l)}" for l, r in lookup.on.items()]
    right = lookup.frame.selectExpr(*keys, *renamed(lookup.columns))
    if not lookup.copies:
        right = right.distinct()
    tests = [f"{quoted(l)} = {quoted(_RIGHT + l)}" for l in lookup.on]
    if spread_by is not None:
        missing = " OR ".join(f"{quoted(l)} IS NULL" for l in lookup.on)
        # Empty text that Spark cannot tell to be constant, or it would not join by it.
        empty = f"substring(CAST({quoted(_RIGHT + next(iter(lookup.on)))} AS string), 1, 0)"
        right = right.withColumn("_r_spread", F.expr(empty))
        tests.append(f"CASE WHEN {missing} THEN concat('-', CAST({quoted(spread_by)} AS string)) ELSE '' END = _r_spread")
    joined = left.join(right, F.expr(" AND ".join(tests)), "left")
    return joined.drop("_r_spread", *[_RIGHT + l for l in lookup.on])


def enrich(left: DataFrame, lookups: Sequence[Lookup], spread_by: str | None = None) -> DataFrame:
    """Apply several lookups in order; a later one may use columns of an earlier one."""
    return reduce(lambda df, step: lookup_join(df, step, spread_by), lookups, left)


def enrich_late(left: DataFrame, lookups: Sequence[Lookup], row_key: Sequence[str]) -> DataFrame:
    """The rows that :func:`enrich` gives for lookups that do not depend on each other; wide rows are moved once.

    Only ``row_key`` and the lookups' keys travel to the lookups, as distinct tuples that are written once: few of them
    are broadcast, so that a small delta never shuffles a whole lookup table. What they find comes back under a hash
    of ``row_key``. Rows and finds meet there: all these joins share one partitioning, and so does a
    ``distinct`` that keeps the column ``row_hash``. What decides is the equality of the tuples, not the hash.

    Rows equal in ``row_key`` meet in one task, so it should be nearly unique; its NULLs are values like others. A hot
    lookup key meets only the narrow tuples, in inner joins, which adaptive execution may divide on either side, and
    a NULL lookup key does not travel there. Of a lookup table only rows travel that a sieve of the tuples' keys lets pass. The result has the left columns, the lookups' columns and ``row_hash``.
    """
    kept = list(dict.fromkeys([*row_key, *[l for step in lookups for l in step.on]]))
    hashed = f"xxhash64({', '.join(quoted(c) for c in row_key)})"
    tuples = stage(left.select(*[quoted(c) for c in kept]).distinct(), "lookup-keys")
    rows = left.selectExpr("*", f"{hashed} AS row_hash")
    same = " AND ".join(["row_hash = _f_hash", *[_same_value(quoted(c), quoted("_f_" + c)) for c in kept]])
    for step in lookups:
        right = step.frame.selectExpr(*renamed(_keys_named(step.on)), *renamed(step.columns))
        right = sieved(right, tuples, {_RIGHT + l: l for l in step.on})
        found = tuples.join(right, F.expr(" AND ".join(f"{quoted(l)} = {quoted(_RIGHT + l)}" for l in step.on)), "inner")
        found = found.selectExpr(
            f"{hashed} AS _f_hash", *renamed({c: "_f_" + c for c in kept}), *[quoted(c) for c in step.columns.values()]
        )
        if not step.copies:
            found = found.distinct()
        rows = rows.join(found, F.expr(same), "left").drop("_f_hash", *["_f_" + c for c in kept])
    return rows


def _same_value(a: str, b: str) -> str:
    """Null-safe equality that Spark does not take for a join key, as the rows must not be dealt by it."""
    return f"({a} >= {b} AND {a} <= {b} OR {a} IS NULL AND {b} IS NULL)"


def parent_child_join(parent: DataFrame, child: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Parent rows with all their child rows; parents without children stay, once.

    A plain left-outer join cannot be split when one parent owns a large share of the
    children, because only the preserved side may be divided. So the matches are an
    inner join (either side can be split) and the childless parents an anti join
    against the distinct child keys, which are reduced before they are shuffled.
    The child's key columns are not repeated in the result.
    """
    keys = _keys_named(on)
    payload = [c for c in child.columns if c not in keys]
    clash = sorted({c.lower() for c in payload} & {c.lower() for c in parent.columns})
    if clash:
        raise ValueError(f"columns occur on both sides: {clash}")
    named_child = child.selectExpr(*renamed(keys), *[quoted(c) for c in payload])
    same_key = F.expr(" AND ".join(f"{quoted(p)} = {quoted(_RIGHT + p)}" for p in on))
    matched = parent.join(named_child, same_key, "inner").drop(*keys.values())
    child_keys = join_keys(named_child, list(keys.values()))
    types = {f.name: f.dataType.simpleString() for f in child.schema.fields}
    childless = parent.join(child_keys, same_key, "left_anti").selectExpr(
        "*", *[f"CAST(NULL AS {types[c]}) AS {quoted(c)}" for c in payload]
    )
    return matched.unionByName(childless)


def control_table_join(df: DataFrame, control: DataFrame, on: Sequence[str]) -> DataFrame:
    """Restrict rows to the keys of a control table and add its columns (inner join)."""
    return df.join(control, list(on), "inner")
