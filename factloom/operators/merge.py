"""Merge, delete and uniqueness as plain DataFrame transformations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.keys import join_keys, may_hit, rows_hit, sieved
from factloom.sources.workspace import stage, stage_all
from factloom.spec import MergeSpec, quoted


class DuplicateKeyError(ValueError):
    """The merge source holds several rows for one key."""


def assert_unique_keys(df: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> None:
    """Fail if a key occurs twice. Reads the key columns only and returns at most three keys.

    Rows with a NULL in an ordinary key match nothing, so they are left out.
    """
    strict = [k for k in keys if k not in null_safe]
    selected = df.select(*[quoted(k) for k in keys])
    if strict:
        selected = selected.dropna(subset=strict)
    counted = selected.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = counted.filter("_copies > 1").limit(3).collect()
    if repeated:
        raise DuplicateKeyError(f"several source rows share a key, for example {[r.asDict() for r in repeated]}")


class Upsert:
    """The two halves of a merge: target rows as they are after it, and source rows that are new.

    A NULL in the source overwrites. ``deleted`` names keys to remove; delete wins over
    upsert, and a NULL in a deleted key matches nothing. Rows with a NULL in an ordinary
    key match nothing but would meet in one task, so they go around the joins. Where source and
    deleted keys are ``staged``, so do the rows that a sieve of the keys they would meet holds back;
    the others are then gathered by the columns ``gather``, if there are any, before they are written.
    """

    def __init__(
        self,
        target: DataFrame,
        source: DataFrame,
        spec: MergeSpec,
        deleted: DataFrame | None = None,
        staged: bool = False,
        gather: Sequence[str] = (),
    ) -> None:
        self.spec, self.target, self.gather = spec, target, [quoted(c) for c in gather]
        self.fields = [f for f in target.schema.fields]
        names = {f.name for f in self.fields}
        self.update = names if spec.update is None else set(spec.update)
        self.insert = names if spec.insert is None else set(spec.insert)
        missing = (self.update | self.insert | {*spec.keys, *spec.stamp}) - names
        if missing:
            raise ValueError(f"the target has no columns {sorted(missing)}")
        nulls = [quoted(k) + " IS NULL" for k in spec.keys if k not in spec.null_safe]
        self.unkeyed = " OR ".join(nulls) or "false"
        self.gone = None if deleted is None else join_keys(deleted.dropna(subset=list(spec.keys)), spec.keys)
        self.staged = staged and not spec.null_safe
        keys = [quoted(k) for k in spec.keys]
        self.named = source.select(*keys) if deleted is None else source.select(*keys).unionByName(deleted.select(*keys))
        self.source = source
        if self.staged:
            # The keys of the target that source or deletes name.
            found = sieved(target.select(*keys), self.named, {k: k for k in spec.keys})
            self.held = stage(rows_hit(found, self.named, {k: k for k in spec.keys}), "merge-held")
        if self.gone is not None:
            self.source = delete_by_keys(source, deleted if self.staged else self.gone, spec.keys, self.staged)

    def _written(self, field, columns: set[str], otherwise: str) -> str:
        """What the source writes into a column, or ``otherwise`` if it leaves it alone."""
        kind = field.dataType.simpleString()
        if field.name in self.spec.stamp:
            return f"CAST({self.spec.stamp[field.name]} AS {kind})"
        if field.name in columns and field.name in self.source.columns:
            return f"CAST({quoted(field.name, 's')} AS {kind})"
        return otherwise

    def _same(self, left: str, right: str) -> str:
        return " AND ".join(
            f"{quoted(k, left)} {'<=>' if k in self.spec.null_safe else '='} {quoted(k, right)}" for k in self.spec.keys
        )

    def kept(self, flag: str | None = None) -> DataFrame:
        """Target rows after updates and deletes; ``flag`` names a column that tells whether the source had the row's key.

        The target is the preserved side of a left join with the source and the deleted keys: Spark may split its hot
        keys, and does not shuffle it when the source is small enough to broadcast.
        """
        source = sieved(self.source, self.held, {k: k for k in self.spec.keys}) if self.staged else self.source
        marks = source.withColumn("_in_source", F.lit(True))
        if self.gone is not None:
            marks = marks.withColumn("_gone", F.lit(False)).unionByName(
                self.gone.withColumns({"_in_source": F.lit(False), "_gone": F.lit(True)}), allowMissingColumns=True
            )
        hit, rest = self.target.filter(f"NOT ({self.unkeyed})"), self.target.filter(self.unkeyed)
        marked = may_hit(hit, self.named, {k: k for k in self.spec.keys}, "_may") if self.staged else None
        if marked is not None:
            hit, rest = marked.filter("_may").drop("_may"), rest.unionByName(marked.filter("NOT _may").drop("_may"))
        joined = hit.alias("t").join(marks.filter(f"NOT ({self.unkeyed})").alias("s"), F.expr(self._same("t", "s")), "left")
        if self.gone is not None:
            joined = joined.filter("NOT coalesce(s._gone, false)")
        values = {f.name: quoted(f.name, "t") for f in self.fields}
        columns = [
            f"CASE WHEN s._in_source THEN {self._written(f, self.update, values[f.name])} ELSE {values[f.name]} END "
            f"AS {quoted(f.name)}"
            for f in self.fields
        ]
        rows = joined.selectExpr(*columns)
        if flag is not None:
            rows = joined.selectExpr(*columns, f"coalesce(s._in_source, false) AS {quoted(flag)}")
            rest = rest.withColumn(flag, F.lit(False))
        return (rows if marked is None else self._gathered(rows)).unionByName(rest)

    def _gathered(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *self.gather) if self.gather else rows

    def matched(self) -> DataFrame:
        """The keys of the source that the target has. It reads the target's keys alone, and keeps no more than the source's."""
        held = self.target.filter(f"NOT ({self.unkeyed})").select(*[quoted(k) for k in self.spec.keys]).alias("t")
        asked = self.source.filter(f"NOT ({self.unkeyed})").select(*[quoted(k) for k in self.spec.keys]).alias("s")
        # Reduced as structs: plain keys would pin the join's partitioning, and its hot keys could not be split.
        return join_keys(held.join(asked, F.expr(self._same("t", "s")), "left_semi"), self.spec.keys)

    def inserted(self, matched: DataFrame) -> DataFrame:
        """Source rows whose key is not among ``matched``, as rows of the target."""
        keyed, around = self.source.filter(f"NOT ({self.unkeyed})"), self.source.filter(self.unkeyed)
        marked = may_hit(keyed, self.held, {k: k for k in self.spec.keys}, "_may") if self.staged else None
        if marked is not None:
            keyed, around = marked.filter("_may").drop("_may"), around.unionByName(marked.filter("NOT _may").drop("_may"))
        fresh = keyed.alias("s").join(matched.alias("t"), F.expr(self._same("s", "t")), "left_anti")
        fresh = fresh.unionByName(around).alias("s")
        fresh = fresh.selectExpr(
            *[f"{self._written(f, self.insert, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {quoted(f.name)}" for f in self.fields]
        )
        return self._gathered(fresh)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    check_unique: bool = True,
    deleted: DataFrame | None = None,
) -> DataFrame:
    """Target after an upsert: matched rows are updated, unmatched source rows inserted (see :class:`Upsert`).

    The wide target is joined once. New rows are an anti join of the source against those of its keys that the target
    has, which a semi join over the target's key columns finds; neither shuffles the target when the source is small.
    """
    if check_unique:
        assert_unique_keys(source, spec.keys, spec.null_safe)
    halves = Upsert(target, source, spec, deleted)
    return halves.kept().unionByName(halves.inserted(halves.matched()))


def merge_staged(target: DataFrame, changes: DataFrame, spec: MergeSpec, deleted: DataFrame | None = None) -> DataFrame:
    """Merge changes that are costly to derive: they and the deleted keys are written once, and read by every step."""
    if deleted is None:
        return merge_upsert(target, stage(changes, "merge-source"), spec)
    changes, deleted = stage_all(merge_source=changes, merge_deletes=join_keys(deleted, spec.keys))
    return merge_upsert(target, changes, spec, deleted=deleted)


def delete_by_keys(target: DataFrame, deleted: DataFrame, keys: Sequence[str], staged: bool = False) -> DataFrame:
    """Target without the rows whose key was deleted; a NULL key matches nothing.

    Where the deleted keys are ``staged``, rows that a sieve of them holds back go around the join, which would shuffle them.
    """
    marked = may_hit(target, deleted, {k: k for k in keys}, "_may") if staged else None
    if marked is not None:
        rest = marked.filter("NOT _may").drop("_may")
        return delete_by_keys(marked.filter("_may").drop("_may"), deleted, keys).unionByName(rest)
    return target.join(join_keys(deleted, keys), list(keys), "left_anti")
