"""Data-quality checks, all evaluated in one aggregation over the data."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.spec import quoted

log = logging.getLogger(__name__)

NOT_NULL, IN_SET, HAS_TAG, UNIQUE_COLUMNS = "not_null", "in_set", "has_tag", "unique_columns"


@dataclass(frozen=True)
class Check:
    """One expectation on a column; at least the share ``mostly`` of its values must hold."""

    kind: str
    column: str
    mostly: float = 1.0
    values: tuple = ()
    tag: str = "Owner"

    def evaluated(self) -> Column:
        """Which rows take part. A NULL is neither in nor out of a set."""
        value = F.col(quoted(self.column))
        return value.isNotNull() if self.kind == IN_SET else F.lit(True)

    def holds(self) -> Column:
        """Whether a row meets the expectation; never NULL."""
        value = F.col(quoted(self.column))
        if self.kind == NOT_NULL:
            return value.isNotNull()
        if self.kind == IN_SET:
            return F.coalesce(value.isin(list(self.values)), F.lit(False))
        return tag_present(value, self.tag)


def tag_present(value: Column, tag: str) -> Column:
    """Whether JSON text mentions a tag with a value other than the empty text."""
    key = f'"{tag}":'
    return F.coalesce(value.contains(key) & ~value.contains(f'{key}""'), F.lit(False))


def _options(kind: str, columns: Iterable[tuple[str, dict]], required: Sequence[str] = ()):
    for column, options in columns:
        if not isinstance(options, dict):
            log.warning("%s check on %r skipped: its options are not a dict", kind, column)
        elif not column:
            log.warning("%s check skipped: it names no column", kind)
        elif any(name not in options for name in required):
            log.warning("%s check on %r skipped: it needs %s", kind, column, list(required))
        elif not 0.0 <= options.get("mostly", 1.0) <= 1.0:
            log.warning("%s check on %r skipped: 'mostly' must be within 0 and 1", kind, column)
        else:
            yield column, options


def not_null_checks(columns: Iterable[tuple[str, dict]]) -> list[Check]:
    """Checks from ``(column, {"mostly": share})`` pairs; unusable pairs are logged and skipped."""
    return [Check(NOT_NULL, c, o.get("mostly", 1.0)) for c, o in _options(NOT_NULL, columns)]


def in_set_checks(columns: Iterable[tuple[str, dict]]) -> list[Check]:
    """Checks from ``(column, {"value_set": [...], "mostly": share})`` pairs."""
    return [
        Check(IN_SET, c, o.get("mostly", 1.0), tuple(o["value_set"]))
        for c, o in _options(IN_SET, columns, ["value_set"])
    ]


def tag_checks(columns: Iterable[tuple[str, dict]], tag: str = "Owner") -> list[Check]:
    """Checks that JSON text carries a tag, from ``(column, {"mostly": share})`` pairs."""
    return [Check(HAS_TAG, c, o.get("mostly", 1.0), tag=tag) for c, o in _options(HAS_TAG, columns)]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One result row per check; the data is read once, whatever the number of checks.

    ``success_percent`` is NULL and the check succeeds when no row takes part.
    """
    return results_of(check_counts(df, checks), checks)


def check_counts(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """How many rows take part in each check, and how many of them fail it, for each group ``by``; the data is read once.

    Counts of disjoint parts add up to those of the whole, so they can be kept and only those of changed parts made anew.
    """
    if not checks:
        raise ValueError("no checks to run")
    totals = []
    for i, check in enumerate(checks):
        counted = check.evaluated()
        totals.append(F.count_if(counted).alias(f"_n{i}"))
        totals.append(F.count_if(counted & ~check.holds()).alias(f"_x{i}"))
    counts = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("bigint").alias("check_no"),
                F.col(f"_n{i}").alias("element_count"),
                F.col(f"_x{i}").alias("unexpected_count"),
            )
            for i in range(len(checks))
        ]
    )
    names = [quoted(c) for c in by]
    return df.groupBy(*names).agg(*totals).select(*names, F.explode(counts).alias("r")).select(*names, "r.*")


def results_of(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The results of :func:`run_checks` from counts of disjoint parts; a check without any count has no rows taking part."""
    listed = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("bigint").alias("check_no"),
                F.lit(c.kind).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(float(c.mostly)).alias("mostly"),
            )
            for i, c in enumerate(checks)
        ]
    )
    # One row holds the sums of all checks.
    parts = counts.groupBy().agg(
        *[
            F.coalesce(F.sum(F.when(F.col("check_no") == i + 1, F.col(c))), F.lit(0)).cast("bigint").alias(f"_{c}{i}")
            for i in range(len(checks))
            for c in ("element_count", "unexpected_count")
        ]
    )
    rows = parts.select(F.explode(listed).alias("r"), "*")
    counted = [
        F.element_at(F.array(*[F.col(f"_{c}{i}") for i in range(len(checks))]), F.col("r.check_no").cast("int")).alias(c)
        for c in ("element_count", "unexpected_count")
    ]
    rows = rows.select("r.*", *counted)
    good = (F.col("element_count") - F.col("unexpected_count")).cast("double")
    share = F.when(F.col("element_count") > 0, good / F.col("element_count"))
    return rows.select(
        "*",
        (share * 100).alias("success_percent"),
        F.coalesce(share >= F.col("mostly"), F.lit(True)).alias("success"),
    )


def suite_verdict(results: DataFrame, threshold_percent: float = 100.0) -> DataFrame:
    """One row: checks, how many succeeded, their percentage, and whether the suite passes.

    The suite passes when every check succeeds or the percentage reaches the threshold.
    """
    succeeded = F.count_if("success")
    percent = succeeded.cast("double") * 100 / F.count(F.lit(1))
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        succeeded.alias("succeeded"),
        percent.alias("success_percent"),
        (F.every("success") | (percent >= threshold_percent)).alias("passed"),
    )


def repeated_columns(columns: Sequence[str]) -> list[str]:
    """Column names that occur more than once, ignoring case."""
    counts = Counter(c.lower() for c in columns)
    return sorted(name for name, n in counts.items() if n > 1)


def unique_columns_check(df: DataFrame, strict: bool = True) -> DataFrame:
    """Whether the column names of a table are distinct, with its row count.

    Strict allows no repeated name; otherwise at least one name must be unrepeated.
    """
    repeated = repeated_columns(df.columns)
    success = not repeated if strict else len(repeated) < len({c.lower() for c in df.columns})
    return df.select().agg(F.count(F.lit(1)).alias("element_count")).select(
        F.lit(UNIQUE_COLUMNS).alias("check_name"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(",".join(repeated)).alias("repeated_columns"),
        "element_count",
        F.lit(success).alias("success"),
    )


# Expectations on the four cloud-inventory data sets.
STANDARD_SUITES: dict[str, list[Check]] = {
    "resources": [
        *not_null_checks([("id", {}), ("location", {"mostly": 0.98}), ("sku", {"mostly": 0.3}), ("tags", {"mostly": 0.70})]),
        *in_set_checks([("location", {"value_set": ["eastasia", "northeurope", "eastus2", "westeurope", "global"]})]),
    ],
    "resource_groups": [
        *not_null_checks([("id", {}), ("location", {}), ("type", {"mostly": 0.1}), ("tags", {"mostly": 0.92})]),
        *in_set_checks([("location", {"value_set": ["eastasia", "northeurope", "eastus2", "westeurope"]})]),
    ],
    "subscriptions": [
        *not_null_checks([("id", {}), ("subscriptionId", {}), ("tags", {"mostly": 0.92})]),
        *in_set_checks([("location", {"value_set": ["eastasia", "northeurope", "eastus2", "westeurope"]})]),
        *in_set_checks([("state", {"value_set": ["Enabled", "Disabled"]})]),
    ],
    "cost_management": [
        *not_null_checks([("id", {}), ("name", {}), ("sku", {"mostly": 0.1}), ("properties", {})]),
        *in_set_checks([("type", {"value_set": ["Microsoft.CostManagement/query"]})]),
    ],
}
