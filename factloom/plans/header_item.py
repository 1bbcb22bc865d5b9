"""Accounting fact: document headers with their items."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.filters import since_watermark, source_system_filter
from factloom.operators.joins import parent_child_join
from factloom.operators.keys import changed_key_semi_join, distinct_keys, join_keys, rows_hit, union_distinct
from factloom.operators.merge import merge_upsert
from factloom.operators.project import rename_projection, with_source_id, without
from factloom.sources.workspace import stage
from factloom.spec import NOW, MergeSpec

# Published names of the document key, the line and the client.
DOCUMENT_KEY = ("Company_Code", "Accounting_Document_Number", "Fiscal_Year")
LINE_KEY = "Number_Of_Line_Item_Within_Accounting_Document"
MERGE_KEYS = ("Source_ID", *DOCUMENT_KEY, LINE_KEY)
HEADER_KEYS = {"MANDT": "Client", "BUKRS": "Company_Code", "BELNR": "Accounting_Document_Number", "GJAHR": "Fiscal_Year"}
ITEM_KEYS = {"BUKRS": "BUKRS", "BELNR": "BELNR", "GJAHR": "GJAHR", "BUZEI": LINE_KEY}

STAMP = "Ingested_At"


@dataclass(frozen=True)
class HeaderItemSpec:
    """One source of the accounting fact.

    The sources differ in client, system code and column lists only. ``headers`` and
    ``items`` rename the payload columns (several hundred in practice, usually read
    from a mapping file); key columns are added here. ``unnumbered_once`` lets a
    header without items, whose line number is NULL, match itself in a merge.
    """

    source: str
    system: str
    headers: Mapping[str, str] = field(default_factory=dict)
    items: Mapping[str, str] = field(default_factory=dict)
    loaded: str = "ingested_at"
    unnumbered_once: bool = True

    def header_rows(self, raw: DataFrame) -> DataFrame:
        named = rename_projection(raw, {**HEADER_KEYS, **self.headers, self.loaded: self.loaded})
        return source_system_filter(named, self.source)

    def item_rows(self, raw: DataFrame) -> DataFrame:
        named = rename_projection(raw, {**ITEM_KEYS, **self.items, "MANDT": "Client", self.loaded: self.loaded})
        return source_system_filter(named, self.source).drop("Client")

    def merge_spec(self, stamp: str = NOW) -> MergeSpec:
        return MergeSpec(
            keys=MERGE_KEYS,
            null_safe=(LINE_KEY,) if self.unnumbered_once else (),
            stamp={STAMP: stamp},
        )


_ON = dict(zip(DOCUMENT_KEY, ("BUKRS", "BELNR", "GJAHR")))
_TO_DOCUMENT = {child: parent for parent, child in _ON.items()}


def _documents(headers: DataFrame, items: DataFrame, spec: HeaderItemSpec) -> DataFrame:
    joined = parent_child_join(headers.drop(spec.loaded), items.drop(spec.loaded), _ON)
    return with_source_id(joined, spec.system)


def header_item_full(headers: DataFrame, items: DataFrame, spec: HeaderItemSpec, stamp: str = NOW) -> DataFrame:
    """All documents of the source, one row per item; item-less documents once."""
    rows = _documents(spec.header_rows(headers), spec.item_rows(items), spec)
    return without(rows, ["Client"]).withColumn(STAMP, F.expr(stamp))


def header_item_changes(headers: DataFrame, items: DataFrame, spec: HeaderItemSpec, watermark) -> DataFrame:
    """Complete documents of which the header or any item changed since the watermark.

    The changed keys are written once, and both tables are cut down to them before the
    join: a small delta then costs one filtered scan of each table, without shuffling it.
    """
    header_rows, item_rows = spec.header_rows(headers), spec.item_rows(items)
    changed = union_distinct(
        distinct_keys(since_watermark(header_rows, watermark, spec.loaded), DOCUMENT_KEY),
        distinct_keys(since_watermark(item_rows, watermark, spec.loaded), _TO_DOCUMENT),
    )
    changed = stage(changed, "changed-documents")
    return _documents(
        changed_key_semi_join(header_rows, changed, DOCUMENT_KEY), rows_hit(item_rows, changed, _TO_DOCUMENT), spec
    )


def header_item_delta(
    target: DataFrame,
    headers: DataFrame,
    items: DataFrame,
    spec: HeaderItemSpec,
    watermark,
    stamp: str = NOW,
    deleted: DataFrame | None = None,
    retire_unnumbered: bool = True,
) -> DataFrame:
    """The fact after a delta load; ``deleted`` optionally names keys to remove.

    A document that was published before its items arrived has a row without a line
    number. ``retire_unnumbered`` removes that row once the document has items, which a
    merge alone cannot do, so that deltas lead to the same rows as a full load. Only rows
    without a line number take part in it.
    """
    changes = stage(header_item_changes(headers, items, spec, watermark), "merge-source")
    if retire_unnumbered:
        key = ["Source_ID", *DOCUMENT_KEY]
        numbered = join_keys(changes.filter(f"{LINE_KEY} IS NOT NULL"), {f"_n_{k}": k for k in key})
        same = F.expr(" AND ".join(f"{k} = _n_{k}" for k in key))
        bare = target.filter(f"{LINE_KEY} IS NULL").join(numbered, same, "left_anti")
        target = target.filter(f"{LINE_KEY} IS NOT NULL").unionByName(bare)
    return merge_upsert(target, changes, spec.merge_spec(stamp), deleted=deleted)
