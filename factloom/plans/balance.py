"""Balance fact: the ledger index, with hard deletes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.codes import DELETED
from factloom.functions.text import literal
from factloom.operators.filters import since_watermark, source_system_filter
from factloom.operators.merge import merge_staged
from factloom.operators.project import rename_projection, with_source_id
from factloom.spec import NOW, MergeSpec, quoted

# Index columns and their published names.
INDEX_COLUMNS = {
    "RCLNT": "Client",
    "AWREF": "Reference_Document_Number",
    "AWTYP": "Reference_Procedure",
    "AWORG": "Reference_Organisational_Units",
    "RLDNR": "Ledger",
    "DOCCT": "Document_Type",
    "RYEAR": "Fiscal_Year",
    "DOCNR": "Doc_Number",
    "BUDAT": "Posting_Date_In_The_Document",
    "RRCTY": "Record_Type",
    "RVERS": "Version",
    "RCOMP": "Company",
    "BUKRS": "Company_Code",
    "DOCTY": "FI_SL_Document_Type",
    "BELNR": "Accounting_Document_Number",
    "LAST_DTM": "LAST_DTM",
    "ingested_at": "ingested_at",
}

# Merge key of the balance fact.
MERGE_KEYS = (
    "Source_ID",
    "Reference_Document_Number",
    "Reference_Procedure",
    "Reference_Organisational_Units",
    "Ledger",
    "Document_Type",
    "Fiscal_Year",
    "Doc_Number",
)

LOADED, STAMP = "ingested_at", "Ingested_At"


@dataclass(frozen=True)
class BalanceSpec:
    """One source of the balance fact."""

    source: str
    system: str

    def rows(self, raw: DataFrame) -> DataFrame:
        return source_system_filter(rename_projection(raw, INDEX_COLUMNS), self.source)


def balance_full(raw: DataFrame, spec: BalanceSpec, stamp: str = NOW) -> DataFrame:
    """The whole index of the source."""
    rows = with_source_id(spec.rows(raw), spec.system).drop("Client", LOADED)
    return rows.withColumn(STAMP, F.expr(stamp))


def balance_changes(raw: DataFrame, spec: BalanceSpec, watermark) -> DataFrame:
    """Index rows loaded since the watermark."""
    changed = since_watermark(spec.rows(raw), watermark, LOADED)
    return with_source_id(changed, spec.system).drop("Client", LOADED)


def deleted_keys(landing: DataFrame, spec: BalanceSpec, watermark, action: str = "LAST_ACTION_CD") -> DataFrame:
    """Keys whose deletion arrived in the landing feed since the watermark."""
    gone = since_watermark(landing.filter(f"{quoted(action)} = {literal(DELETED)}"), watermark, LOADED)
    names = {c: n for c, n in INDEX_COLUMNS.items() if n == "Client" or n in MERGE_KEYS}
    return with_source_id(rename_projection(gone, names), spec.system).drop("Client").distinct()


def balance_delta(
    target: DataFrame,
    raw: DataFrame,
    landing: DataFrame,
    spec: BalanceSpec,
    watermark,
    stamp: str = NOW,
) -> DataFrame:
    """The fact after a delta load: upsert and delete in one pass over it; delete wins."""
    merge = MergeSpec(keys=MERGE_KEYS, stamp={STAMP: stamp})
    gone = deleted_keys(landing, spec, watermark)
    return merge_staged(target, balance_changes(raw, spec, watermark), merge, deleted=gone)
