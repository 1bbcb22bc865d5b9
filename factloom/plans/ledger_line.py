"""Ledger-line fact: ledger rows enriched through five lookup tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.codes import DELETED, UPDATED
from factloom.functions.ledger import movement_label, opposite_side, own_side, signed_quantity
from factloom.functions.text import left_chars, literal, right_chars, source_id
from factloom.operators.changes import (
    append_tombstones,
    unify_cdc_columns,
)
from factloom.operators.filters import (
    account_range_filter,
    client_filter,
    doc_type_filter,
    since_watermark,
    split_changes,
    trailing_months_filter,
    unit_filter,
    watermark_text,
)
from factloom.operators.joins import enrich, enrich_late
from factloom.operators.keys import (
    changed_key_semi_join,
    distinct_keys,
    join_keys,
    keys_hit_on_any_path,
    keys_through,
    rows_hit,
    sieved,
    union_distinct,
)
from factloom.operators.merge import assert_unique_keys, delete_by_keys
from factloom.sources.snapshot import SnapshotTable
from factloom.sources.workspace import scratch, stage
from factloom.spec import Lookup, MergeSpec, renamed

# Ledger columns and their published names.
LEDGER_COLUMNS = {
    "RCLNT": "Client",
    "GL_SIRID": "Rec_No_Line_Itm_Rec",
    "RLDNR": "Ledger",
    "RYEAR": "Fiscal_Year",
    "RTCUR": "Currency_Key",
    "DRCRK": "Debit_Credit_Indicator",
    "POPER": "Posting_Period",
    "DOCNR": "Accounting_Document_No",
    "DOCLN": "Document_Line",
    "RBUKRS": "Company_Code",
    "RPRCTR": "Profit_Center",
    "RFAREA": "Functional_Area",
    "RACCT": "Account_No",
    "SPRCTR": "Partner_Profit_Center",
    "HSL": "Amt_Comp_Code_Curr",
    "KSL": "Amt_PC_Local_Curr",
    "BLDAT": "Document_Date",
    "BUDAT": "Document_Posting_Date",
    "REFDOCNR": "Ref_Document_No",
    "REFRYEAR": "Ref_Fiscal_Year",
    "REFDOCLN": "Line_Itm_Account_Doc_No",
    "REFDOCCT": "Ref_Document_Type",
    "WERKS": "Plant",
    "MATNR": "Material_Number",
    "KUNNR": "Customer_Number",
    "LIFNR": "Account_No_Supplier",
    "EBELN": "Purchasing_Document_No",
    "KDAUF": "Sales_Order_Doc_No",
    "VTWEG": "Distribution_Channel",
    "SPART": "Division",
    "BWART": "Mvmt_Type",
    "BLART": "Document_Type",
}

# Quantity-extension columns and their published names.
QUANTITY_COLUMNS = {
    "UMWRK": "Receiving_Issue_Plant",
    "OIC_MOT": "Ext_Mode_Transport",
    "WGT_QTY": "Weight_Qty",
    "VOL_UOM_L15": "Volume_Unit_L15",
    "VOL_QTY": "Volume_Qty",
}

# Contract-extension columns and their published names.
CONTRACT_COLUMNS = {
    "KONNR": "No_Principal_Prchg_Agmt",
    "VGBEL": "Doc_No_Ref_Doc",
    "PARCEL_ID": "Parcel_ID",
    "ZSTI_REFNO": "Smart_Contract_No",
    "DEALNO": "OIL_TSW_Deal_Number",
    "ZXBLDAT": "Document_Date_In_Doc",
    "OID_EXTBOL": "External_Bill_Of_Lading",
    "BGI_CARGOID": "Endur_Cargo_ID",
    "BGI_DELIVERYID": "BGI_Delivery_ID",
    "BGI_PARCELID": "Endur_Parcel_ID",
    "VOL_QTY_GAL": "Volume_Qty_GAL",
    "VOL_UOM_GAL": "Volume_Unit_GAL",
    "VOL_QTY_BB6": "Volume_Qty_BB6",
    "VOL_UOM_BB6": "Volume_Unit_BB6",
}

# Movement columns and their published (or working) names.
MOVEMENT_COLUMNS = {
    "MBLNR": "Material_Document_Number",
    "MJAHR": "Material_Document_Year",
    "ZEILE": "Material_Document_Itm",
    "BWART": "MM_Mvmt_Type",
    "SHKZG": "Debit_Or_Credit_Indicator",
    "WERKS": "_plant",
    "UMWRK": "_other_plant",
    "MATNR": "_material",
    "UMMAT": "_other_material",
}

# Key of the published table.
MERGE_KEYS = ("Source_ID", "Rec_No_Line_Itm_Rec")

KEY, ACTION, STAMP, CATEGORY = "Rec_No_Line_Itm_Rec", "OPFLAG", "ingested_at", "_category"
# Published columns that tell (nearly) all ledger rows apart.
ROW_KEY = (KEY, "Accounting_Document_No", "Document_Line")
REF_LEFT, REF_RIGHT = "CL_LT_Reference_Doc_No", "CL_RT_Reference_Doc_No"

# Slice column of the published table.
MONTH = "Posting_Month"

# Feeds whose rows carry a time of capture; the control table's do not.
CAPTURED = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")
# Marks ledger rows that were themselves captured since the last load.
FRESH = "_fresh"

# How the tables refer to each other (row column -> column of the table it points to).
HEADER_OF_LEDGER = {"RYEAR": "GJAHR", "RBUKRS": "BUKRS", "REFDOCNR": "BELNR"}
QUANTITY_OF_LEDGER = {"GL_SIRID": "GL_SIRID", "DOCCT": "DOCCT"}
CONTRACT_OF_LEDGER = {c: c for c in ("RLDNR", "RYEAR", "DOCNR", "DOCLN", "RBUKRS", "DOCCT")}
MOVEMENT_OF_HEADER = {"_ref_left": "MBLNR", "_ref_right": "ZEILE"}
SECOND_OF_MOVEMENT = {c: c for c in ("MBLNR", "MJAHR", "ZEILE")}

# What a changed row must tell, by feed: the keys others refer to it by, and what decides whether it counts.
CHANGE_COLUMNS = {
    "ledger": ("GL_SIRID",),
    "quantity": ("MANDT", *QUANTITY_OF_LEDGER.values()),
    "contract": ("MANDT", *CONTRACT_OF_LEDGER.values()),
    "header": ("BLART", "TCODE", *HEADER_OF_LEDGER.values()),
    "movement": ("MANDT", *MOVEMENT_OF_HEADER.values()),
    "second_quantity": ("MANDT", "MSEHI", *SECOND_OF_MOVEMENT.values()),
}


@dataclass(frozen=True)
class LedgerFeeds:
    """The seven source tables, as they were captured."""

    ledger: DataFrame
    quantity: DataFrame
    contract: DataFrame
    header: DataFrame
    movement: DataFrame
    second_quantity: DataFrame
    control: DataFrame

    def unified(self) -> "LedgerFeeds":
        """The same tables with one pair of change columns each."""
        return replace(self, **{n: unify_cdc_columns(getattr(self, n)) for n in CAPTURED})

    def since(self, watermark) -> "LedgerFeeds":
        """The rows captured since the watermark."""
        return replace(self, **{n: since_watermark(getattr(self, n), watermark) for n in CAPTURED})


@dataclass(frozen=True)
class LedgerSpec:
    """Parameters shared by the full and the delta load.

    ``months`` limits the posting date to a trailing window; None turns it off.
    ``pad_accounts`` left-pads accounts before the range test.
    """

    system: str
    as_of: object
    months: int | None = 24
    pad_accounts: int | None = None

    def stamp(self) -> str:
        return f"CAST({literal(str(self.as_of))} AS timestamp)"


def reference_keys(header: DataFrame) -> DataFrame:
    """Headers with the two movement keys that are cut out of their reference text."""
    left, right = left_chars("XBLNR", 10), right_chars("XBLNR", 4)
    return header.selectExpr("*", f"{left} AS _ref_left", f"{right} AS _ref_right")


def lookups(feeds: LedgerFeeds) -> list[Lookup]:
    """The enrichment steps, over rows that are not deleted; none depends on another.

    Movements hang on headers and second quantities on movements, so these three are joined among themselves first,
    row by row of the headers, of which there are fewer than ledger lines, and narrower ones.
    """
    current = {n: split_changes(getattr(feeds, n), ACTION)[0] for n in ("quantity", "contract", "header", "movement", "second_quantity")}
    on_ledger = LEDGER_COLUMNS | {"DOCCT": CATEGORY}
    header_key = list(HEADER_OF_LEDGER.values())
    headers = reference_keys(doc_type_filter(current["header"])).selectExpr(
        *header_key, f"_ref_left AS {REF_LEFT}", f"_ref_right AS {REF_RIGHT}"
    )
    chain = [
        Lookup(client_filter(current["movement"]),
               {REF_LEFT: "MBLNR", REF_RIGHT: "ZEILE"}, MOVEMENT_COLUMNS, copies=False),
        Lookup(unit_filter(current["second_quantity"]),
               {MOVEMENT_COLUMNS[l]: r for l, r in SECOND_OF_MOVEMENT.items()}, {"ADQNT": "Add_Oil_Gas_Qty"}, copies=False),
    ]
    documents = enrich(headers, chain, spread_by="BELNR")
    found = {c: c for c in documents.columns if c not in header_key}
    return [
        Lookup(client_filter(current["quantity"]),
               {on_ledger[l]: r for l, r in QUANTITY_OF_LEDGER.items()}, QUANTITY_COLUMNS, copies=False),
        Lookup(client_filter(current["contract"]),
               {on_ledger[l]: r for l, r in CONTRACT_OF_LEDGER.items()}, CONTRACT_COLUMNS, copies=False),
        Lookup(documents, {on_ledger[l]: r for l, r in HEADER_OF_LEDGER.items()}, found, copies=False),
    ]


def _derived() -> dict[str, str]:
    """Calculated columns, by published name."""
    signs = ("Debit_Or_Credit_Indicator", "Debit_Credit_Indicator")
    material = own_side(*signs, "_material", "_other_material")
    receiving_material = opposite_side(*signs, "_material", "_other_material")
    return {
        "Volume_GAL": "Volume_Qty",
        "Volume_BBL": "Volume_Qty",
        "MM_Plant": own_side(*signs, "_plant", "_other_plant"),
        "MM_Receiving_Plant": opposite_side(*signs, "_plant", "_other_plant"),
        "MM_Material": material,
        "MM_Receiving_Material": receiving_material,
        "MM_Volume_L15": signed_quantity("Debit_Credit_Indicator", "Add_Oil_Gas_Qty"),
        "CL_Account_No_Functional_Area": "concat(Account_No, Functional_Area)",
        "MM_Material_Key": f"substring({material}, 10, 18)",
        "CL_Receiving_Issuing_Mat_Key": f"substring({receiving_material}, 10, 18)",
        "CL_UOM_In_GAL": "'GAL'",
        "CL_Lcl_Currency": "'Local Currency'",
        "CL_Mvmt_Type_Plus": movement_label("Mvmt_Type"),
        "CL_Profit_Center": "substring(Profit_Center, 5, 10)",
        "CL_Mvmt_Group": "''",
        "CL_GL_Account_Key": "substring(Account_No, 4, 10)",
        "Material_Key": "substring(Material_Number, 10, 18)",
    }


# Published columns in order: ledger, lookups, calculated, bookkeeping.
PUBLISHED = (
    *LEDGER_COLUMNS.values(),
    *QUANTITY_COLUMNS.values(),
    *CONTRACT_COLUMNS.values(),
    REF_LEFT,
    REF_RIGHT,
    *[name for name in MOVEMENT_COLUMNS.values() if not name.startswith("_")],
    "Add_Oil_Gas_Qty",
    "Volume_GAL",
    "Volume_BBL",
    "MM_Plant",
    "MM_Receiving_Plant",
    "MM_Material",
    "MM_Receiving_Material",
    "MM_Volume_L15",
    "CL_Account_No_Functional_Area",
    "MM_Material_Key",
    "CL_Receiving_Issuing_Mat_Key",
    "CL_UOM_In_GAL",
    "CL_Lcl_Currency",
    "CL_Mvmt_Type_Plus",
    "CL_Profit_Center",
    "CL_Mvmt_Group",
    "CL_GL_Account_Key",
    "Material_Key",
    STAMP,
    "Source_ID",
    ACTION,
)


def _in_scope(ledger: DataFrame, feeds: LedgerFeeds, spec: LedgerSpec) -> DataFrame:
    """Undeleted ledger rows of the right client, accounts, dates and profit centres."""
    kept, _ = split_changes(account_range_filter(ledger, pad_to=spec.pad_accounts), ACTION)
    if spec.months is not None:
        kept = trailing_months_filter(kept, spec.as_of, spec.months)
    return changed_key_semi_join(kept, feeds.control, ["RPRCTR"])


def _lines(ledger: DataFrame, feeds: LedgerFeeds, spec: LedgerSpec) -> DataFrame:
    """Published columns of ledger rows. Repeats are removed.

    Where ledger rows are marked fresh or not, lines of those that are not count as updated.
    """
    action = f"CASE WHEN {FRESH} THEN {ACTION} ELSE {literal(UPDATED)} END" if FRESH in ledger.columns else ACTION
    base = ledger.selectExpr(*renamed(LEDGER_COLUMNS | {"DOCCT": CATEGORY}), f"{action} AS {ACTION}")
    rows = enrich_late(base, lookups(feeds), ROW_KEY)
    values = _derived() | {STAMP: spec.stamp(), "Source_ID": source_id(spec.system, "Client")}
    line = ", ".join(f"{literal(n)}, {values.get(n, n)}" for n in PUBLISHED)
    # The hash is made of published columns, so it tells no two lines apart; they already lie together by it.
    return rows.selectExpr(f"named_struct({line}) AS _line", "row_hash").distinct().select("_line.*")


def _tombstones(deleted: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Key-only rows for deleted ledger rows."""
    return deleted.selectExpr(
        "RCLNT AS Client", f"GL_SIRID AS {KEY}", f"{spec.stamp()} AS {STAMP}",
        f"{source_id(spec.system, 'RCLNT')} AS Source_ID", ACTION,
    ).distinct()


def ledger_line_full(feeds: LedgerFeeds, spec: LedgerSpec) -> DataFrame:
    """All ledger lines in scope, and a tombstone for each deleted one."""
    feeds = feeds.unified()
    scoped = _in_scope(feeds.ledger, feeds, spec)
    rows = _lines(scoped, restricted(feeds, stage(scoped.select(*HEADER_OF_LEDGER), "documents-in-scope")), spec)
    _, deleted = split_changes(account_range_filter(feeds.ledger, pad_to=spec.pad_accounts), ACTION)
    return append_tombstones(rows, _tombstones(deleted, spec))


def affected_ledger_keys(feeds: LedgerFeeds, watermark) -> DataFrame:
    """Ledger keys reached by any change since the watermark, to the ledger itself or to a lookup table.

    The changed lines' keys are read by a filtered scan of their own and written once, like the other changed keys.
    """
    changed = feeds.since(watermark)
    lines = stage(changed.ledger.select("GL_SIRID"), "changed-lines")
    return keys_reached(feeds, replace(changed, ledger=lines))


def keys_reached(feeds: LedgerFeeds, changed: LedgerFeeds) -> DataFrame:
    """Ledger keys of the changed ledger rows, and those that the changed rows of the lookup tables reach.

    ``CHANGE_COLUMNS`` of the changed rows suffice. Changed ledger rows count whatever scope they are in now, since a
    line that has left it must be retired.

    Changes that arrive through headers, movements (via headers) and second quantities
    (via movements and headers) are first reduced to one set of header keys. Deletes count
    as changes too: a line must lose what a deleted lookup row gave it.

    For all lookups the ledger is scanned once: every row offers its header, quantity and contract keys to
    one set of changed keys. That set and the movement keys are narrow and written once,
    so Spark knows their size and, when it is small, filters the large tables during their
    scan instead of shuffling them.
    """
    headers = reference_keys(feeds.header)
    changed_headers = doc_type_filter(changed.header)
    changed_movements = client_filter(changed.movement)
    changed_second = unit_filter(changed.second_quantity)
    header_key = list(HEADER_OF_LEDGER.values())
    reference_key = {"MBLNR": "MBLNR", "ZEILE": "ZEILE"}
    second_key = list(SECOND_OF_MOVEMENT.values())
    movement_keys = union_distinct(
        distinct_keys(changed_movements, reference_key),
        keys_through(
            stage(distinct_keys(changed_second, second_key), "changed-quantities"),
            [(feeds.movement, SECOND_OF_MOVEMENT)],
            list(reference_key),
            staged=True,
        ),
    )
    header_keys = union_distinct(
        distinct_keys(changed_headers, header_key),
        keys_through(stage(movement_keys, "changed-movements"), [(headers, MOVEMENT_OF_HEADER)], header_key, staged=True),
    )
    paths = [
        (header_keys, HEADER_OF_LEDGER),
        (client_filter(changed.quantity), QUANTITY_OF_LEDGER),
        (client_filter(changed.contract), CONTRACT_OF_LEDGER),
    ]
    return union_distinct(changed.ledger.select("GL_SIRID"), keys_hit_on_any_path(feeds.ledger, paths, ["GL_SIRID"]))


def restricted(feeds: LedgerFeeds, ledger: DataFrame) -> LedgerFeeds:
    """The chain of headers, movements and second quantities, cut down to what the given (few) ledger rows can reach.

    A left-outer join never broadcasts its left side, so joining the few headers of a delta
    to whole tables would shuffle all of them. A semi join against the delta's keys lets
    Spark filter each table during its scan when the keys are small; where there are more, a sieve of them does, and
    the few rows too many that it lets pass enrich nothing. (Quantities and
    contracts meet the ledger's own keys in an inner join, which does the same.) ``ledger`` should be staged.
    """
    def reached(rows: DataFrame, by: DataFrame, on: dict[str, str]) -> DataFrame:
        few = sieved(rows, by, {r: l for l, r in on.items()})
        return rows_hit(rows, by, {r: l for l, r in on.items()}) if few is rows else few

    columns = ("BUKRS", "BELNR", "GJAHR", "BLART", "TCODE", "XBLNR", ACTION)
    headers = stage(reached(feeds.header.select(*columns), ledger, HEADER_OF_LEDGER), "headers-reached")
    movements = feeds.movement.select("MANDT", *MOVEMENT_COLUMNS, ACTION)
    movements = stage(reached(movements, reference_keys(headers), MOVEMENT_OF_HEADER), "movements-reached")
    return replace(
        feeds,
        header=headers,
        movement=movements,
        second_quantity=reached(feeds.second_quantity, movements, SECOND_OF_MOVEMENT),
    )


def ledger_line_changes(feeds: LedgerFeeds, spec: LedgerSpec, watermark) -> tuple[DataFrame, DataFrame]:
    """What a delta load writes: the new rows, and the keys of every line that may have changed.

    A key without a new row is a line that left the scope: its posting date, its account
    or its profit centre no longer qualifies.
    """
    feeds = feeds.unified()
    since = watermark_text(feeds.ledger, "ingested_at", watermark)
    fresh = F.expr(f"coalesce(ingested_at >= {since}, false)")
    return _changes(feeds, feeds.since(watermark), spec, lambda lines: lines.withColumn(FRESH, fresh))


def ledger_line_changes_of(feeds: LedgerFeeds, changed: LedgerFeeds, spec: LedgerSpec) -> tuple[DataFrame, DataFrame]:
    """The same for changed rows that are given rather than told by a watermark; ``CHANGE_COLUMNS`` of them suffice."""
    captured = join_keys(changed.ledger, ["GL_SIRID"]).withColumn(FRESH, F.lit(True))

    def marked(lines: DataFrame) -> DataFrame:
        return lines.join(captured, "GL_SIRID", "left").withColumn(FRESH, F.coalesce(FRESH, F.lit(False)))

    return _changes(feeds.unified(), changed, spec, marked)


def _changes(
    feeds: LedgerFeeds, changed: LedgerFeeds, spec: LedgerSpec, marked: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """:func:`ledger_line_changes` of unified feeds; ``marked`` tells which ledger rows were captured since."""
    keys = stage(keys_reached(feeds, changed), "affected-lines")
    reached = changed_key_semi_join(feeds.ledger, keys, ["GL_SIRID"], staged=True)
    again = stage(marked(reached), "lines-touched")
    scoped = stage(_in_scope(again, feeds, spec), "lines-to-derive")
    rows = _lines(scoped, restricted(feeds, scoped), spec)
    _, deleted = split_changes(account_range_filter(again, pad_to=spec.pad_accounts), ACTION)
    touched = again.selectExpr(f"{source_id(spec.system, 'RCLNT')} AS Source_ID", f"GL_SIRID AS {KEY}")
    # A line deleted earlier that a lookup change reaches keeps the tombstone it has.
    old = deleted.filter(f"NOT {FRESH}")
    old = old.selectExpr(f"{source_id(spec.system, 'RCLNT')} AS Source_ID", f"GL_SIRID AS {KEY}")
    touched = touched.join(join_keys(old, list(MERGE_KEYS)), list(MERGE_KEYS), "left_anti")
    return append_tombstones(rows, _tombstones(deleted.filter(FRESH), spec)), touched


def ledger_line_delta(target: DataFrame, feeds: LedgerFeeds, spec: LedgerSpec, watermark) -> DataFrame:
    """The fact after a delta load. It holds the lines that a full load at ``spec.as_of`` would hold.

    Lines that may have changed are replaced by what is derived for them now, or retired
    if they left the scope; others stay, unless their posting date has left the window.
    The target is joined once, with the set of changed keys. (Changes of the control
    table alone carry no time; they reach the fact with the next full load.)
    """
    changes, touched = ledger_line_changes(feeds, spec, watermark)
    changes = stage(changes, "merge-source")
    assert_unique_keys(changes, MERGE_KEYS)
    if spec.months is not None:
        posted = LEDGER_COLUMNS["BUDAT"]
        dead = F.coalesce(F.col(ACTION) == DELETED, F.lit(False))
        inside = trailing_months_filter(target.filter(~dead), spec.as_of, spec.months, posted)
        target = inside.unionByName(target.filter(dead))
    return delete_by_keys(target, stage(touched, "merge-deletes"), MERGE_KEYS, staged=True).unionByName(changes)


def by_month(lines: DataFrame) -> DataFrame:
    """Lines with the slice that the published table keeps them in; tombstones have none."""
    return lines.withColumn(MONTH, F.date_format(LEDGER_COLUMNS["BUDAT"], "yyyy-MM"))


def published_table(spark, path: str) -> SnapshotTable:
    """The fact as a published table, sliced by posting month."""
    return SnapshotTable(spark, path, [MONTH])


def publish_full(table: SnapshotTable, feeds: LedgerFeeds, spec: LedgerSpec) -> None:
    """Publish all ledger lines as a new version."""
    with scratch(table.spark):
        table.overwrite(by_month(ledger_line_full(feeds, spec)))


def publish_delta(table: SnapshotTable, feeds: LedgerFeeds, spec: LedgerSpec, watermark) -> None:
    """Bring the published lines to what a full load at ``spec.as_of`` would publish; see :func:`ledger_line_delta`.

    Lines that may have changed are looked up by key, wherever they are now, and only their old and new months are
    read and replaced. Months that have left the posting window go by folder; of the month in which the
    window begins, the earlier lines go. No other file is touched.
    """
    with scratch(table.spark):
        _publish(table, *ledger_line_changes(feeds, spec, watermark), spec)


def publish_changes(table: SnapshotTable, feeds: LedgerFeeds, changed: LedgerFeeds, spec: LedgerSpec) -> None:
    """:func:`publish_delta` for changed rows that are given rather than told by a watermark."""
    with scratch(table.spark):
        _publish(table, *ledger_line_changes_of(feeds, changed, spec), spec)


def _publish(table: SnapshotTable, changes: DataFrame, touched: DataFrame, spec: LedgerSpec) -> None:
    changes = stage(by_month(changes), "lines-changed")
    retired = touched.join(join_keys(changes, MERGE_KEYS), list(MERGE_KEYS), "left_anti")
    table.merge(changes, MergeSpec(keys=MERGE_KEYS), deleted=retired)
    if spec.months is not None:
        first = f"add_months(CAST({literal(str(spec.as_of))} AS date), -{spec.months})"
        row = table.spark.sql(f"SELECT {first} AS day, date_format({first}, 'yyyy-MM') AS month").first()
        table.age_out(LEDGER_COLUMNS["BUDAT"], row.day, row.month)
