"""The published facts: shape, full load against delta loads, decided corner cases."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from factloom.operators import filters
from factloom.plans import balance, header_item, ledger_line
from factloom.sources.workspace import stage
from tests.compare import spark_bag
from workload.bindings import WATERMARK, feed, ledger_feeds
from workload.facts import ACCOUNTING_SPEC, BALANCE_SPEC, LEDGER_SPEC, STAMP

FOLDER = "/root/testdata/sf0.001"
FEEDS = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")


def rows(df):
    return spark_bag(df)[1]


# ---- ledger lines -----------------------------------------------------------------


def small_feeds(spark, **changed):
    """Two ledger rows; the first reaches all five lookups."""
    change = "LAST_DTM timestamp, LAST_ACTION_CD string, AEDATTM timestamp, OPFLAG string, ingested_at timestamp"
    old = "timestamp'2024-01-01'"

    def frame(columns, *records):
        names = [c.split()[0] for c in columns.split(", ")]
        texts = []
        for record in records:
            values = dict(zip(names, record))
            extra = dict(zip(("op", "at"), record[len(names):])) or {}
            op, at = extra.get("op", "I"), extra.get("at", "2024-01-01")
            body = ", ".join(f"CAST({'NULL' if v is None else repr(v)} AS {c.split()[1]}) AS {c.split()[0]}"
                             for c, v in zip(columns.split(", "), values.values()))
            texts.append(
                f"SELECT {body}, CAST(NULL AS timestamp) AS LAST_DTM, CAST(NULL AS string) AS LAST_ACTION_CD, "
                f"timestamp'{at}' AS AEDATTM, {'CAST(NULL AS string)' if op is None else repr(op)} AS OPFLAG, "
                f"timestamp'{at}' AS ingested_at"
            )
        return spark.sql(" UNION ALL ".join(texts))

    ledger_fields = {
        c: "string" for c in (*ledger_line.LEDGER_COLUMNS, "DOCCT")
    } | {"HSL": "double", "KSL": "double", "BLDAT": "date", "BUDAT": "date"}
    base = {
        "RCLNT": "110", "RLDNR": "0L", "RYEAR": "2024", "DRCRK": "H", "DOCNR": "D1", "RBUKRS": "C1",
        "RPRCTR": "00001234567890", "RFAREA": "F", "RACCT": "0007000000", "BUDAT": "2024-01-05", "REFDOCNR": "B1",
        "BWART": "552", "DOCCT": "A", "MATNR": "000000000000000042",
    }

    def ledger(*records):
        columns = ", ".join(f"{c} {t}" for c, t in ledger_fields.items())
        return frame(columns, *[(*[{**base, **r}.get(c) for c in ledger_fields], *extra) for r, *extra in records])

    tables = {
        "ledger": ledger(({"GL_SIRID": "1", "DOCLN": "1"},), ({"GL_SIRID": "2", "DOCLN": "2", "REFDOCNR": None},)),
        "quantity": frame("MANDT string, DOCCT string, GL_SIRID string, UMWRK string, OIC_MOT string, WGT_QTY double, "
                          "VOL_UOM_L15 string, VOL_QTY double", ("110", "A", "1", "U", "01", 5.0, "L15", 7.0)),
        "contract": frame("MANDT string, RYEAR string, RBUKRS string, RLDNR string, DOCCT string, DOCNR string, DOCLN string, "
                          + ", ".join(f"{c} string" for c in ledger_line.CONTRACT_COLUMNS),
                          ("110", "2024", "C1", "0L", "A", "D1", "1", *["x"] * 14)),
        "header": frame("BUKRS string, BELNR string, GJAHR string, BLART string, TCODE string, XBLNR string",
                        ("C1", "B1", "2024", "HC", "FB08", "1234567890/0001")),
        "movement": frame("MANDT string, MBLNR string, MJAHR string, ZEILE string, BWART string, MATNR string, WERKS string, "
                          "SHKZG string, UMMAT string, UMWRK string",
                          ("110", "1234567890", "2024", "0001", "101", "000000000000000077", "W1", "S", "000000000000000088", "W2")),
        "second_quantity": frame("MANDT string, MBLNR string, MJAHR string, ZEILE string, MSEHI string, ADQNT double",
                                 ("110", "1234567890", "2024", "0001", "L15", 3.0)),
        "control": spark.sql("SELECT '00001234567890' AS RPRCTR UNION ALL SELECT '00001234567890'"),
    }
    made = {name: build(frame, ledger) for name, build in changed.items()}
    return ledger_line.LedgerFeeds(**{**tables, **made})


SMALL = ledger_line.LedgerSpec(system="P94", as_of="2024-06-30")


def by_key(df):
    found = df.collect()
    assert len({r[ledger_line.KEY] for r in found}) == len(found)
    return {r[ledger_line.KEY]: r for r in found}


def test_published_columns():
    assert len(ledger_line.PUBLISHED) == len(set(ledger_line.PUBLISHED)) == 79


def test_enrichment_of_one_line(spark):
    lines = by_key(ledger_line.ledger_line_full(small_feeds(spark), SMALL))
    line, bare = lines["1"], lines["2"]
    assert (line.Source_ID, line.OPFLAG, line.Client) == ("P94_110", "I", "110")
    assert (line.Volume_Qty, line.Volume_GAL, line.Volume_BBL) == (7.0, 7.0, 7.0)
    assert (line.CL_LT_Reference_Doc_No, line.CL_RT_Reference_Doc_No) == ("1234567890", "0001")
    # the movement is a debit, the line a credit: own plant and material first
    assert (line.MM_Plant, line.MM_Receiving_Plant) == ("W1", "W2")
    assert (line.MM_Material_Key, line.CL_Receiving_Issuing_Mat_Key) == ("000000077", "000000088")
    assert (line.Add_Oil_Gas_Qty, line.MM_Volume_L15) == (3.0, -3.0)
    assert (line.CL_Mvmt_Type_Plus, line.CL_Profit_Center, line.CL_GL_Account_Key) == ("Scrapping", "1234567890", "7000000")
    assert line.CL_Account_No_Functional_Area == "0007000000F" and line.Endur_Cargo_ID == "x"
    assert (bare.Volume_Qty, bare.Material_Document_Number, bare.MM_Plant) == (None, None, None)
    assert bare.CL_Mvmt_Group == "" and bare.CL_UOM_In_GAL == "GAL"


def test_deleted_rows_on_both_sides(spark):
    feeds = small_feeds(
        spark,
        ledger=lambda frame, ledger: ledger(({"GL_SIRID": "1", "DOCLN": "1"}, None), ({"GL_SIRID": "3"}, "D")),
        movement=lambda frame, ledger: frame(
            "MANDT string, MBLNR string, MJAHR string, ZEILE string, BWART string, MATNR string, WERKS string, "
            "SHKZG string, UMMAT string, UMWRK string",
            ("110", "1234567890", "2024", "0001", "101", "m", "W1", "S", "n", "W2", "D"),
        ),
    )
    lines = by_key(ledger_line.ledger_line_full(feeds, SMALL))
    assert lines["1"].Material_Document_Number is None and lines["1"].CL_LT_Reference_Doc_No == "1234567890"
    tomb = lines["3"].asDict()
    filled = {k for k, v in tomb.items() if v is not None}
    assert filled == {"Client", "Source_ID", ledger_line.KEY, "OPFLAG", "ingested_at"} and tomb["OPFLAG"] == "D"


@pytest.mark.parametrize(
    "table, change",
    [
        ("header", lambda frame, ledger: frame(
            "BUKRS string, BELNR string, GJAHR string, BLART string, TCODE string, XBLNR string",
            ("C1", "B1", "2024", "HC", "FB08", "none", "U", "2024-03-01"))),
        ("movement", lambda frame, ledger: frame(
            "MANDT string, MBLNR string, MJAHR string, ZEILE string, BWART string, MATNR string, WERKS string, "
            "SHKZG string, UMMAT string, UMWRK string",
            ("110", "1234567890", "2024", "0001", "101", "m", "W9", "S", "n", "W2", "D", "2024-03-01"))),
        ("second_quantity", lambda frame, ledger: frame(
            "MANDT string, MBLNR string, MJAHR string, ZEILE string, MSEHI string, ADQNT double",
            ("110", "1234567890", "2024", "0001", "L15", 8.0, "U", "2024-03-01"))),
        ("quantity", lambda frame, ledger: frame(
            "MANDT string, DOCCT string, GL_SIRID string, UMWRK string, OIC_MOT string, WGT_QTY double, "
            "VOL_UOM_L15 string, VOL_QTY double", ("110", "A", "1", "U", "01", 5.0, "L15", 9.0, "U", "2024-03-01"))),
        ("contract", lambda frame, ledger: frame(
            "MANDT string, RYEAR string, RBUKRS string, RLDNR string, DOCCT string, DOCNR string, DOCLN string, "
            + ", ".join(f"{c} string" for c in ledger_line.CONTRACT_COLUMNS),
            ("110", "2024", "C1", "0L", "A", "D1", "1", *["y"] * 14, "D", "2024-03-01"))),
        ("ledger", lambda frame, ledger: ledger(
            ({"GL_SIRID": "1", "DOCLN": "1"}, "D", "2024-03-01"),
            ({"GL_SIRID": "2", "DOCLN": "2", "REFDOCNR": None}, "I", "2024-01-01"),
            ({"GL_SIRID": "4", "DOCLN": "4"}, None, "2024-03-01"))),
    ],
)
def test_delta_through_any_table_equals_full(spark, table, change):
    before, after = small_feeds(spark), small_feeds(spark, **{table: change})
    target = stage(ledger_line.ledger_line_full(before, SMALL), "test-target")
    delta = stage(ledger_line.ledger_line_delta(target, after, SMALL, "2024-02-01"), "test-delta")
    full = ledger_line.ledger_line_full(after, SMALL)
    assert rows(delta.drop("OPFLAG")) == rows(full.drop("OPFLAG"))
    actions = {key: row.OPFLAG for key, row in by_key(delta).items()}
    if table == "ledger":
        assert actions == {"1": "D", "2": "I", "4": None}
    else:
        assert actions == {"1": "U", "2": "I"}


def test_changed_lines_are_affected_along_with_lines_reached_by_a_lookup(spark):
    at = "2024-03-01"

    def lines(frame, ledger):
        return ledger(
            ({"GL_SIRID": "1", "DOCLN": "1"},), ({"GL_SIRID": "2", "DOCLN": "2", "REFDOCNR": None},),
            # 3 is new, 4 left the accounts, 5 is deleted, 6 has no action, 7 comes twice and is reached besides, one has no key
            ({"GL_SIRID": "3", "DOCLN": "3", "REFDOCNR": None}, "I", at), ({"GL_SIRID": "4", "DOCLN": "4", "RACCT": "0001000000"}, "U", at),
            ({"GL_SIRID": "5", "DOCLN": "5"}, "D", at), ({"GL_SIRID": "6", "DOCLN": "6", "REFDOCNR": None}, None, at),
            ({"GL_SIRID": "7", "DOCLN": "7"}, "I"), ({"GL_SIRID": "7", "DOCLN": "7"}, "U", at), ({"GL_SIRID": None, "DOCLN": "8"}, "U", at),
        )

    def header(frame, ledger):
        return frame("BUKRS string, BELNR string, GJAHR string, BLART string, TCODE string, XBLNR string",
                     ("C1", "B1", "2024", "HC", "FB08", "none", "U", at))

    alone, both = small_feeds(spark, ledger=lines).unified(), small_feeds(spark, ledger=lines, header=header).unified()

    def keys(found):
        found = [r.GL_SIRID for r in found.collect()]
        assert len(found) == len(set(found))
        return set(found)

    assert keys(ledger_line.affected_ledger_keys(alone, "2024-02-01")) == {"3", "4", "5", "6", "7", None}
    assert keys(ledger_line.affected_ledger_keys(both, "2024-02-01")) == {"1", "3", "4", "5", "6", "7", None}
    assert keys(ledger_line.affected_ledger_keys(alone, "2024-03-02")) == set()
    assert keys(ledger_line.affected_ledger_keys(alone, None)) == {"1", "2", "3", "4", "5", "6", "7", None}
    assert keys(ledger_line.keys_reached(alone, alone.since("2024-02-01"))) == {"3", "4", "5", "6", "7", None}


def test_lines_that_leave_the_scope_are_retired(spark):
    columns = "MANDT string, DOCCT string, GL_SIRID string, UMWRK string, OIC_MOT string, WGT_QTY double, VOL_UOM_L15 string, VOL_QTY double"
    at = "2024-03-01"
    lines = {"1": {}, "2": {}, "3": {}, "4": {}, "5": {"BUDAT": "2024-02-20"}}
    before = small_feeds(spark, ledger=lambda frame, ledger: ledger(*[({"GL_SIRID": k, "DOCLN": k, **v},) for k, v in lines.items()]))
    after = small_feeds(
        spark,
        # 1 is unchanged but ages out, 2 changes account, 3 changes profit centre, 4 ages out and changes, 5 stays
        ledger=lambda frame, ledger: ledger(
            ({"GL_SIRID": "1", "DOCLN": "1"},), ({"GL_SIRID": "2", "DOCLN": "2", "RACCT": "0001000000", "BUDAT": "2024-02-20"}, "U", at),
            ({"GL_SIRID": "3", "DOCLN": "3", "RPRCTR": "elsewhere", "BUDAT": "2024-02-20"}, "U", at), ({"GL_SIRID": "4", "DOCLN": "4"}, "U", at),
            ({"GL_SIRID": "5", "DOCLN": "5", "BUDAT": "2024-02-20"},),
        ),
        quantity=lambda frame, ledger: frame(columns, ("110", "A", "5", "U", "01", 5.0, "L15", 999.0, "U", at)),
    )
    later = replace(SMALL, as_of="2026-02-01")
    target = stage(ledger_line.ledger_line_full(before, SMALL), "test-target")
    assert set(by_key(target)) == set(lines)
    delta = stage(ledger_line.ledger_line_delta(target, after, later, "2024-02-01"), "test-delta")
    full = ledger_line.ledger_line_full(after, later)
    assert rows(delta.drop("OPFLAG")) == rows(full.drop("OPFLAG"))
    assert set(by_key(delta)) == {"5"} and by_key(delta)["5"].Volume_Qty == 999.0


def test_ledger_delta_equals_full_on_the_given_tables(spark):
    delta = entry_points.queries()["ledger_line_fact_delta"](spark, FOLDER)
    full = ledger_line.ledger_line_full(ledger_feeds(spark, FOLDER), LEDGER_SPEC)
    assert rows(delta.drop("OPFLAG", "ingested_at")) == rows(full.drop("OPFLAG", "ingested_at"))


def test_repeated_delta_changes_nothing(spark):
    feeds = ledger_feeds(spark, FOLDER)
    old = replace(feeds, **{n: filters.before_watermark(getattr(feeds, n), WATERMARK) for n in FEEDS})
    target = stage(ledger_line.ledger_line_full(old, LEDGER_SPEC), "test-target")
    once = stage(ledger_line.ledger_line_delta(target, feeds, LEDGER_SPEC, WATERMARK), "test-once")
    assert rows(ledger_line.ledger_line_delta(once, feeds, LEDGER_SPEC, WATERMARK)) == rows(once)


# ---- accounting documents ---------------------------------------------------------


def test_accounting_delta_equals_full(spark):
    documents, items = feed(spark, FOLDER, "document"), feed(spark, FOLDER, "item")
    old = [filters.before_watermark(f, WATERMARK) for f in (documents, items)]
    target = stage(header_item.header_item_full(*old, ACCOUNTING_SPEC, STAMP), "test-target")
    full = header_item.header_item_full(documents, items, ACCOUNTING_SPEC, STAMP)
    merged = header_item.header_item_delta(
        target, documents, items, ACCOUNTING_SPEC, WATERMARK, STAMP
    )
    assert rows(merged) == rows(full)


def test_header_without_items_delivered_twice_stays_one_row(spark):
    headers = spark.sql(
        "SELECT '280' AS MANDT, 'C' AS BUKRS, 'B' AS BELNR, '2024' AS GJAHR, timestamp'2024-01-01' AS ingested_at"
    )
    items = spark.sql(
        "SELECT '280' AS MANDT, 'C' AS BUKRS, 'other' AS BELNR, '2024' AS GJAHR, '1' AS BUZEI, "
        "timestamp'2024-01-01' AS ingested_at"
    )
    spec = header_item.HeaderItemSpec(source="STN", system="P80")
    target = header_item.header_item_full(headers, items, spec, STAMP)
    again = header_item.header_item_delta(target, headers, items, spec, "2024-01-01", STAMP)
    assert again.count() == target.count() == 1
    loose = replace(spec, unnumbered_once=False)
    assert header_item.header_item_delta(target, headers, items, loose, "2024-01-01", STAMP).count() == 2


def test_five_hundred_columns(spark):
    names = [f"C{i:03d}" for i in range(490)]
    headers = spark.range(20).selectExpr(
        "'480' AS MANDT", "'C' AS BUKRS", "cast(id AS string) AS BELNR", "'2024' AS GJAHR",
        "timestamp'2024-01-01' AS ingested_at",
    )
    items = spark.range(50).selectExpr(
        "'480' AS MANDT", "'C' AS BUKRS", "cast(id % 15 AS string) AS BELNR", "'2024' AS GJAHR", "cast(id AS string) AS BUZEI",
        "timestamp'2024-01-01' AS ingested_at", *[f"id + {i} AS {n}" for i, n in enumerate(names)],
    )
    spec = header_item.HeaderItemSpec("TSAP", "P81", items={n: f"Published_{n}" for n in names})
    full = header_item.header_item_full(headers, items, spec, STAMP)
    assert len(full.columns) == 490 + 6
    target = stage(full, "test-wide")
    changed = items.withColumns({"C000": F.lit(-1), "ingested_at": F.lit("2024-02-01").cast("timestamp")})
    after = header_item.header_item_delta(target, headers, changed, spec, "2024-01-15", STAMP)
    assert after.count() == 55
    assert after.filter("Published_C000 = -1").count() == 50
    assert after.agg(F.sum("Published_C489")).first()[0] == sum(i + 489 for i in range(50))


# ---- balances ---------------------------------------------------------------------


def test_balance_shape_and_delete_wins(spark):
    index = feed(spark, FOLDER, "index")
    full = balance.balance_full(index, BALANCE_SPEC, STAMP)
    assert len(full.columns) == 17 and "Client" not in full.columns
    after = balance.balance_delta(full, index, index, BALANCE_SPEC, WATERMARK, STAMP)
    gone = balance.deleted_keys(index, BALANCE_SPEC, WATERMARK)
    assert gone.count() > 0
    assert rows(after) == rows(full.join(gone, list(balance.MERGE_KEYS), "left_anti"))


# ---- plans ------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["ledger_line_fact", "header_item_fact", "affected_key_union", "run_log_end", "merge_upsert"])
def test_no_cross_joins(spark, name):
    plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
