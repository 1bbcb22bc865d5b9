"""Change detection, merge maintenance and the published facts."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.codes import system_code
from factloom.operators import changes, filters, merge
from factloom.plans import balance, header_item, ledger_line
from factloom.plans.publish import run_fact
from factloom.sources.catalog import reader_views, register_table
from factloom.sources.files import read_column_map, read_view_columns
from factloom.sources.runlog_table import RunLogTable
from factloom.sources.snapshot import SnapshotTable
from factloom.spec import MergeSpec
from factloom.streaming.inbox import LedgerInbox
from workload.basics import CONTROL_SQL, LABEL_SQL, SWAP_SQL
from workload.bindings import AS_OF, WATERMARK, feed, ledger_feeds, ledger_streams, table
from workload.registry import AS_OF_SQL, WM_SQL, feed_sql, fresh_path, query, unified_sql

LEDGER_SPEC = ledger_line.LedgerSpec(system=system_code("dev", "GSAP"), as_of=AS_OF)
# The published line items that a delta starts from: loaded at the watermark, with the window of that day.
EARLIER_SPEC = replace(LEDGER_SPEC, as_of=WATERMARK)
ACCOUNTING_SPEC = header_item.HeaderItemSpec(
    source="STN",
    system=system_code("dev", "STN"),
    headers={
        "BLART": "Document_Type",
        "TCODE": "Transaction_Code",
        "XBLNR": "Reference_Document_Number",
        "BUDAT": "Posting_Date_In_The_Document",
        "KURSF": "Exchange_Rate",
    },
    items={
        "BSCHL": "Posting_Key",
        "SHKZG": "Debit_Credit_Indicator",
        "MWSKZ": "Tax_On_Sales_Purchases_Code",
        "DMBTR": "Amount_In_Local_Currency",
        "MENGE": "Quantity",
        "MATNR": "Material_Number",
        "LIFNR": "Account_Number_Of_Supplier",
    },
)
BALANCE_SPEC = balance.BalanceSpec(source="TSAP", system=system_code("dev", "TSAP"))

BALANCE_STN = balance.BalanceSpec(source="STN", system=system_code("dev", "STN"))

STAMP = f"CAST('{AS_OF}' AS timestamp)"


def published(fact, name: str):
    """A fact as a full load publishes it: the table a delta load starts from."""
    return SnapshotTable(fact.sparkSession, fresh_path(fact.sparkSession, name)).overwrite(fact).read()


# ---- change detection -------------------------------------------------------------

HEADER_HIT = "h.GJAHR = l.RYEAR AND h.BUKRS = l.RBUKRS AND h.BELNR = l.REFDOCNR"


def affected_sql(p: str) -> str:
    """Keys of ledger lines reached by a lookup change, over feeds named ``<p>feed``."""
    return f"""
      SELECT l.GL_SIRID FROM {p}ledger l JOIN {p}header h ON {HEADER_HIT}
        WHERE h.ingested_at >= {WM_SQL} AND h.BLART IN ('HC', 'HF') AND h.TCODE IN ('/DS1/HM_C_DAILY_T', 'FB08')
      UNION SELECT l.GL_SIRID FROM {p}ledger l JOIN {p}header h ON {HEADER_HIT}
        JOIN {p}movement m ON m.MBLNR = left(h.XBLNR, 10) AND m.ZEILE = right(h.XBLNR, 4)
        WHERE m.ingested_at >= {WM_SQL} AND m.MANDT = '110'
      UNION SELECT l.GL_SIRID FROM {p}ledger l JOIN {p}header h ON {HEADER_HIT}
        JOIN {p}movement m ON m.MBLNR = left(h.XBLNR, 10) AND m.ZEILE = right(h.XBLNR, 4)
        JOIN {p}second_quantity s ON s.MBLNR = m.MBLNR AND s.MJAHR = m.MJAHR AND s.ZEILE = m.ZEILE
        WHERE s.ingested_at >= {WM_SQL} AND s.MANDT = '110' AND s.MSEHI = 'L15'
      UNION SELECT l.GL_SIRID FROM {p}ledger l JOIN {p}quantity q ON q.GL_SIRID = l.GL_SIRID AND q.DOCCT = l.DOCCT
        WHERE q.ingested_at >= {WM_SQL} AND q.MANDT = '110'
      UNION SELECT l.GL_SIRID FROM {p}ledger l JOIN {p}contract c ON c.RLDNR = l.RLDNR AND c.RYEAR = l.RYEAR
        AND c.DOCNR = l.DOCNR AND c.DOCLN = l.DOCLN AND c.RBUKRS = l.RBUKRS AND c.DOCCT = l.DOCCT
        WHERE c.ingested_at >= {WM_SQL} AND c.MANDT = '110'"""


def feed_ctes(p: str, condition: str = "true") -> str:
    names = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")
    return ", ".join(f"{p}{n} AS {unified_sql(n, condition)}" for n in names)


@query(
    "affected_key_union",
    f"WITH {feed_ctes('n_')} {affected_sql('n_')} UNION SELECT GL_SIRID FROM n_ledger WHERE ingested_at >= {WM_SQL}",
)
def affected_key_union(spark, folder):
    return ledger_line.affected_ledger_keys(ledger_feeds(spark, folder).unified(), WATERMARK)


@query(
    "union_missing_columns",
    f"SELECT GL_SIRID, OPFLAG, RACCT, HSL FROM {unified_sql('ledger')} WHERE OPFLAG IS DISTINCT FROM 'D' UNION ALL "
    f"SELECT GL_SIRID, OPFLAG, NULL, NULL FROM {unified_sql('ledger')} WHERE OPFLAG = 'D'",
)
def union_missing_columns(spark, folder):
    lines = changes.unify_cdc_columns(feed(spark, folder, "ledger"))
    upserts, deletes = filters.split_changes(lines)
    return changes.append_tombstones(
        upserts.select("GL_SIRID", "OPFLAG", "RACCT", "HSL"), deletes.select("GL_SIRID", "OPFLAG")
    )


# ---- merge, delete, tombstone -----------------------------------------------------

MERGE_SQL = f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < {WM_SQL}),
s AS (
  SELECT * FROM orders WHERE o_orderdate >= {WM_SQL} UNION ALL
  SELECT o_orderkey, o_custkey + 1, o_orderstatus, o_totalprice * 2, o_orderdate, NULL
  FROM orders WHERE o_orderdate < {WM_SQL} AND o_orderpriority = '1-URGENT')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey END AS o_custkey,
  CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus WHEN s.o_orderkey IS NULL THEN t.o_orderstatus
    ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE {AS_OF_SQL} END AS o_orderdate,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""


@query("merge_upsert", MERGE_SQL)
def merge_upsert(spark, folder):
    orders = table(spark, folder, "orders")
    target = filters.before_watermark(orders, WATERMARK, "o_orderdate")
    altered = target.filter(F.col("o_orderpriority") == "1-URGENT").withColumns(
        {
            "o_custkey": F.col("o_custkey") + 1,
            "o_totalprice": F.col("o_totalprice") * 2,
            "o_orderpriority": F.lit(None).cast("string"),
        }
    )
    source = filters.since_watermark(orders, WATERMARK, "o_orderdate").unionByName(altered)
    spec = MergeSpec(
        keys=["o_orderkey"],
        update=["o_orderstatus", "o_totalprice", "o_orderpriority"],
        insert=["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
        stamp={"o_orderdate": f"'{AS_OF}'"},
    )
    return merge.merge_upsert(target, source, spec)


@query(
    "snapshot_merge",
    "SELECT o_orderkey, CASE WHEN o_custkey % 10 = 3 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, "
    "cast(year(o_orderdate) AS varchar) AS year FROM orders "
    "WHERE year(o_orderdate) <> 1997 AND NOT (year(o_orderdate) = 1998 AND o_orderstatus = 'O')",
)
def snapshot_merge(spark, folder):
    """A sliced table published without its last year; a merge changes some rows, adds that year, empties one slice."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "CAST(year(o_orderdate) AS string) AS year", "o_custkey", "o_orderstatus"
    )
    kept = ["o_orderkey", "o_totalprice", "year"]
    published = SnapshotTable(spark, fresh_path(spark, "orders-by-year"), ["year"])
    published.overwrite(orders.filter("year < '2001'").select(*kept))
    changed = orders.filter("year >= '2001' OR o_custkey % 10 = 3").withColumn(
        "o_totalprice", F.expr("CASE WHEN o_custkey % 10 = 3 THEN -o_totalprice ELSE o_totalprice END")
    )
    gone = orders.filter("year = '1997' OR year = '1998' AND o_orderstatus = 'O'").select("year", "o_orderkey")
    published.merge(changed.select(*kept), MergeSpec(keys=["year", "o_orderkey"]), deleted=gone)
    return published.read().select(*kept)


YEAR_OF = "cast(year(o_orderdate) AS varchar)"
#: Urgent orders of the second month of an odd year move to the slice of the year after; order 7 of ten goes.
MOVED = "o_orderpriority = '1-URGENT' AND year(o_orderdate) % 2 = 1 AND month(o_orderdate) = 2 AND year(o_orderdate) < 1996"
GONE = "year(o_orderdate) = 1997 AND o_orderkey % 10 = 7"


@query(
    "snapshot_merge_moves",
    f"""WITH o AS (SELECT *, {YEAR_OF} AS year, {MOVED} AS moved, {GONE} AS gone FROM orders),
    n AS (SELECT o_orderkey, CASE WHEN moved THEN cast(cast(year AS int) + 1 AS varchar) ELSE year END AS year,
      CASE WHEN moved THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM o WHERE NOT gone),
    t AS (SELECT year FROM o WHERE moved OR gone UNION SELECT cast(cast(year AS int) + 1 AS varchar) FROM o WHERE moved)
    SELECT year, count(*) AS orders, round(sum(o_totalprice), 2) AS total, year NOT IN (SELECT year FROM t) AS untouched FROM n GROUP BY year""",
)
def snapshot_merge_moves(spark, folder):
    """A merge by a key that does not hold the slice: rows change slice, others go, and other slices keep their files."""
    orders = table(spark, folder, "orders").withColumn("year", F.expr("CAST(year(o_orderdate) AS string)"))
    published = SnapshotTable(spark, fresh_path(spark, "orders-that-move"), ["year"])
    published.overwrite(orders.select("o_orderkey", "o_totalprice", "year"))
    before = published.read().select("_metadata.file_path").distinct().collect()
    moved = orders.filter(MOVED).selectExpr(
        "o_orderkey", "-o_totalprice AS o_totalprice", "CAST(CAST(year AS int) + 1 AS string) AS year"
    )
    published.merge(moved, MergeSpec(keys=["o_orderkey"]), deleted=orders.filter(GONE).select("o_orderkey"))
    rows = published.read().withColumn("known", F.col("_metadata.file_path").isin([r.file_path for r in before]))
    return rows.groupBy("year").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("known").alias("untouched")
    )


@query(
    "age_out_slices",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS total,
      strftime(o_orderdate, '%Y-%m') <> strftime({WM_SQL} - INTERVAL 24 MONTH, '%Y-%m') AS untouched
    FROM orders WHERE o_orderdate >= {WM_SQL} - INTERVAL 24 MONTH GROUP BY ALL""",
)
def age_out_slices(spark, folder):
    """Orders sliced by month: whole months before the window go by folder, the first month is cut, the rest stays."""
    orders = table(spark, folder, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    published = SnapshotTable(spark, fresh_path(spark, "orders-by-month"), ["month"])
    published.overwrite(orders.select("o_orderkey", "o_orderdate", "o_totalprice", "month"))
    before = published.read().select("_metadata.file_path").distinct().collect()
    first = spark.sql(f"SELECT add_months(DATE '{WATERMARK}', -24) AS day").first().day
    published.age_out("o_orderdate", first, first.strftime("%Y-%m"))
    rows = published.read().withColumn("known", F.col("_metadata.file_path").isin([r.file_path for r in before]))
    return rows.groupBy("month").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("known").alias("untouched")
    )


@query(
    "delete_by_keys",
    "SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')",
)
def delete_by_keys(spark, folder):
    gone = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P")
    gone = gone.select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.delete_by_keys(table(spark, folder, "lineitem"), gone, ["l_orderkey"])


@query(
    "tombstone_update",
    "SELECT o_orderkey, o_custkey, CASE WHEN gone THEN 'D' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN NOT gone THEN o_totalprice END AS o_totalprice, "
    f"CASE WHEN gone THEN {AS_OF_SQL} ELSE o_orderdate END AS o_orderdate, "
    "CASE WHEN NOT gone THEN o_orderpriority END AS o_orderpriority FROM (SELECT *, o_orderkey IN "
    "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 7) AS gone FROM orders)",
)
def tombstone_update(spark, folder):
    orders = table(spark, folder, "orders")
    gone = table(spark, folder, "lineitem").filter("l_returnflag = 'R' AND l_linenumber = 7")
    gone = gone.select(F.col("l_orderkey").alias("o_orderkey"))
    moment = {"o_orderdate": f"'{AS_OF}'"}
    return changes.tombstone_update(orders, gone, ["o_orderkey"], ["o_custkey"], moment, action="o_orderstatus")


# ---- accounting fact --------------------------------------------------------------


def _documents_sql(p: str) -> str:
    spec = ACCOUNTING_SPEC
    headers = ", ".join(f"h.{c} AS {n}" for c, n in (header_item.HEADER_KEYS | spec.headers).items() if n != "Client")
    items = ", ".join(f"i.{c} AS {n}" for c, n in spec.items.items())
    return (
        f"SELECT {headers}, i.BUZEI AS {header_item.LINE_KEY}, {items}, 'D80_' || h.MANDT AS Source_ID, "
        f"{AS_OF_SQL} AS Ingested_At FROM {p}document h LEFT JOIN {p}item i "
        "ON h.BUKRS = i.BUKRS AND h.BELNR = i.BELNR AND h.GJAHR = i.GJAHR"
    )


def _document_ctes(p: str, client: str = "280") -> str:
    return ", ".join(
        f"{p}{n} AS (SELECT * FROM {feed_sql(n)} WHERE MANDT = '{client}')" for n in ("document", "item")
    )


@query("header_item_fact", f"WITH {_document_ctes('n_')} {_documents_sql('n_')}")
def header_item_fact(spark, folder):
    return header_item.header_item_full(
        feed(spark, folder, "document"), feed(spark, folder, "item"), ACCOUNTING_SPEC, STAMP
    )


@query("header_item_fact_mapped", f"WITH {_document_ctes('n_')} {_documents_sql('n_')}")
def header_item_fact_mapped(spark, folder):
    """The same fact, its payload columns read from mapping files."""
    maps = {}
    for side in ("headers", "items"):
        path = fresh_path(spark, f"{side}-map")
        rows = list(getattr(ACCOUNTING_SPEC, side).items())
        spark.createDataFrame(rows, "input string, output string").write.option("header", True).csv(path)
        maps[side] = read_column_map(spark, path)
    spec = replace(ACCOUNTING_SPEC, **maps)
    return header_item.header_item_full(feed(spark, folder, "document"), feed(spark, folder, "item"), spec, STAMP)


@query("header_item_fact_delta", f"WITH {_document_ctes('n_')} {_documents_sql('n_')}")
def header_item_fact_delta(spark, folder):
    documents, items = feed(spark, folder, "document"), feed(spark, folder, "item")
    old = [filters.before_watermark(f, WATERMARK) for f in (documents, items)]
    target = published(header_item.header_item_full(*old, ACCOUNTING_SPEC, STAMP), "accounting")
    return header_item.header_item_delta(target, documents, items, ACCOUNTING_SPEC, WATERMARK, STAMP)


ACCOUNTING_TSAP = replace(ACCOUNTING_SPEC, source="TSAP", system=system_code("dev", "TSAP"))


@query("header_item_fact_tsap", f"WITH {_document_ctes('n_', '480')} {_documents_sql('n_')}".replace("D80_", "D81_"))
def header_item_fact_tsap(spark, folder):
    documents, items = feed(spark, folder, "document"), feed(spark, folder, "item")
    return header_item.header_item_full(documents, items, ACCOUNTING_TSAP, STAMP)


@query("header_item_tsap_delta", f"WITH {_document_ctes('n_', '480')} {_documents_sql('n_')}".replace("D80_", "D81_"))
def header_item_tsap_delta(spark, folder):
    documents, items = feed(spark, folder, "document"), feed(spark, folder, "item")
    old = [filters.before_watermark(f, WATERMARK) for f in (documents, items)]
    target = published(header_item.header_item_full(*old, ACCOUNTING_TSAP, STAMP), "accounting-tsap")
    return header_item.header_item_delta(target, documents, items, ACCOUNTING_TSAP, WATERMARK, STAMP)


# ---- balance fact -----------------------------------------------------------------


def _balance_sql(condition: str, client: str = "480", system: str = "D81") -> str:
    names = ", ".join(f"{c} AS {n}" for c, n in balance.INDEX_COLUMNS.items() if n not in ("Client", "ingested_at"))
    return (
        f"SELECT {names}, '{system}_' || RCLNT AS Source_ID, {AS_OF_SQL} AS Ingested_At "
        f"FROM {feed_sql('index')} WHERE RCLNT = '{client}' AND {condition}"
    )


@query("balance_fact", _balance_sql("true"))
def balance_fact(spark, folder):
    return balance.balance_full(feed(spark, folder, "index"), BALANCE_SPEC, STAMP)


_SAME_BALANCE = " AND ".join(f"a.{k} = b.{k}" for k in balance.MERGE_KEYS)


def _balance_delta_sql(*source: str) -> str:
    return (
        f"WITH s AS ({_balance_sql(f'ingested_at >= {WM_SQL}', *source)}), t AS ({_balance_sql(f'ingested_at < {WM_SQL}', *source)}), "
        f"d AS ({_balance_sql(f"""ingested_at >= {WM_SQL} AND LAST_ACTION_CD = 'D' """, *source)}), "
        f"m AS (SELECT * FROM s UNION ALL SELECT * FROM t a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE {_SAME_BALANCE})) "
        f"SELECT * FROM m a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE {_SAME_BALANCE})"
    )


def _balance_delta(spark, folder, spec):
    index = feed(spark, folder, "index")
    old = balance.balance_full(filters.before_watermark(index, WATERMARK), spec, STAMP)
    return balance.balance_delta(published(old, "balance"), index, index, spec, WATERMARK, STAMP)


@query("balance_fact_delta", _balance_delta_sql())
def balance_fact_delta(spark, folder):
    return _balance_delta(spark, folder, BALANCE_SPEC)


@query("balance_stn_delta", _balance_delta_sql("280", "D80"))
def balance_stn_delta(spark, folder):
    return _balance_delta(spark, folder, BALANCE_STN)


@query("balance_fact_stn", _balance_sql("true", "280", "D80"))
def balance_fact_stn(spark, folder):
    return balance.balance_full(feed(spark, folder, "index"), BALANCE_STN, STAMP)


# ---- ledger-line fact -------------------------------------------------------------


def _lines_sql(p: str, ledger: str, action: str) -> str:
    """Published lines of the ledger rows in ``ledger``, over feeds named ``<p>feed``."""
    def named(alias, columns):
        return ", ".join(f"{alias}.{c} AS {n}" for c, n in columns.items() if not n.startswith("_"))

    live = "OPFLAG IS DISTINCT FROM 'D'"
    return f"""
    SELECT DISTINCT {named('l', ledger_line.LEDGER_COLUMNS)}, {named('q', ledger_line.QUANTITY_COLUMNS)},
      {named('c', ledger_line.CONTRACT_COLUMNS)}, left(h.XBLNR, 10) AS CL_LT_Reference_Doc_No,
      right(h.XBLNR, 4) AS CL_RT_Reference_Doc_No, {named('m', ledger_line.MOVEMENT_COLUMNS)},
      s.ADQNT AS Add_Oil_Gas_Qty, q.VOL_QTY AS Volume_GAL, q.VOL_QTY AS Volume_BBL, {SWAP_SQL},
      CASE WHEN l.DRCRK = 'S' THEN s.ADQNT ELSE -s.ADQNT END AS MM_Volume_L15,
      l.RACCT || l.RFAREA AS CL_Account_No_Functional_Area,
      substring(CASE WHEN m.SHKZG <> l.DRCRK THEN m.MATNR ELSE m.UMMAT END, 10, 18) AS MM_Material_Key,
      substring(CASE WHEN m.SHKZG = l.DRCRK THEN m.MATNR ELSE m.UMMAT END, 10, 18) AS CL_Receiving_Issuing_Mat_Key,
      'GAL' AS CL_UOM_In_GAL, 'Local Currency' AS CL_Lcl_Currency, {LABEL_SQL.format(c='l.BWART')} AS CL_Mvmt_Type_Plus,
      substring(l.RPRCTR, 5, 10) AS CL_Profit_Center, '' AS CL_Mvmt_Group, substring(l.RACCT, 4, 10) AS CL_GL_Account_Key,
      substring(l.MATNR, 10, 18) AS Material_Key, {AS_OF_SQL} AS ingested_at, 'D94_' || l.RCLNT AS Source_ID,
      {action} AS OPFLAG
    FROM {ledger} l
    LEFT JOIN (SELECT * FROM {p}quantity WHERE MANDT = '110' AND {live}) q
      ON l.GL_SIRID = q.GL_SIRID AND l.DOCCT = q.DOCCT
    LEFT JOIN (SELECT * FROM {p}contract WHERE MANDT = '110' AND {live}) c ON l.RLDNR = c.RLDNR AND l.RYEAR = c.RYEAR
      AND l.DOCNR = c.DOCNR AND l.DOCLN = c.DOCLN AND l.RBUKRS = c.RBUKRS AND l.DOCCT = c.DOCCT
    LEFT JOIN (SELECT * FROM {p}header WHERE {live} AND BLART IN ('HC', 'HF')
      AND TCODE IN ('/DS1/HM_C_DAILY_T', 'FB08')) h ON {HEADER_HIT}
    LEFT JOIN (SELECT * FROM {p}movement WHERE MANDT = '110' AND {live}) m
      ON m.MBLNR = left(h.XBLNR, 10) AND m.ZEILE = right(h.XBLNR, 4)
    LEFT JOIN (SELECT * FROM {p}second_quantity WHERE MANDT = '110' AND MSEHI = 'L15' AND {live}) s
      ON s.MBLNR = m.MBLNR AND s.MJAHR = m.MJAHR AND s.ZEILE = m.ZEILE
    WHERE l.OPFLAG IS DISTINCT FROM 'D' AND l.RCLNT = '110' AND l.RACCT BETWEEN '0006000000' AND '0009999999'
      AND l.BUDAT >= DATE '{AS_OF}' - INTERVAL 24 MONTH AND l.RPRCTR IN (SELECT RPRCTR FROM {CONTROL_SQL})"""


def _tombstones_sql(ledger: str) -> str:
    values = {
        "Client": "RCLNT", ledger_line.KEY: "GL_SIRID", "Source_ID": "'D94_' || RCLNT", "OPFLAG": "'D'",
        "ingested_at": AS_OF_SQL,
    }
    columns = ", ".join(f"{values.get(n, 'NULL')} AS {n}" for n in ledger_line.PUBLISHED)
    return (
        f"SELECT DISTINCT {columns} FROM {ledger} WHERE OPFLAG = 'D' AND RCLNT = '110' "
        "AND RACCT BETWEEN '0006000000' AND '0009999999'"
    )


def _full_sql(p: str) -> str:
    return (
        f"SELECT * FROM ({_lines_sql(p, f'{p}ledger', 'l.OPFLAG')}) UNION ALL BY NAME "
        f"SELECT * FROM ({_tombstones_sql(f'{p}ledger')})"
    )


@query("ledger_line_fact", f"WITH {feed_ctes('n_')} {_full_sql('n_')}")
def ledger_line_fact(spark, folder):
    return ledger_line.ledger_line_full(ledger_feeds(spark, folder), LEDGER_SPEC)


def _delta_sql() -> str:
    """The full load of the delta's day; only the moment and the action tell which lines the delta touched."""
    fresh = f"(SELECT GL_SIRID FROM n_ledger WHERE ingested_at >= {WM_SQL})"
    touched = f"{ledger_line.KEY} IN (SELECT GL_SIRID FROM k)"
    old = f"TIMESTAMP '{WATERMARK}'"
    lines = f"""
      SELECT * REPLACE (CASE WHEN {touched} THEN ingested_at ELSE {old} END AS ingested_at,
        CASE WHEN {touched} AND {ledger_line.KEY} NOT IN {fresh} THEN 'U' ELSE OPFLAG END AS OPFLAG)
      FROM ({_lines_sql('n_', 'n_ledger', 'l.OPFLAG')})"""
    dead = f"""
      SELECT * REPLACE (CASE WHEN {ledger_line.KEY} IN {fresh} THEN ingested_at ELSE {old} END AS ingested_at)
      FROM ({_tombstones_sql('n_ledger')})"""
    return f"""
    WITH {feed_ctes('n_')}, k AS ({affected_sql('n_')} UNION SELECT GL_SIRID FROM {fresh})
    SELECT * FROM ({lines}) UNION ALL BY NAME SELECT * FROM ({dead})"""


@query("ledger_line_fact_delta", _delta_sql())
def ledger_line_fact_delta(spark, folder):
    feeds = ledger_feeds(spark, folder)
    names = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")
    old = replace(feeds, **{n: filters.before_watermark(getattr(feeds, n), WATERMARK) for n in names})
    target = published(ledger_line.ledger_line_full(old, EARLIER_SPEC), "ledger-line")
    return ledger_line.ledger_line_delta(target, feeds, LEDGER_SPEC, WATERMARK)


@query("ledger_line_published", _delta_sql())
def ledger_line_published(spark, folder):
    """The fact from end to end: a full load, then a delta load from the run log's watermark, both published by month."""
    feeds = ledger_feeds(spark, folder)
    names = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")
    old = replace(feeds, **{n: filters.before_watermark(getattr(feeds, n), WATERMARK) for n in names})
    runs = RunLogTable(spark, fresh_path(spark, "run-log"))
    lines = ledger_line.published_table(spark, fresh_path(spark, "ledger-lines"))
    for known, spec in ((old, EARLIER_SPEC), (feeds, LEDGER_SPEC)):
        run_fact(
            runs,
            lines,
            "ledger-lines",
            full=lambda t, known=known, spec=spec: ledger_line.publish_full(t, known, spec),
            delta=lambda t, mark, known=known, spec=spec: ledger_line.publish_delta(t, known, spec, mark),
            as_of=spec.as_of,
        )
    return lines.read().select(*ledger_line.PUBLISHED)


@query("ledger_line_streamed", _delta_sql())
def ledger_line_streamed(spark, folder):
    """A full load of what was known at the watermark; what came since arrives as six streams and is drained at once."""
    feeds = ledger_feeds(spark, folder)
    old = replace(feeds, **{n: filters.before_watermark(getattr(feeds, n), WATERMARK) for n in ledger_line.CAPTURED})
    lines = ledger_line.published_table(spark, fresh_path(spark, "streamed-lines"))
    ledger_line.publish_full(lines, old, EARLIER_SPEC)
    inbox = LedgerInbox(spark, fresh_path(spark, "inbox"))
    inbox.follow_all(ledger_streams(spark, folder).since(WATERMARK))
    inbox.drain(lines, feeds, LEDGER_SPEC)
    return lines.read().select(*ledger_line.PUBLISHED)


def _views_sql() -> str:
    shown = {
        "accounting_stn": f"(WITH {_document_ctes('n_')} {_documents_sql('n_')})",
        "accounting_tsap": f"(WITH {_document_ctes('n_', '480')} {_documents_sql('n_')})".replace("D80_", "D81_"),
        "balance_stn": f"({_balance_sql('true', '280', 'D80')})",
        "balance_tsap": f"({_balance_sql('true')})",
    }
    each = "SELECT '{}' AS view_name, Source_ID, count(*) AS n, count(DISTINCT Fiscal_Year) AS years FROM {} GROUP BY Source_ID"
    return " UNION ALL ".join(each.format(name, rows) for name, rows in shown.items())


@query("reader_views_of_facts", _views_sql())
def reader_views_of_facts(spark, folder):
    """Four facts published, registered, and read through views whose column lists come from one file."""
    documents, items, index = (feed(spark, folder, n) for n in ("document", "item", "index"))
    facts = {
        "accounting_stn": header_item.header_item_full(documents, items, ACCOUNTING_SPEC, STAMP),
        "accounting_tsap": header_item.header_item_full(documents, items, ACCOUNTING_TSAP, STAMP),
        "balance_stn": balance.balance_full(index, BALANCE_STN, STAMP),
        "balance_tsap": balance.balance_full(index, BALANCE_SPEC, STAMP),
    }
    lists = []
    for name, fact in facts.items():
        path = fresh_path(spark, name)
        registered = path.rsplit("/", 1)[1].replace("-", "_")
        register_table(spark, registered, SnapshotTable(spark, path).overwrite(fact).current_path())
        lists += [(f"vw_{registered}", registered, i, c) for i, c in enumerate(fact.columns)]
    path = fresh_path(spark, "view-columns")
    spark.createDataFrame(lists, "view string, table string, position int, column string").write.option("header", True).csv(path)
    views = reader_views(spark, read_view_columns(spark, path))
    counted = [
        views[view].groupBy("Source_ID").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Fiscal_Year").alias("years")).withColumn("view_name", F.lit(name))
        for name in facts
        for view in views
        if view.startswith(f"vw_{name}_")
    ]
    return reduce(DataFrame.unionByName, counted)
