"""Scans, projections, filters, joins, aggregates and scalar derivations."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import (
    left_chars,
    movement_label,
    opposite_side,
    own_side,
    right_chars,
    signed_quantity,
    source_id,
)
from factloom.operators import changes, filters, joins, keys, project
from factloom.operators.runlog import latest_completed
from factloom.plans import ledger_line
from factloom.sources.catalog import grouped_sets
from factloom.sources.tables import scan_with_prefix
from factloom.spec import Lookup
from workload.bindings import AS_OF, WATERMARK, control, feed, run_log, table
from workload.registry import WM_SQL, feed_sql, query, unified_sql

CONTROL_SQL = (
    "(SELECT lpad(hex(s_suppkey), 10, '0') AS RPRCTR, s_name AS description FROM supplier "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey > 0)"
)


@query(
    "scan_prefix_rename",
    "SELECT o_orderkey, o_custkey, o_orderstatus AS HDR_o_orderstatus, o_totalprice, "
    "o_orderdate AS HDR_o_orderdate, o_orderpriority FROM orders",
)
def scan_prefix_rename(spark, folder):
    return scan_with_prefix(spark, f"{folder}/orders.parquet", "HDR", ["o_orderdate", "o_orderstatus"])


@query(
    "rename_projection",
    f"SELECT MANDT AS Client, BELNR AS Accounting_Document_Number, KURSF AS Exchange_Rate, BUDAT AS \"/POST/DATE\" "
    f"FROM {feed_sql('document')}",
)
def rename_projection(spark, folder):
    names = {"MANDT": "Client", "BELNR": "Accounting_Document_Number", "KURSF": "Exchange_Rate", "BUDAT": "/POST/DATE"}
    return project.rename_projection(feed(spark, folder, "document"), names)


@query(
    "account_range_filter",
    f"SELECT GL_SIRID, RCLNT, RACCT, HSL FROM {feed_sql('ledger')} "
    "WHERE RCLNT = '110' AND RACCT >= '0006000000' AND RACCT <= '0009999999'",
)
def account_range_filter(spark, folder):
    return filters.account_range_filter(feed(spark, folder, "ledger")).select("GL_SIRID", "RCLNT", "RACCT", "HSL")


@query("client_filter", f"SELECT MANDT, MBLNR, ZEILE FROM {feed_sql('movement')} WHERE MANDT = '110'")
def client_filter(spark, folder):
    return filters.client_filter(feed(spark, folder, "movement")).select("MANDT", "MBLNR", "ZEILE")


@query(
    "doc_type_filter",
    f"SELECT BUKRS, BELNR, GJAHR, BLART, TCODE FROM {feed_sql('header')} "
    "WHERE BLART IN ('HC', 'HF') AND TCODE IN ('/DS1/HM_C_DAILY_T', 'FB08')",
)
def doc_type_filter(spark, folder):
    return filters.doc_type_filter(feed(spark, folder, "header")).select("BUKRS", "BELNR", "GJAHR", "BLART", "TCODE")


@query(
    "unit_filter",
    f"SELECT MBLNR, ZEILE, MSEHI, ADQNT FROM {feed_sql('second_quantity')} WHERE MANDT = '110' AND MSEHI = 'L15'",
)
def unit_filter(spark, folder):
    return filters.unit_filter(feed(spark, folder, "second_quantity")).select("MBLNR", "ZEILE", "MSEHI", "ADQNT")


@query(
    "source_system_filter",
    f"SELECT 'STN' AS source, MANDT AS Client, BELNR FROM {feed_sql('document')} WHERE MANDT = '280' UNION ALL "
    f"SELECT 'TSAP', MANDT, BELNR FROM {feed_sql('document')} WHERE MANDT = '480' UNION ALL "
    f"SELECT 'other', MANDT, BELNR FROM {feed_sql('document')}",
)
def source_system_filter(spark, folder):
    rows = feed(spark, folder, "document").select(F.col("MANDT").alias("Client"), "BELNR")
    parts = [
        filters.source_system_filter(rows, source).select(F.lit(source).alias("source"), "Client", "BELNR")
        for source in ("STN", "TSAP", "other")
    ]
    return keys.union_all_by_name(*parts)


@query(
    "watermark_filter",
    "SELECT event_id, ts, user_id FROM events WHERE ts >= (SELECT min(started) FROM "
    "(SELECT arg_max(ts, event_id) AS started FROM events WHERE event_type = 'purchase' GROUP BY user_id))",
)
def watermark_filter(spark, folder):
    since = latest_completed(run_log(spark, folder)).agg(F.min("watermark"))
    return filters.since_watermark(table(spark, folder, "events"), since, "ts").select("event_id", "ts", "user_id")


@query(
    "split_change_feed",
    f"SELECT GL_SIRID, CASE WHEN OPFLAG IS NOT DISTINCT FROM 'D' THEN 'delete' ELSE 'upsert' END AS part "
    f"FROM {unified_sql('ledger')}",
)
def split_change_feed(spark, folder):
    upserts, deletes = filters.split_changes(changes.unify_cdc_columns(feed(spark, folder, "ledger")))
    return keys.union_all_by_name(
        upserts.select("GL_SIRID", F.lit("upsert").alias("part")),
        deletes.select("GL_SIRID", F.lit("delete").alias("part")),
    )


@query(
    "trailing_months_filter",
    f"SELECT GL_SIRID, BUDAT FROM {feed_sql('ledger')} WHERE BUDAT >= DATE '{AS_OF}' - INTERVAL 24 MONTH",
)
def trailing_months_filter(spark, folder):
    return filters.trailing_months_filter(feed(spark, folder, "ledger"), AS_OF).select("GL_SIRID", "BUDAT")


@query("latest_batch", "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_batch(spark, folder):
    return filters.latest_batch(table(spark, folder, "orders"), "o_orderdate")


@query(
    "path_segment",
    "SELECT page_id, coalesce(string_split(url, '/')[4], '') AS lang, coalesce(string_split(url, '/')[9], '') AS yrmono "
    "FROM pages",
)
def path_segment(spark, folder):
    pages = table(spark, folder, "pages")
    pages = project.with_path_segment(pages, "lang", 4, "url")
    return project.with_path_segment(pages, path="url").select("page_id", "lang", "yrmono")


@query(
    "control_table_join",
    f"SELECT l.GL_SIRID, l.RPRCTR, c.description FROM {feed_sql('ledger')} l JOIN {CONTROL_SQL} c USING (RPRCTR)",
)
def control_table_join(spark, folder):
    lines = feed(spark, folder, "ledger").select("GL_SIRID", "RPRCTR")
    return joins.control_table_join(lines, control(spark, folder), ["RPRCTR"])


@query(
    "left_join_2key",
    f"SELECT l.GL_SIRID, l.DOCCT, q.WGT_QTY, q.VOL_QTY FROM {feed_sql('ledger')} l "
    f"LEFT JOIN (SELECT * FROM {feed_sql('quantity')} WHERE MANDT = '110') q "
    "ON l.GL_SIRID = q.GL_SIRID AND l.DOCCT = q.DOCCT",
)
def left_join_2key(spark, folder):
    lines = feed(spark, folder, "ledger").select("GL_SIRID", "DOCCT")
    extension = filters.client_filter(feed(spark, folder, "quantity"))
    same = {c: c for c in ("GL_SIRID", "DOCCT")}
    return joins.lookup_join(lines, Lookup(extension, same, {c: c for c in ("WGT_QTY", "VOL_QTY")}))


@query(
    "left_join_multikey",
    f"SELECT l.GL_SIRID, c.KONNR, c.ZXBLDAT, c.VOL_QTY_BB6 FROM {feed_sql('ledger')} l "
    f"LEFT JOIN (SELECT * FROM {feed_sql('contract')} WHERE MANDT = '110') c ON l.RLDNR = c.RLDNR AND l.RYEAR = c.RYEAR "
    "AND l.DOCNR = c.DOCNR AND l.DOCLN = c.DOCLN AND l.RBUKRS = c.RBUKRS AND l.DOCCT = c.DOCCT",
)
def left_join_multikey(spark, folder):
    on = ledger_line.CONTRACT_OF_LEDGER
    lines = feed(spark, folder, "ledger").select("GL_SIRID", *on)
    extension = filters.client_filter(feed(spark, folder, "contract"))
    added = {c: c for c in ("KONNR", "ZXBLDAT", "VOL_QTY_BB6")}
    return joins.lookup_join(lines, Lookup(extension, on, added)).select("GL_SIRID", *added)


@query(
    "derived_key_join",
    f"SELECT h.BELNR, left(h.XBLNR, 10) AS ref_left, right(h.XBLNR, 4) AS ref_right, m.MJAHR, m.MATNR, m.WERKS "
    f"FROM {feed_sql('header')} h LEFT JOIN {feed_sql('movement')} m "
    "ON left(h.XBLNR, 10) = m.MBLNR AND right(h.XBLNR, 4) = m.ZEILE",
)
def derived_key_join(spark, folder):
    headers = feed(spark, folder, "header").selectExpr(
        "BELNR", f"{left_chars('XBLNR', 10)} AS ref_left", f"{right_chars('XBLNR', 4)} AS ref_right"
    )
    added = {c: c for c in ("MJAHR", "MATNR", "WERKS")}
    step = Lookup(feed(spark, folder, "movement"), {"ref_left": "MBLNR", "ref_right": "ZEILE"}, added)
    return joins.lookup_join(headers, step, spread_by="BELNR")


@query(
    "changed_key_semi_join",
    f"SELECT BUKRS, BELNR, GJAHR, KURSF FROM {feed_sql('document')} WHERE (BUKRS, BELNR, GJAHR) IN "
    f"(SELECT BUKRS, BELNR, GJAHR FROM {feed_sql('item')} WHERE ingested_at >= {WM_SQL})",
)
def changed_key_semi_join(spark, folder):
    key = ["BUKRS", "BELNR", "GJAHR"]
    changed = keys.distinct_keys(filters.since_watermark(feed(spark, folder, "item"), WATERMARK), key)
    return keys.changed_key_semi_join(feed(spark, folder, "document"), changed, key).select(*key, "KURSF")


@query(
    "affected_keys_1hop",
    f"SELECT DISTINCT l.GL_SIRID FROM {feed_sql('ledger')} l WHERE EXISTS (SELECT 1 FROM {feed_sql('header')} h "
    f"WHERE h.ingested_at >= {WM_SQL} AND h.GJAHR = l.RYEAR AND h.BUKRS = l.RBUKRS AND h.BELNR = l.REFDOCNR)",
)
def affected_keys_1hop(spark, folder):
    changed = filters.since_watermark(feed(spark, folder, "header"), WATERMARK)
    return keys.keys_through(changed, [(feed(spark, folder, "ledger"), ledger_line.HEADER_OF_LEDGER)], ["GL_SIRID"])


HIT_HEADERS_SQL = (
    f"(SELECT BUKRS, BELNR, GJAHR FROM {feed_sql('header')} b WHERE EXISTS (SELECT 1 FROM {feed_sql('movement')} m "
    "WHERE {changed} AND m.MBLNR = left(b.XBLNR, 10) AND m.ZEILE = right(b.XBLNR, 4)))"
)
CHANGED_SECOND_SQL = (
    f"EXISTS (SELECT 1 FROM {feed_sql('second_quantity')} s WHERE s.ingested_at >= {WM_SQL} "
    "AND s.MBLNR = m.MBLNR AND s.MJAHR = m.MJAHR AND s.ZEILE = m.ZEILE)"
)


@query(
    "affected_keys_2hop",
    f"SELECT DISTINCT l.GL_SIRID FROM {feed_sql('ledger')} l JOIN "
    + HIT_HEADERS_SQL.format(changed=f"m.ingested_at >= {WM_SQL}")
    + " h ON h.GJAHR = l.RYEAR AND h.BUKRS = l.RBUKRS AND h.BELNR = l.REFDOCNR",
)
def affected_keys_2hop(spark, folder):
    changed = filters.since_watermark(feed(spark, folder, "movement"), WATERMARK)
    headers = ledger_line.reference_keys(feed(spark, folder, "header"))
    hops = [
        (headers, ledger_line.MOVEMENT_OF_HEADER),
        (feed(spark, folder, "ledger"), ledger_line.HEADER_OF_LEDGER),
    ]
    return keys.keys_through(changed, hops, ["GL_SIRID"])


@query(
    "affected_keys_3hop",
    f"SELECT DISTINCT l.GL_SIRID FROM {feed_sql('ledger')} l JOIN "
    + HIT_HEADERS_SQL.format(changed=CHANGED_SECOND_SQL)
    + " h ON h.GJAHR = l.RYEAR AND h.BUKRS = l.RBUKRS AND h.BELNR = l.REFDOCNR",
)
def affected_keys_3hop(spark, folder):
    changed = filters.since_watermark(feed(spark, folder, "second_quantity"), WATERMARK)
    headers = ledger_line.reference_keys(feed(spark, folder, "header"))
    hops = [
        (feed(spark, folder, "movement"), ledger_line.SECOND_OF_MOVEMENT),
        (headers, ledger_line.MOVEMENT_OF_HEADER),
        (feed(spark, folder, "ledger"), ledger_line.HEADER_OF_LEDGER),
    ]
    return keys.keys_through(changed, hops, ["GL_SIRID"])


@query("global_max", "SELECT max(event_id) AS max_run_id, max(ts) AS max_run_start FROM events")
def global_max(spark, folder):
    log = run_log(spark, folder)
    return log.agg(F.max("run_id").alias("max_run_id"), F.max("run_start").alias("max_run_start"))


@query(
    "group_collect_set",
    "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments "
    "FROM customer GROUP BY c_nationkey",
)
def group_collect_set(spark, folder):
    sets = grouped_sets(table(spark, folder, "customer"), ["c_nationkey"], "c_mktsegment", "segments")
    return sets.withColumn("segments", F.array_join("segments", ","))


@query("distinct_keys", f"SELECT DISTINCT BUKRS, BELNR, GJAHR FROM {feed_sql('item')}")
def distinct_keys(spark, folder):
    return keys.distinct_keys(feed(spark, folder, "item"), ["BUKRS", "BELNR", "GJAHR"])


@query(
    "union_by_name",
    "SELECT o_orderkey AS document, 'header' AS kind FROM orders UNION ALL "
    "SELECT l_orderkey, 'item' FROM lineitem",
)
def union_by_name(spark, folder):
    headers = table(spark, folder, "orders").select(F.col("o_orderkey").alias("document"), F.lit("header").alias("kind"))
    items = table(spark, folder, "lineitem").select(F.lit("item").alias("kind"), F.col("l_orderkey").alias("document"))
    return keys.union_all_by_name(headers, items)


@query(
    "string_slices",
    f"SELECT BELNR, left(XBLNR, 10) AS left10, right(XBLNR, 4) AS right4, substring(XBLNR, 10, 18) AS material_key, "
    f"substring(BELNR, 5, 10) AS profit_center, substring(BELNR, 4, 10) AS account_key FROM {feed_sql('header')}",
)
def string_slices(spark, folder):
    return feed(spark, folder, "header").selectExpr(
        "BELNR",
        f"{left_chars('XBLNR', 10)} AS left10",
        f"{right_chars('XBLNR', 4)} AS right4",
        "substring(XBLNR, 10, 18) AS material_key",
        "substring(BELNR, 5, 10) AS profit_center",
        "substring(BELNR, 4, 10) AS account_key",
    )


@query(
    "concat_keys",
    f"SELECT GL_SIRID, 'D94_' || RCLNT AS Source_ID, RACCT || RFAREA AS account_area, "
    f"concat_ws('-', RACCT, RFAREA, KUNNR) AS account_path FROM {feed_sql('ledger')}",
)
def concat_keys(spark, folder):
    return feed(spark, folder, "ledger").selectExpr(
        "GL_SIRID",
        f"{source_id('D94', 'RCLNT')} AS Source_ID",
        "concat(RACCT, RFAREA) AS account_area",
        "concat_ws('-', RACCT, RFAREA, KUNNR) AS account_path",
    )


SWAP_SQL = (
    "CASE WHEN m.SHKZG <> l.DRCRK THEN m.WERKS ELSE m.UMWRK END AS MM_Plant, "
    "CASE WHEN m.SHKZG = l.DRCRK THEN m.WERKS ELSE m.UMWRK END AS MM_Receiving_Plant, "
    "CASE WHEN m.SHKZG <> l.DRCRK THEN m.MATNR ELSE m.UMMAT END AS MM_Material, "
    "CASE WHEN m.SHKZG = l.DRCRK THEN m.MATNR ELSE m.UMMAT END AS MM_Receiving_Material"
)


@query(
    "debit_credit_swap",
    f"SELECT l.GL_SIRID, {SWAP_SQL} FROM {feed_sql('ledger')} l JOIN {feed_sql('movement')} m ON l.REFDOCNR = m.MBLNR",
)
def debit_credit_swap(spark, folder):
    lines = feed(spark, folder, "ledger").select("GL_SIRID", "DRCRK", "REFDOCNR")
    moves = feed(spark, folder, "movement").select("MBLNR", "SHKZG", "WERKS", "UMWRK", "MATNR", "UMMAT")
    both = lines.join(moves, F.col("REFDOCNR") == F.col("MBLNR"))
    plants, materials = ("SHKZG", "DRCRK", "WERKS", "UMWRK"), ("SHKZG", "DRCRK", "MATNR", "UMMAT")
    return both.selectExpr(
        "GL_SIRID",
        f"{own_side(*plants)} AS MM_Plant",
        f"{opposite_side(*plants)} AS MM_Receiving_Plant",
        f"{own_side(*materials)} AS MM_Material",
        f"{opposite_side(*materials)} AS MM_Receiving_Material",
    )


@query(
    "signed_quantity",
    f"SELECT GL_SIRID, CASE WHEN DRCRK = 'S' THEN HSL ELSE -HSL END AS signed FROM {feed_sql('ledger')}",
)
def signed_quantity_query(spark, folder):
    return feed(spark, folder, "ledger").selectExpr("GL_SIRID", f"{signed_quantity('DRCRK', 'HSL')} AS signed")


LABEL_SQL = (
    "CASE WHEN {c} IN ('551', '552') THEN 'Scrapping' WHEN {c} IN ('701', '702') THEN 'Warehouse Gains & losses' "
    "WHEN {c} IN ('951', '952') THEN 'InTransit Gains & losses' "
    "WHEN {c} IN ('Y51', 'Y52') THEN 'Tank Level Gains & losses' ELSE '' END"
)


@query(
    "movement_label",
    f"SELECT GL_SIRID, BWART, {LABEL_SQL.format(c='BWART')} AS label FROM {feed_sql('ledger')}",
)
def movement_label_query(spark, folder):
    return feed(spark, folder, "ledger").selectExpr("GL_SIRID", "BWART", f"{movement_label('BWART')} AS label")


@query(
    "effective_op",
    f"SELECT GL_SIRID, CASE WHEN ingested_at >= {WM_SQL} THEN OPFLAG ELSE 'U' END AS OPFLAG FROM {feed_sql('ledger')}",
)
def effective_op(spark, folder):
    lines = feed(spark, folder, "ledger").select("GL_SIRID", "OPFLAG", "ingested_at")
    return changes.with_effective_action(lines, WATERMARK).drop("ingested_at")


@query("unify_cdc_columns", f"SELECT GL_SIRID, AEDATTM, OPFLAG, ingested_at FROM {unified_sql('ledger')}")
def unify_cdc_columns(spark, folder):
    names = ("GL_SIRID", "LAST_DTM", "LAST_ACTION_CD", "AEDATTM", "OPFLAG", "ingested_at")
    return changes.unify_cdc_columns(feed(spark, folder, "ledger").select(*names))
