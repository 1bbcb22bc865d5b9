"""Run log, sinks, catalogue, data quality and metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import metadata, quality, runlog
from factloom.operators.evolve import union_widened
from factloom.sources.catalog import catalog_inventory, grouped_sets, reader_view, register_table
from factloom.sources.files import read_csv_lookup, read_value_json
from factloom.sources.snapshot import SnapshotTable, overwrite_slices
from factloom.sources.suite_counts import StoredSuite
from factloom.spec import MergeSpec
from workload.bindings import AS_OF, column_metadata, run_log, table
from workload.registry import AS_OF_SQL, fresh_path, query

# ---- run log ----------------------------------------------------------------------

LOG_SQL = (
    "(SELECT event_id AS run_id, event_type AS process_name, 'workflow-' || cast(user_id AS varchar) AS workflow, "
    "ts AS run_start, ts AS run_update, "
    "CASE WHEN event_type = 'purchase' THEN 'completed' ELSE 'started' END AS status FROM events)"
)


@query(
    "run_log_renumber",
    "SELECT * EXCLUDE (run_id), row_number() OVER (PARTITION BY workflow ORDER BY run_start, run_id) AS run_id "
    f"FROM {LOG_SQL}",
)
def run_log_renumber(spark, folder):
    return runlog.renumber_runs(run_log(spark, folder))


@query(
    "run_log_end",
    f"SELECT run_id, process_name, workflow, run_start, CASE WHEN last THEN {AS_OF_SQL} ELSE run_update END AS run_update, "
    "CASE WHEN last THEN 'completed' ELSE status END AS status FROM "
    f"(SELECT *, run_id = max(run_id) OVER (PARTITION BY workflow) AS last FROM {LOG_SQL})",
)
def run_log_end(spark, folder):
    return runlog.run_log_end(run_log(spark, folder), AS_OF)


@query(
    "watermark_lookup",
    f"SELECT workflow, arg_max(run_start, run_id) AS watermark FROM {LOG_SQL} WHERE status = 'completed' GROUP BY workflow",
)
def watermark_lookup(spark, folder):
    return runlog.latest_completed(run_log(spark, folder))


LOOP_SQL = f"(SELECT * FROM {LOG_SQL} WHERE workflow = (SELECT min(workflow) FROM {LOG_SQL}))"


@query(
    "run_log_loop",
    f"WITH s AS (SELECT * FROM {LOOP_SQL} UNION ALL SELECT NULL, 'delta', min(workflow), TIMESTAMP '{AS_OF}', "
    f"TIMESTAMP '{AS_OF}', 'started' FROM {LOOP_SQL}), "
    "n AS (SELECT * REPLACE (row_number() OVER (ORDER BY run_start, run_id NULLS LAST) AS run_id) FROM s), "
    "e AS (SELECT * REPLACE (CASE WHEN run_id = (SELECT max(run_id) FROM n) THEN 'completed' ELSE status END AS status) FROM n) "
    "SELECT run_id, process_name, workflow, run_start, status, "
    "(SELECT arg_max(run_start, run_id) FROM e WHERE status = 'completed') AS watermark FROM e",
)
def run_log_loop(spark, folder):
    """One workflow: a run is started and numbered, it ends, and the next delta's watermark is read."""
    log = run_log(spark, folder)
    first = log.agg(F.min("workflow")).first()[0]
    started = runlog.run_log_start(log, first, "project", 1, "delta", 1, AS_OF)
    ended = runlog.run_log_end(started, AS_OF, first)
    mark = runlog.watermark_lookup(ended, first)
    return ended.join(F.broadcast(mark)).select("run_id", "process_name", "workflow", "run_start", "status", "watermark")


@query(
    "watermark_of_workflow",
    f"SELECT coalesce(arg_max(run_start, run_id) FILTER (status = 'completed'), TIMESTAMP '0001-01-01') AS watermark FROM {LOOP_SQL}",
)
def watermark_of_workflow(spark, folder):
    log = run_log(spark, folder)
    return runlog.watermark_lookup(log, log.agg(F.min("workflow")).first()[0])


# ---- sinks and catalogue ----------------------------------------------------------


@query(
    "full_load_roundtrip",
    "SELECT c_custkey, c_name, c_mktsegment, cast(NULL AS double) AS c_acctbal FROM customer",
)
def full_load_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    published = SnapshotTable(spark, fresh_path(spark, "customer"))
    published.overwrite(customers.select("c_custkey", "c_name", "c_acctbal"))
    published.overwrite_evolving(customers.select("c_custkey", "c_name", "c_mktsegment"))
    return published.read()


@query(
    "type_evolution",
    "SELECT c_custkey::BIGINT AS c_custkey, round(c_acctbal, 2)::DECIMAL(14, 4) AS c_acctbal, TIMESTAMP '2001-12-31' AS since, "
    "c_name, NULL AS c_mktsegment FROM customer UNION ALL "
    "SELECT c_custkey::BIGINT, round(c_acctbal, 1)::DECIMAL(14, 4), TIMESTAMP '2001-12-31 06:30:00', NULL, c_mktsegment FROM customer",
)
def type_evolution(spark, folder):
    """Two versions whose columns differ in type, read together in types that hold both."""
    customers = table(spark, folder, "customer")
    published = SnapshotTable(spark, fresh_path(spark, "customer-types"))
    published.overwrite(
        customers.selectExpr(
            "CAST(c_custkey AS int) AS c_custkey", "CAST(round(c_acctbal, 2) AS decimal(12, 2)) AS c_acctbal",
            f"DATE '{AS_OF}' AS since", "c_name",
        )
    )
    published.overwrite_evolving(
        customers.selectExpr(
            "c_custkey", "CAST(round(c_acctbal, 1) AS decimal(10, 4)) AS c_acctbal",
            f"TIMESTAMP '{AS_OF} 06:30:00' AS since", "c_mktsegment",
        )
    )
    return union_widened(published.read_version(1), published.read())


@query(
    "compact_undersized",
    "SELECT cast(year(o_orderdate) AS varchar) AS year, count(*) AS orders, round(sum(o_totalprice), 2) AS total, "
    "true AS fewer_files, 1 AS files, 0 AS changed_again FROM orders GROUP BY ALL",
)
def compact_undersized(spark, folder):
    """A table in many small files: they are packed to one a slice; a second run changes nothing."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "o_totalprice", "CAST(year(o_orderdate) AS string) AS year")
    path = fresh_path(spark, "orders-in-pieces")
    published = SnapshotTable(spark, path, ["year"])
    orders.repartition(4).write.partitionBy("year").parquet(f"{path}/version-00000001")
    before, after = published.compact_small(1 << 40)
    counted = published.read().select("year", "_metadata.file_path").groupBy("year").agg(F.countDistinct("file_path").alias("files"))
    again = abs(after - published.compact_small(1 << 40)[1])
    sums = published.read().groupBy("year").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.join(counted, "year").select(
        "year", "orders", "total", F.lit(before > after).alias("fewer_files"), F.col("files").cast("int").alias("files"),
        F.lit(again).alias("changed_again"),
    )


@query(
    "slice_overwrite",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END "
    "AS o_totalprice FROM orders",
)
def slice_overwrite(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = fresh_path(spark, "orders-by-status")
    overwrite_slices(orders, path, ["o_orderstatus"])
    slice_f = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    overwrite_slices(slice_f, path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path)


def _publish_orders(spark, folder, name: str) -> str:
    snapshot = SnapshotTable(spark, fresh_path(spark, name))
    snapshot.overwrite(table(spark, folder, "orders"))
    table_name = snapshot.path.rsplit("/", 1)[1].replace("-", "_")
    register_table(spark, table_name, snapshot.current_path())
    return table_name


@query(
    "register_table",
    "SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS latest FROM orders GROUP BY o_orderstatus",
)
def register_table_query(spark, folder):
    published = spark.table(_publish_orders(spark, folder, "registered"))
    return published.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest"))


@query(
    "register_after_reload",
    "SELECT o_orderkey, o_orderdate, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def register_after_reload(spark, folder):
    """A table registered, loaded anew with other rows, registered again, vacuumed, and read through its view."""
    snapshot = SnapshotTable(spark, fresh_path(spark, "reloaded"), ["o_orderstatus"])
    columns = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    orders = table(spark, folder, "orders").select(*columns)
    name = snapshot.path.rsplit("/", 1)[1].replace("-", "_")
    snapshot.overwrite(orders)
    register_table(spark, name, snapshot.current_path(), partitioned=True)
    reader_view(spark, f"vw_{name}", name, columns)
    changed = orders.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    snapshot.overwrite(changed)
    register_table(spark, name, snapshot.current_path(), partitioned=True)
    snapshot.vacuum(retain_hours=0, registered=[name])
    return spark.table(f"vw_{name}")


@query("reader_view", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def reader_view_query(spark, folder):
    published = _publish_orders(spark, folder, "viewed")
    return reader_view(spark, f"vw_{published}", published, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("compact_table", "SELECT * FROM lineitem")
def compact_table(spark, folder):
    published = SnapshotTable(spark, fresh_path(spark, "lineitem"))
    published.overwrite(table(spark, folder, "lineitem").repartition(32))
    published.compact()
    published.vacuum(retain_hours=0)
    return published.read()


INVENTORY = {
    "master": ("region", "nation", "customer", "supplier", "part"),
    "transactions": ("orders", "lineitem", "events"),
}


@query(
    "table_inventory",
    "SELECT schema_name, string_agg(DISTINCT table_name, ',' ORDER BY table_name) AS tables, "
    "cast(sum(rows) AS bigint) AS rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, count(*) AS rows FROM {t}" for s, ts in INVENTORY.items() for t in ts
    )
    + ") WHERE rows > 0 GROUP BY schema_name",
)
def table_inventory(spark, folder):
    counted = [
        table(spark, folder, t).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "rows")
        for s, ts in INVENTORY.items()
        for t in ts
    ]
    filled = reduce(DataFrame.unionByName, counted).filter(F.col("rows") > 0)
    names = grouped_sets(filled, ["schema_name"], "table_name", "tables")
    sizes = filled.groupBy("schema_name").agg(F.sum("rows").alias("rows"))
    return names.join(sizes, "schema_name").select("schema_name", F.array_join("tables", ",").alias("tables"), "rows")


@query(
    "catalog_inventory",
    "SELECT 'registered' AS kind, unnest(['customer', 'nation', 'orders']) AS table_name, "
    "unnest([(SELECT count(*) FROM customer), (SELECT count(*) FROM nation), (SELECT count(*) FROM orders)]) AS rows",
)
def catalog_inventory_query(spark, folder):
    """Given tables registered in a schema of their own, found by the inventory, and counted through the catalogue."""
    schema = fresh_path(spark, "inventory").rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name in ("customer", "nation", "orders"):
        register_table(spark, f"{schema}.{name}", f"{folder}/{name}.parquet")
    found = catalog_inventory(spark, [schema]).first().tables
    counted = [
        spark.table(f"{schema}.{t}").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit("registered").alias("kind"), F.lit(t).alias("table_name"), "rows")
        for t in found
    ]
    return reduce(DataFrame.unionByName, counted)


# ---- lookup files -----------------------------------------------------------------


@query(
    "json_value_explode",
    "SELECT cast(o_orderkey AS varchar) AS id, 'status' AS name, o_orderstatus AS type FROM orders UNION ALL "
    "SELECT cast(o_orderkey AS varchar), 'priority', o_orderpriority FROM orders",
)
def json_value_explode(spark, folder):
    key = F.col("o_orderkey").cast("string").alias("id")
    parts = F.array(
        F.struct(key, F.lit("status").alias("name"), F.col("o_orderstatus").alias("type")),
        F.struct(key, F.lit("priority").alias("name"), F.col("o_orderpriority").alias("type")),
    )
    path = fresh_path(spark, "orders-json")
    table(spark, folder, "orders").select(parts.alias("value")).write.json(path)
    return read_value_json(spark, path, "id string, name string, type string".replace(" string", ":string"))


@query(
    "csv_lookup",
    "SELECT c_custkey, n_name AS harmonised FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def csv_lookup(spark, folder):
    path = fresh_path(spark, "nation-csv")
    table(spark, folder, "nation").select("n_nationkey", "n_name").write.option("header", True).csv(path)
    mapping = read_csv_lookup(spark, path, "n_nationkey int, n_name string")
    joined = table(spark, folder, "customer").join(mapping, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", F.col("n_name").alias("harmonised"))


# ---- data quality -----------------------------------------------------------------

LABELLED_SQL = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def check_sql(no: int, kind: str, column: str, mostly: float, source: str, counted: str, holds: str) -> str:
    """One result row of a check."""
    return (
        f"SELECT cast({no} AS bigint) AS check_no, '{kind}' AS check_name, '{column}' AS column_name, "
        f"cast({mostly} AS double) AS mostly, n AS element_count, n - g AS unexpected_count, "
        "CASE WHEN n > 0 THEN cast(g AS double) / n * 100 END AS success_percent, "
        f"coalesce(CASE WHEN n > 0 THEN cast(g AS double) / n END >= {mostly}, true) AS success "
        f"FROM (SELECT count(*) FILTER ({counted}) AS n, count(*) FILTER ({counted} AND {holds}) AS g FROM {source})"
    )


def labelled(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


@query("dq_not_null", check_sql(1, "not_null", "quality", 0.3, LABELLED_SQL, "true", "quality IS NOT NULL"))
def dq_not_null(spark, folder):
    return quality.run_checks(labelled(spark, folder), quality.not_null_checks([("quality", {"mostly": 0.3})]))


@query("dq_in_set", check_sql(1, "in_set", "quality", 0.5, LABELLED_SQL, "quality IS NOT NULL", "quality IN (1)"))
def dq_in_set(spark, folder):
    return quality.run_checks(labelled(spark, folder), quality.in_set_checks([("quality", {"value_set": [1], "mostly": 0.5})]))


HAS_TAG_SQL = "contains(props, '\"k\":') AND NOT contains(props, '\"k\":\"\"')"


@query("dq_has_tag", check_sql(1, "has_tag", "props", 1.0, "events", "true", HAS_TAG_SQL))
def dq_has_tag(spark, folder):
    return quality.run_checks(table(spark, folder, "events"), quality.tag_checks([("props", {})], tag="k"))


@query(
    "dq_unique_columns",
    "SELECT 'unique_columns' AS check_name, cast(8 AS bigint) AS column_count, 'doc_id' AS repeated_columns, "
    "count(*) AS element_count, false AS success FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def dq_unique_columns(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.unique_columns_check(documents.join(labels, documents.doc_id == labels.doc_id, "left"))


DOCUMENT_SUITE = [
    *quality.not_null_checks([("doc_id", {}), ("quality", {"mostly": 0.3}), ("text", {"mostly": 0.98})]),
    *quality.in_set_checks([("lang", {"value_set": ["en", "fr"]}), ("toxic", {"value_set": [0], "mostly": 0.9})]),
]

SUITE_SQL = " UNION ALL ".join(
    [
        check_sql(1, "not_null", "doc_id", 1.0, LABELLED_SQL, "true", "doc_id IS NOT NULL"),
        check_sql(2, "not_null", "quality", 0.3, LABELLED_SQL, "true", "quality IS NOT NULL"),
        check_sql(3, "not_null", "text", 0.98, LABELLED_SQL, "true", "text IS NOT NULL"),
        check_sql(4, "in_set", "lang", 1.0, LABELLED_SQL, "lang IS NOT NULL", "lang IN ('en', 'fr')"),
        check_sql(5, "in_set", "toxic", 0.9, LABELLED_SQL, "toxic IS NOT NULL", "toxic IN (0)"),
    ]
)


@query("dq_suite", SUITE_SQL)
def dq_suite(spark, folder):
    return quality.run_checks(labelled(spark, folder), DOCUMENT_SUITE)


@query(
    "dq_suite_verdict",
    "SELECT count(*) AS checks, count(*) FILTER (success) AS succeeded, "
    "cast(count(*) FILTER (success) AS double) * 100 / count(*) AS success_percent, "
    f"bool_and(success) OR cast(count(*) FILTER (success) AS double) * 100 / count(*) >= 60 AS passed FROM ({SUITE_SQL})",
)
def dq_suite_verdict(spark, folder):
    return quality.suite_verdict(quality.run_checks(labelled(spark, folder), DOCUMENT_SUITE), 60)


# Given tables in the columns that each standard suite looks at.
SUITE_TABLES = {
    "resources": ("part", {"id": "p_partkey", "location": "case when p_size > 2 then 'westeurope' end", "sku": "nullif(p_brand, 'Brand#1')", "tags": "case when p_size > 15 then p_type end"}),
    "resource_groups": ("supplier", {"id": "s_suppkey", "location": "case when s_nationkey > 5 then 'eastasia' else 'elsewhere' end", "type": "s_name", "tags": "case when s_acctbal > 0 then s_name end"}),
    "subscriptions": ("customer", {"id": "c_custkey", "subscriptionId": "c_name", "tags": "nullif(c_mktsegment, 'BUILDING')", "location": "'northeurope'", "state": "case when c_acctbal > 0 then 'Enabled' else 'Warned' end"}),
    "cost_management": ("orders", {"id": "o_orderkey", "name": "o_orderpriority", "sku": "nullif(o_orderstatus, 'F')", "properties": "o_orderdate", "type": "'Microsoft.CostManagement/query'"}),
}


def _standard_sql() -> str:
    rows = []
    for suite, (source, columns) in SUITE_TABLES.items():
        shaped = f"(SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})"
        for no, check in enumerate(quality.STANDARD_SUITES[suite], 1):
            values = ", ".join(f"'{v}'" for v in check.values)
            holds = f"{check.column} IS NOT NULL" if check.kind == quality.NOT_NULL else f"{check.column} IN ({values})"
            counted = "true" if check.kind == quality.NOT_NULL else f"{check.column} IS NOT NULL"
            rows.append(f"SELECT '{suite}' AS suite, * FROM ({check_sql(no, check.kind, check.column, check.mostly, shaped, counted, holds)})")
    return " UNION ALL ".join(rows)


@query("dq_standard_suites", _standard_sql())
def dq_standard_suites(spark, folder):
    results = []
    for suite, (source, columns) in SUITE_TABLES.items():
        shaped = table(spark, folder, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        results.append(quality.run_checks(shaped, quality.STANDARD_SUITES[suite]).withColumn("suite", F.lit(suite)))
    return reduce(DataFrame.unionByName, results)


MERGED_ORDERS = (
    "(SELECT o_orderkey, o_orderstatus, CASE WHEN year(o_orderdate) = 1996 AND o_custkey % 3 = 0 THEN NULL ELSE o_orderpriority END "
    "AS o_orderpriority, cast(year(o_orderdate) AS varchar) AS year FROM orders)"
)
ORDER_SUITE = [
    *quality.not_null_checks([("o_orderkey", {}), ("o_orderpriority", {"mostly": 0.99})]),
    *quality.in_set_checks([("o_orderstatus", {"value_set": ["F", "O"], "mostly": 0.9})]),
]


def _merged_suite_sql() -> str:
    rows = []
    for no, check in enumerate(ORDER_SUITE, 1):
        values = ", ".join(f"'{v}'" for v in check.values)
        null = f"{check.column} IS NOT NULL"
        is_set = check.kind == quality.IN_SET
        rows.append(
            check_sql(no, check.kind, check.column, check.mostly, MERGED_ORDERS, null if is_set else "true", f"{check.column} IN ({values})" if is_set else null)
        )
    return f"SELECT *, 1 AS folders_read FROM ({' UNION ALL '.join(rows)})"


@query("dq_suite_after_merge", _merged_suite_sql())
def dq_suite_after_merge(spark, folder):
    """A published table is checked; after a merge, only the touched slice is read for the suite over the whole."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "CAST(year(o_orderdate) AS string) AS year", "o_custkey"
    )
    path = fresh_path(spark, "orders-checked")
    published = SnapshotTable(spark, path, ["year"]).overwrite(orders.drop("o_custkey"))
    suite = StoredSuite(published, f"{path}-counts", ORDER_SUITE)
    suite.refresh()
    changed = orders.filter("year = '1996' AND o_custkey % 3 = 0").drop("o_custkey")
    published.merge(changed.withColumn("o_orderpriority", F.lit(None).cast("string")), MergeSpec(keys=["o_orderkey"]))
    read = suite.refresh()
    return suite.results().withColumn("folders_read", F.lit(len(read)))


# ---- metadata ---------------------------------------------------------------------


@query(
    "map_flatten",
    "SELECT p_partkey, p_brand AS brand, p_type AS kind, cast(NULL AS varchar) AS size FROM part UNION ALL "
    "SELECT p_partkey, NULL, NULL, cast(p_size AS varchar) FROM part",
)
def map_flatten(spark, folder):
    maps = F.array(
        F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("kind"), F.col("p_type")),
        F.create_map(F.lit("size"), F.col("p_size").cast("string")),
    )
    return metadata.map_flatten(table(spark, folder, "part").select("p_partkey", maps.alias("column")), "column")


@query(
    "metadata_select_exprs",
    "SELECT p_partkey AS key, 'col_' || cast(p_partkey AS varchar) || ' as ' || "
    "CASE WHEN p_size > 10 THEN p_name ELSE 'col_' || cast(p_partkey AS varchar) END AS select_expr "
    "FROM part WHERE p_size <= 40",
)
def metadata_select_exprs(spark, folder):
    rows = column_metadata(spark, folder).withColumn("key", F.expr("cast(substring(ColumnDisplayName, 5) as bigint)"))
    return metadata.select_exprs(metadata.column_schema(rows, keep=["key"]), keep=["key"])


def _initcap_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: upper(left(w, 1)) || lower(substring(w, 2))), ' ')"
    )


TAGS_SQL = (
    "(SELECT DISTINCT 'col_' || cast(p_partkey AS varchar) AS ColumnDisplayName, "
    "concat_ws(',', 'col_' || cast(p_partkey AS varchar) || '.ColumnDescription:' || "
    + _initcap_sql("p_name || ' ' || lower(p_type)")
    + ", CASE WHEN p_size > 25 THEN 'col_' || cast(p_partkey AS varchar) || '.ColumnDataConfidentiality:' || "
    + _initcap_sql("p_brand")
    + " END) AS tags FROM part)"
)


@query("metadata_tags", f"SELECT * FROM {TAGS_SQL}")
def metadata_tags(spark, folder):
    return metadata.metadata_tags(column_metadata(spark, folder))


@query(
    "metadata_tag_pairs",
    "SELECT string_split(tag, ':')[1] AS name, string_split(tag, ':')[2] AS value "
    f"FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM {TAGS_SQL})",
)
def metadata_tag_pairs(spark, folder):
    return metadata.tag_pairs(metadata.metadata_tags(column_metadata(spark, folder)))
