"""The given tables in the shape of the source feeds.

Orders play the document headers, movements and second quantities; line items play the
ledger rows, its extensions and the document items; suppliers play profit centres. Each
feed is a projection (no join, no aggregation), so filters and column pruning reach the
Parquet scans of the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.plans.ledger_line import CAPTURED, LedgerFeeds

# The moment of the run, and where the last completed run started.
AS_OF = "2001-12-31"
WATERMARK = "2001-06-15"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is looked up once, not by a job per use."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# What follows is SQL text that is valid, and means the same, in Spark and in the checking
# SQL. Document numbers are ten hexadecimal digits, so they stay distinct for 10^12 orders.
_DOC = "lpad(hex({key}), 10, '0')"
_YEAR = "concat('199', right(cast({key} as string), 1))"
_COMPANY = "right(hex({key}), 1)"
_MATERIAL = "substring(cast(1000000000000000000 + {key} as string), 2)"

# Several line items share order and line number; part and quantity (at most 50) tell them apart.
_LINE = "cast(l_partkey * 1000 + l_linenumber * 100 + cast(l_quantity as int) as string)"

LEDGER = {
    "RCLNT": "case when l_discount >= 0.095 then '180' else '110' end",
    "GL_SIRID": f"concat(cast(l_orderkey as string), '-', {_LINE})",
    "RLDNR": "l_returnflag",
    "RYEAR": _YEAR.format(key="l_orderkey"),
    "RTCUR": "case when l_linestatus = 'O' then 'EUR' else 'USD' end",
    "DRCRK": "case when l_linestatus = 'O' then 'S' else 'H' end",
    "POPER": "cast(month(l_shipdate) as string)",
    "DOCCT": "l_returnflag",
    "DOCNR": _DOC.format(key="l_orderkey"),
    "DOCLN": _LINE,
    "RBUKRS": _COMPANY.format(key="l_orderkey"),
    "RPRCTR": _DOC.format(key="l_suppkey"),
    "RFAREA": "case when l_linenumber = 7 then null else l_returnflag end",
    "RACCT": "substring(cast(10005500000 + cast(l_quantity as int) * 100000 as string), 2)",
    "SPRCTR": _DOC.format(key="l_suppkey"),
    "HSL": "l_extendedprice",
    "KSL": "l_extendedprice * 2",
    "BLDAT": "cast(l_shipdate as date)",
    "BUDAT": "cast(l_shipdate as date)",
    "REFDOCNR": _DOC.format(key="l_orderkey"),
    "REFRYEAR": _YEAR.format(key="l_orderkey"),
    "REFDOCLN": "cast(l_linenumber as string)",
    "REFDOCCT": "l_linestatus",
    "WERKS": "cast(l_suppkey as string)",
    "MATNR": _MATERIAL.format(key="l_partkey"),
    "KUNNR": "case when l_returnflag = 'R' then cast(l_suppkey as string) end",
    "LIFNR": "cast(l_suppkey as string)",
    "EBELN": _DOC.format(key="l_orderkey"),
    "KDAUF": _DOC.format(key="l_orderkey"),
    "VTWEG": "case when l_tax < 0.045 then '10' else '20' end",
    "SPART": "case when l_discount < 0.045 then '01' else '02' end",
    "BWART": "case l_linenumber when 1 then '551' when 2 then '552' when 3 then '701' when 4 then '702' "
    "when 5 then '951' when 6 then 'Y51' else '101' end",
    "BLART": "case when l_linestatus = 'O' then 'HC' else 'HF' end",
    "LAST_DTM": "case when l_linestatus = 'F' then l_shipdate end",
    "LAST_ACTION_CD": "case when l_linestatus = 'F' then case when l_returnflag = 'A' then 'C' else 'U' end end",
    "AEDATTM": "case when l_linestatus = 'O' then l_shipdate end",
    "OPFLAG": "case when l_linestatus = 'O' then case when l_returnflag = 'R' and l_linenumber = 7 then 'D' "
    "when l_returnflag = 'N' then 'I' else 'U' end end",
    "ingested_at": "l_shipdate",
}

_LINE_CHANGES = {
    "LAST_DTM": "case when l_linestatus = 'F' then l_shipdate end",
    "LAST_ACTION_CD": "case when l_linestatus = 'F' then 'C' end",
    "AEDATTM": "case when l_linestatus = 'O' then l_shipdate end",
    "OPFLAG": "case when l_linestatus = 'O' then case when l_linenumber = 6 then 'D' else 'U' end end",
    "ingested_at": "l_shipdate",
}

QUANTITY = {
    "MANDT": "case when l_tax >= 0.075 then '180' else '110' end",
    "DOCCT": LEDGER["DOCCT"],
    "GL_SIRID": LEDGER["GL_SIRID"],
    "UMWRK": "cast(l_partkey as string)",
    "OIC_MOT": "case when l_linenumber < 4 then '01' else '02' end",
    "WGT_QTY": "l_quantity",
    "VOL_UOM_L15": "case when l_linestatus = 'O' then 'L15' else 'M15' end",
    "VOL_QTY": "l_quantity * 2",
    **_LINE_CHANGES,
}

CONTRACT = {
    "MANDT": "case when l_tax < 0.005 then '180' else '110' end",
    "RYEAR": LEDGER["RYEAR"],
    "RBUKRS": LEDGER["RBUKRS"],
    "RLDNR": LEDGER["RLDNR"],
    "DOCCT": LEDGER["DOCCT"],
    "DOCNR": LEDGER["DOCNR"],
    "DOCLN": LEDGER["DOCLN"],
    "KONNR": "cast(l_suppkey as string)",
    "VGBEL": LEDGER["DOCNR"],
    "PARCEL_ID": "cast(l_partkey as string)",
    "ZSTI_REFNO": "l_returnflag",
    "DEALNO": "cast(l_linenumber as string)",
    "ZXBLDAT": "cast(l_shipdate as date)",
    "OID_EXTBOL": LEDGER["DOCNR"],
    "BGI_CARGOID": "cast(l_suppkey as string)",
    "BGI_DELIVERYID": "cast(l_partkey as string)",
    "BGI_PARCELID": "cast(l_linenumber as string)",
    "VOL_QTY_GAL": "l_quantity",
    "VOL_UOM_GAL": "l_linestatus",
    "VOL_QTY_BB6": "l_quantity * 3",
    "VOL_UOM_BB6": "l_returnflag",
    **_LINE_CHANGES,
}

_ORDER_CHANGES = {
    "LAST_DTM": "case when o_orderstatus = 'F' then o_orderdate end",
    "LAST_ACTION_CD": "case when o_orderstatus = 'F' then 'C' end",
    "AEDATTM": "case when o_orderstatus <> 'F' then o_orderdate end",
    "OPFLAG": "case when o_orderstatus <> 'F' then case when o_totalprice >= 450000 then 'D' else 'U' end end",
    "ingested_at": "o_orderdate",
}

HEADER = {
    "MANDT": "case o_orderstatus when 'F' then '280' when 'O' then '480' else '180' end",
    "BUKRS": _COMPANY.format(key="o_orderkey"),
    "BELNR": _DOC.format(key="o_orderkey"),
    "GJAHR": _YEAR.format(key="o_orderkey"),
    "BLART": "case left(o_orderpriority, 1) when '1' then 'HC' when '2' then 'HF' when '3' then 'HC' "
    "when '4' then 'HF' else 'RV' end",
    "TCODE": "case when o_orderstatus = 'F' then 'FB08' when o_orderstatus = 'O' then '/DS1/HM_C_DAILY_T' "
    "when o_totalprice < 100000 then 'VF01' else 'FB08' end",
    "XBLNR": "case when o_orderpriority = '3-MEDIUM' then left(cast(o_orderkey as string), 3) "
    f"else concat({_DOC.format(key='o_orderkey')}, '/000', left(o_orderpriority, 1)) end",
    **_ORDER_CHANGES,
}

MOVEMENT = {
    "MANDT": "case when o_totalprice < 20000 then '180' else '110' end",
    "MBLNR": _DOC.format(key="o_orderkey"),
    "MJAHR": "cast(year(o_orderdate) as string)",
    "ZEILE": "concat('000', left(o_orderpriority, 1))",
    "BWART": "left(o_orderpriority, 3)",
    "MATNR": _MATERIAL.format(key="o_custkey"),
    "WERKS": "cast(o_custkey as string)",
    "SHKZG": "case o_orderstatus when 'F' then 'S' when 'O' then 'H' end",
    "UMMAT": _MATERIAL.format(key="o_orderkey"),
    "UMWRK": "concat('X', cast(o_custkey as string))",
    **_ORDER_CHANGES,
}

SECOND_QUANTITY = {
    "MANDT": MOVEMENT["MANDT"],
    "MBLNR": MOVEMENT["MBLNR"],
    "MJAHR": MOVEMENT["MJAHR"],
    "ZEILE": MOVEMENT["ZEILE"],
    "MSEHI": "case when o_orderpriority = '4-NOT SPECIFIED' then 'BB6' else 'L15' end",
    "ADQNT": "o_totalprice",
    **_ORDER_CHANGES,
}

ITEM = {
    "MANDT": "case l_linestatus when 'F' then '280' else '480' end",
    "BUKRS": LEDGER["RBUKRS"],
    "BELNR": LEDGER["DOCNR"],
    "GJAHR": LEDGER["RYEAR"],
    "BUZEI": LEDGER["DOCLN"],
    "BSCHL": "concat(l_returnflag, l_linestatus)",
    "SHKZG": LEDGER["DRCRK"],
    "MWSKZ": "case when l_tax < 0.045 then 'V1' else 'V2' end",
    "DMBTR": "l_extendedprice",
    "MENGE": "l_quantity",
    "MATNR": LEDGER["MATNR"],
    "LIFNR": LEDGER["LIFNR"],
    "ingested_at": "l_shipdate",
}

DOCUMENT = {
    **{c: HEADER[c] for c in ("MANDT", "BUKRS", "BELNR", "GJAHR", "BLART", "TCODE", "XBLNR")},
    "BUDAT": "cast(o_orderdate as date)",
    "KURSF": "o_totalprice",
    "ingested_at": "o_orderdate",
}

INDEX = {
    "RCLNT": ITEM["MANDT"],
    "AWREF": LEDGER["DOCNR"],
    "AWTYP": "case when l_linenumber = 1 then 'BKPF' else 'VBRK' end",
    "AWORG": LEDGER["RBUKRS"],
    "RLDNR": LEDGER["RLDNR"],
    "DOCCT": LEDGER["DOCCT"],
    "RYEAR": LEDGER["RYEAR"],
    "DOCNR": LEDGER["DOCLN"],
    "BUDAT": "cast(cast(l_shipdate as date) as string)",
    "RRCTY": "cast(l_linenumber as string)",
    "RVERS": "'001'",
    "RCOMP": LEDGER["RPRCTR"],
    "BUKRS": LEDGER["RBUKRS"],
    "DOCTY": LEDGER["BLART"],
    "BELNR": LEDGER["REFDOCNR"],
    "LAST_DTM": "l_shipdate",
    "LAST_ACTION_CD": "case when l_returnflag = 'R' and l_linenumber >= 6 then 'D' when l_returnflag = 'A' then 'C' "
    "else 'U' end",
    "ingested_at": "l_shipdate",
}

# Feed name -> (given table, expressions).
FEEDS = {
    "ledger": ("lineitem", LEDGER),
    "quantity": ("lineitem", QUANTITY),
    "contract": ("lineitem", CONTRACT),
    "header": ("orders", HEADER),
    "movement": ("orders", MOVEMENT),
    "second_quantity": ("orders", SECOND_QUANTITY),
    "item": ("lineitem", ITEM),
    "document": ("orders", DOCUMENT),
    "index": ("lineitem", INDEX),
}


def feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source feed as a projection of its given table."""
    source, expressions = FEEDS[name]
    return table(spark, folder, source).selectExpr(*[f"{e} AS {c}" for c, e in expressions.items()])


def control(spark: SparkSession, folder: str) -> DataFrame:
    """Profit centres of suppliers outside the first region, as the control table."""
    regions = table(spark, folder, "region").filter(F.col("r_regionkey") > 0)
    nations = table(spark, folder, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    suppliers = table(spark, folder, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    return suppliers.select(F.expr(_DOC.format(key="s_suppkey")).alias("RPRCTR"), F.col("s_name").alias("description"))


def ledger_feeds(spark: SparkSession, folder: str) -> LedgerFeeds:
    """All source tables of the ledger-line fact."""
    names = ("ledger", "quantity", "contract", "header", "movement", "second_quantity")
    return LedgerFeeds(**{n: feed(spark, folder, n) for n in names}, control=control(spark, folder))


def ledger_streams(spark: SparkSession, folder: str) -> LedgerFeeds:
    """The captured source tables of the ledger-line fact as streams over the files of the given tables."""
    def stream(name: str) -> DataFrame:
        source, expressions = FEEDS[name]
        # A pattern, since a stream takes a path without one for a folder, and a given table may be a file.
        rows = spark.readStream.schema(table(spark, folder, source).schema).parquet(f"{folder}/{source}.parquet*")
        return rows.selectExpr(*[f"{e} AS {c}" for c, e in expressions.items()])

    return LedgerFeeds(**{n: stream(n) for n in CAPTURED}, control=control(spark, folder))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a run log: the user is the workflow, a purchase completes a run."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS run_id",
        "event_type AS process_name",
        "concat('workflow-', cast(user_id as string)) AS workflow",
        "ts AS run_start",
        "ts AS run_update",
        "case when event_type = 'purchase' then 'completed' else 'started' end AS status",
    )


def column_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as column metadata: the part is the column, its attributes are tags."""
    return table(spark, folder, "part").selectExpr(
        "concat('col_', cast(p_partkey as string)) AS ColumnDisplayName",
        "case when p_size > 10 then concat('[{ColumnTargetName=', p_name, '}]') end AS ColumnTargetName",
        "case when p_size > 40 then '[{SkipColumn=true}]' when p_size > 20 then '[{SkipColumn=false}]' end AS SkipColumn",
        "concat('[{ColumnDescription=', p_name, ', ', lower(p_type), '}]') AS ColumnDescription",
        "case when p_size > 25 then concat('[{ColumnDataConfidentiality=', lower(p_brand), '}]') end "
        "AS ColumnDataConfidentiality",
        "case when p_size <= 25 then 'unknown' end AS ColumnPersonalData",
    )
