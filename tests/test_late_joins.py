"""Late enrichment against plain enrichment, and one-pass key search against one search a path."""

import random
import re

import pytest
from pyspark.sql import functions as F

from factloom.operators.joins import enrich, enrich_late
from factloom.operators.keys import keys_hit_on_any_path, rows_hit, union_distinct
from factloom.spec import Lookup
from factloom.plans import ledger_line
from tests.compare import spark_bag
from workload.bindings import ledger_feeds
from workload.facts import LEDGER_SPEC

FOLDER = "/root/testdata/sf0.001"


def made(spark, names, count, seed, most=6):
    """Rows full of NULLs, repeats and keys that many share."""
    pick = random.Random(seed)
    rows = [tuple(None if pick.random() < 0.15 else str(pick.randint(0, most)) for _ in names) for _ in range(count)]
    return spark.createDataFrame(rows + rows[: count // 5], ", ".join(f"{n} string" for n in names))


@pytest.mark.parametrize("copies", [True, False])
def test_late_enrichment_gives_the_same_rows(spark, copies):
    left = made(spark, ["id", "a", "b", "c", "text"], 120, 1, 9)
    steps = [
        Lookup(made(spark, ["x", "y", "p"], 40, 2), {"a": "x", "b": "y"}, {"p": "found_p"}, copies=copies),
        Lookup(made(spark, ["x", "q"], 20, 3), {"c": "x"}, {"q": "found_q"}, copies=copies),
        Lookup(made(spark, ["id", "r"], 20, 4), {"id": "id"}, {"r": "found_r"}, copies=copies),
    ]
    late = enrich_late(left, steps, ["id", "a"]).drop("row_hash")
    plain = enrich(left, steps)
    assert late.columns == plain.columns
    assert spark_bag(late) == spark_bag(plain)
    assert enrich_late(left.where("false"), steps, ["id"]).count() == 0
    assert spark_bag(enrich_late(left, [], ["id"]).drop("row_hash")) == spark_bag(left)


def test_all_paths_at_once_hit_the_same_keys(spark):
    rows = made(spark, ["id", "a", "b", "c"], 400, 5, 40)
    one, two = made(spark, ["x"], 12, 6, 40), made(spark, ["y", "z"], 60, 7, 40)
    paths = [(one, {"a": "x"}), (two, {"b": "y", "c": "z"}), (one, {"c": "x"})]
    want = union_distinct(*[rows_hit(rows, changed, on).select("id") for changed, on in paths])
    got = keys_hit_on_any_path(rows, paths, ["id"])
    assert spark_bag(got) == spark_bag(want) and want.count() > 5
    with pytest.raises(ValueError):
        keys_hit_on_any_path(rows, [(one.select(F.col("x").cast("int")), {"a": "x"})], ["id"])


def scans_and_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, len(re.findall(r"Exchange hashpartitioning", plan))


def test_wide_rows_are_exchanged_once_and_the_ledger_is_read_once(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    feeds = ledger_feeds(session, FOLDER)
    fact = ledger_line._lines(feeds.unified().ledger, feeds.unified(), LEDGER_SPEC)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(row_hash" in line]
    assert len(wide) == 1  # all joins and the removal of repeats use it
    hit = ledger_line.affected_ledger_keys(feeds.unified(), "2001-06-15")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
