"""Sieves of keys: rows that surely match nothing are neither shuffled for a join nor rewritten through one."""

import os

import pytest
from pyspark.sql import functions as F

from factloom.operators import keys
from factloom.operators.joins import enrich, enrich_late
from factloom.operators.merge import delete_by_keys
from factloom.plans import ledger_line
from factloom.sources.snapshot import SnapshotTable
from factloom.sources.workspace import stage
from factloom.spec import Lookup, MergeSpec
from tests.compare import spark_bag
from workload.bindings import WATERMARK, ledger_feeds

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def sieving(monkeypatch):
    monkeypatch.setattr(keys, "SIEVE_KEYS_LEAST", 1)


def numbered(spark, count):
    """Keys of which every 50th is NULL, and each occurs twice."""
    rows = spark.range(count).selectExpr("CASE WHEN id % 50 <> 7 THEN concat('k', id) END AS k", "id % 3 AS n", "id")
    return rows.unionByName(rows)


def test_no_key_is_lost_and_few_others_pass(spark, sieving):
    rows, wanted = numbered(spark, 20_000), numbered(spark, 20_000).filter("id % 10 = 0")
    exact = keys.rows_hit(rows, wanted, {"k": "k", "n": "n"})
    got = keys.sieved(rows, wanted, {"k": "k", "n": "n"})
    assert spark_bag(got.join(wanted.select("id").distinct(), "id", "left_semi")) == spark_bag(exact)
    assert exact.count() <= got.count() < 1.05 * exact.count()
    assert spark_bag(keys.rows_hit(rows, wanted, {"k": "k", "n": "n"}, staged=True)) == spark_bag(exact)
    assert keys.sieved(rows, wanted.where("false"), {"k": "k"}) is rows
    assert keys.sieved(rows, wanted.withColumn("n", F.col("n").cast("int")), {"n": "n"}) is rows


def test_a_full_sieve_still_loses_no_key(spark, sieving, monkeypatch):
    monkeypatch.setattr(keys, "SIEVE_BITS_MOST", 512)
    rows, wanted = numbered(spark, 3000), numbered(spark, 3000).filter("id % 2 = 0")
    assert spark_bag(keys.rows_hit(rows, wanted, {"k": "k"}, staged=True)) == spark_bag(keys.rows_hit(rows, wanted, {"k": "k"}))


def test_affected_keys_are_sieved_before_they_travel(spark, monkeypatch):
    feeds = ledger_feeds(spark, FOLDER).unified()
    want = spark_bag(ledger_line.affected_ledger_keys(feeds, WATERMARK))
    monkeypatch.setattr(keys, "SIEVE_KEYS_LEAST", 1)
    hit = ledger_line.affected_ledger_keys(feeds, WATERMARK)
    assert spark_bag(hit) == want
    assert "getbit" in hit._jdf.queryExecution().executedPlan().toString()


def test_late_lookups_are_sieved(spark, sieving):
    left = numbered(spark, 300).selectExpr("k", "n", "CAST(id AS string) AS id")
    step = Lookup(numbered(spark, 900).selectExpr("k AS x", "id AS found"), {"k": "x"}, {"found": "found"}, copies=False)
    late = enrich_late(left, [step], ["id"])
    assert "getbit" in late._jdf.queryExecution().executedPlan().toString()
    assert spark_bag(late.drop("row_hash")) == spark_bag(enrich(left, [step]))


def test_rows_that_no_delete_names_go_around_the_join(spark, sieving):
    target, gone = numbered(spark, 2000), numbered(spark, 2000).filter("id % 9 = 0").select("k")
    want = spark_bag(delete_by_keys(target, gone, ["k"]))
    got = delete_by_keys(target, stage(gone, "gone"), ["k"], staged=True)
    assert spark_bag(got) == want
    assert "getbit" in got._jdf.queryExecution().executedPlan().toString()


def test_a_merge_moves_its_files_into_the_slices(spark, tmp_path, monkeypatch):
    slices = "concat('m', id % 4) AS month"
    rows = spark.range(400).selectExpr("CASE WHEN id % 50 <> 7 THEN concat('k', id) END AS k", "id AS v", slices)
    rows = rows.filter("NOT (month = 'm3' AND id > 40)").unionByName(spark.sql("SELECT 'k900' AS k, 5L AS v, CAST(NULL AS string) AS month"))
    # Some rows stay in their slice, some move to another, some are new, and one slice loses all rows that have a key.
    source = spark.range(40, 60).selectExpr("concat('k', id) AS k", "-id AS v", "concat('m', id % 3) AS month")
    source = source.filter("k <> 'k57'").unionByName(spark.sql("SELECT CAST(NULL AS string) AS k, 77L AS v, 'm0' AS month"))
    gone = rows.filter("month = 'm3' OR v % 11 = 0").select("k")
    found = {}
    for least in (10**9, 1):
        monkeypatch.setattr(keys, "SIEVE_KEYS_LEAST", least)
        table = SnapshotTable(spark, f"{tmp_path}/t{least}", ["month"])
        table.overwrite(rows)
        table.merge(source, MergeSpec(keys=["k"]), deleted=gone)
        found[least] = spark_bag(table.read().select("k", "v", "month"))
        files = [f for _, _, names in os.walk(table.current_path()) for f in names if f.endswith(".parquet")]
        assert any(f.startswith("merged-") for f in files) and "_matched" not in table.read().columns
        assert not os.path.exists(f"{tmp_path}/t{least}/pending")
    k = {r.k: r for r in rows.collect() if r.k is not None}
    dead = {r.k for r in gone.collect()}
    want = {n: (r.v, r.month) for n, r in k.items()} | {r.k: (r.v, r.month) for r in source.collect() if r.k is not None}
    want = [(n, *r) for n, r in want.items() if n not in dead] + [(None, r.v, r.month) for r in rows.filter("k IS NULL").collect()] + [(None, 77, "m0")]
    assert spark_bag(spark.createDataFrame(want, "k string, v long, month string")) == found[1] == found[10**9]
