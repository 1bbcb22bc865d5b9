"""Derivations and filters, including the decided corner cases."""

import datetime as dt

from pyspark.sql import functions as F

from factloom.functions import left_chars, movement_label, opposite_side, own_side, path_segment, right_chars, source_id
from factloom.functions.codes import system_code
from factloom.operators import filters, project

import pytest


def one(spark, schema, *values):
    return spark.createDataFrame([values], schema)


def test_slices_of_short_texts(spark):
    texts = ["", "abc", "abcd", "0123456789", "0123456789/00042", None]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "x string")
        .selectExpr(f"{left_chars('x', 10)} AS l", f"{right_chars('x', 4)} AS r")
        .collect()
    )
    assert [(r.l, r.r) for r in rows] == [
        ("", ""), ("abc", "abc"), ("abcd", "abcd"), ("0123456789", "6789"), ("0123456789", "0042"), (None, None),
    ]


def test_source_id_is_null_for_null_client(spark):
    rows = spark.createDataFrame([("110",), (None,)], "c string").selectExpr(f"{source_id('D94', 'c')} AS s").collect()
    assert [r.s for r in rows] == ["D94_110", None]


def test_path_segment_missing_is_empty(spark):
    df = spark.createDataFrame([("a/b/c/d/e/f/g/h/202401/x",), ("a/b",)], "p string")
    assert [r.s for r in df.selectExpr(f"{path_segment('p', 9)} AS s").collect()] == ["202401", ""]


def test_path_segment_of_input_file(spark, tmp_path):
    folder = f"{tmp_path}/table"
    spark.range(3).write.parquet(folder)
    depth = ("file://" + folder).count("/")
    df = project.with_path_segment(spark.read.parquet(folder), position=depth + 1)
    assert {r.yrmono for r in df.collect()} == {"table"}


def test_swap_with_unknown_sign_takes_the_other_side(spark):
    df = spark.createDataFrame([("S", "H"), ("S", "S"), (None, "S"), ("S", None)], "m string, l string")
    rows = df.selectExpr(f"{own_side('m', 'l', '1', '2')} AS own", f"{opposite_side('m', 'l', '1', '2')} AS opp").collect()
    assert [(r.own, r.opp) for r in rows] == [(1, 2), (2, 1), (2, 2), (2, 2)]


def test_movement_labels(spark):
    df = spark.createDataFrame([(c,) for c in ("551", "702", "951", "Y52", "101", None)], "c string")
    assert [r.x for r in df.selectExpr(f"{movement_label('c')} AS x").collect()] == [
        "Scrapping", "Warehouse Gains & losses", "InTransit Gains & losses", "Tank Level Gains & losses", "", "",
    ]


def test_system_code_must_be_known():
    assert system_code("prd", "TSAP") == "P81"
    with pytest.raises(ValueError):
        system_code("nowhere", "STN")


def test_client_is_compared_as_text(spark):
    df = spark.createDataFrame([("110",), ("0110",), ("abc",), (None,)], "MANDT string")
    assert [r.MANDT for r in filters.client_filter(df).collect()] == ["110"]


def test_account_range_is_textual_unless_padded(spark):
    accounts = ["0006000000", "0009999999", "0010000000", "6380303", None]
    df = spark.createDataFrame([("110", a) for a in accounts], "RCLNT string, RACCT string")
    assert [r.RACCT for r in filters.account_range_filter(df).collect()] == accounts[:2]
    assert [r.RACCT for r in filters.account_range_filter(df, pad_to=10).collect()] == [*accounts[:2], "6380303"]


def test_trailing_window_includes_its_first_day_across_year_end(spark):
    days = [dt.date(2022, 12, 29), dt.date(2022, 12, 30), dt.date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "BUDAT date")
    assert [r.BUDAT for r in filters.trailing_months_filter(df, "2024-12-30").collect()] == days[1:]


def test_watermark_is_inclusive_and_optional(spark):
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame([(t,) for t in times], "ingested_at timestamp")
    assert filters.since_watermark(df, "2024-01-02").count() == 1
    assert filters.since_watermark(df, times[1]).count() == 1
    assert filters.since_watermark(df, None).count() == 2
    assert filters.since_watermark(df, df.agg(F.max("ingested_at"))).count() == 1


def test_latest_batch_for_text_and_numbers(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, None)], "s string, n int")
    assert filters.latest_batch(df, "s").count() == 2
    assert filters.latest_batch(df, "n").count() == 2
    assert filters.latest_batch(df.limit(0), "n").count() == 0


def test_null_action_counts_as_upsert(spark):
    df = spark.createDataFrame([("D",), ("I",), (None,)], "OPFLAG string")
    upserts, deletes = filters.split_changes(df)
    assert (upserts.count(), deletes.count()) == (2, 1)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    spark.range(10).selectExpr(
        "'110' AS RCLNT", "'0007000000' AS RACCT", "timestamp'2024-01-01' AS ingested_at", "id AS payload", "id AS HSL"
    ).write.parquet(path)
    df = filters.account_range_filter(filters.since_watermark(spark.read.parquet(path), "2023-01-01")).select("HSL")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for text in ("EqualTo(RCLNT,110)", "GreaterThanOrEqual(RACCT,0006000000)", "LessThanOrEqual(RACCT,0009999999)",
                 "GreaterThanOrEqual(ingested_at"):
        assert text in pushed
    assert "payload" not in plan[plan.index("ReadSchema"):]


def test_rename_rejects_two_columns_of_one_name(spark):
    df = spark.range(1).selectExpr("id AS `/CWM/FI`", "id AS b")
    assert project.rename_projection(df, {"/CWM/FI": "fi"}).columns == ["fi"]
    with pytest.raises(ValueError):
        project.rename_projection(df, {"/CWM/FI": "x", "b": "x"})
