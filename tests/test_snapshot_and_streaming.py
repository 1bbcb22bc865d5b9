"""Published tables: versions, slices, merge, compaction, clean-up, streaming, catalogue."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from factloom.sources import catalog
from factloom.sources.files import explode_value, read_csv_lookup, read_value_json, read_view_columns
from factloom.sources.snapshot import SnapshotTable, overwrite_slices
from factloom.sources.workspace import table_path
from factloom.spec import MergeSpec
from factloom.streaming.feed import follow_feed, latest_per_key
from tests.compare import spark_bag

FIELDS = "year string, id int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path)
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_failed_version_is_not_read(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.overwrite(spark.range(3).toDF("id"))
    os.makedirs(f"{tmp_path}/t/version-00000002")
    assert table.versions() == [1] and table.read().count() == 3
    table.overwrite(table.read().withColumn("id", F.col("id") + 10))
    assert table.versions() == [1, 3]
    assert rows(table.read()) == [(10,), (11,), (12,)]


def test_full_load_keeps_old_columns_when_asked(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.sql("SELECT 1 AS a, 'x' AS b"))
    table.overwrite_evolving(spark.sql("SELECT 2 AS a, 3.5D AS c"))
    assert SnapshotTable(spark, f"{tmp_path}/first").overwrite_evolving(spark.range(2).toDF("id")).read().count() == 2
    assert {f.name: f.dataType.simpleString() for f in table.read().schema} == {"a": "int", "b": "string", "c": "double"}
    assert table.read().first().asDict() == {"a": 2, "b": None, "c": 3.5}


def test_slice_overwrite_keeps_other_slices(spark, tmp_path):
    path = f"{tmp_path}/t"
    overwrite_slices(spark.createDataFrame([("2020", 1, "a"), ("2021", 2, "b")], FIELDS), path, ["year"])
    kept = {f for f in files(path) if "year=2020" in f}
    overwrite_slices(spark.createDataFrame([("2021", 3, "c")], FIELDS), path, ["year"])
    assert {f for f in files(path) if "year=2020" in f} == kept
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (3,)]


def test_merge_rewrites_touched_slices_only(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([("0110", 1, "a"), ("0111", 2, "b"), ("0112", 3, "c")], FIELDS))
    before = files(table.current_path())
    source = spark.createDataFrame([("0111", 2, None), ("0111", 4, "d"), ("0113", 5, "e")], FIELDS)
    table.merge(source, MergeSpec(keys=["year", "id"]))
    assert table.versions() == [1]
    same = {f for f in before if "0110" in f or "0112" in f}
    assert same <= files(table.current_path())
    got = rows(table.read().select("year", "id", "v"))
    assert got == sorted([("0110", 1, "a"), ("0111", 2, None), ("0111", 4, "d"), ("0112", 3, "c"), ("0113", 5, "e")], key=str)


def test_merge_keeps_rows_of_the_unnamed_slice(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([(None, 1, "a"), ("2020", 2, "b")], FIELDS))
    table.merge(spark.createDataFrame([(None, 3, "c")], FIELDS), MergeSpec(keys=["year", "id"]))
    got = rows(table.read().select("year", "id", "v"))
    assert got == sorted([(None, 1, "a"), ("2020", 2, "b"), (None, 3, "c")], key=str)


def test_merge_reads_touched_slices_only(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.range(400).selectExpr("cast(2000 + id % 40 as string) AS year", "cast(id as int) AS id", "'x' AS v"))
    touched = table._touched(spark.createDataFrame([("2020",), ("2020",)], "year string"))
    slices = table._slices(table.read(), touched)
    assert slices.count() == 10
    plan = slices._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_an_interrupted_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([("2020", 1, "a"), ("2021", 2, "b"), ("2022", 3, "c")], FIELDS))
    source = spark.createDataFrame([("2021", 9, "n")], FIELDS)
    gone = spark.createDataFrame([("2020", 1)], "year string, id int")
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "finish_pending", lambda self: self)
        table.merge(source, MergeSpec(keys=["year", "id"]), deleted=gone)
    # The rows are written, no slice is replaced; one of them is lost half-way.
    assert table.read().count() == 3
    for name in os.listdir(f"{table.current_path()}/year=2021"):
        os.remove(f"{table.current_path()}/year=2021/{name}")
    table.merge(spark.createDataFrame([("2022", 4, "d")], FIELDS), MergeSpec(keys=["year", "id"]))
    got = rows(table.read().select("year", "id", "v"))
    assert got == sorted([("2021", 2, "b"), ("2021", 9, "n"), ("2022", 3, "c"), ("2022", 4, "d")], key=str)
    assert not os.path.exists(f"{tmp_path}/t/pending")


def test_a_merge_leaves_nothing_staged(spark, tmp_path):
    folder = table_path(spark, "stage")
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"]).overwrite(spark.createDataFrame([("2020", 1, "a")], FIELDS))
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    table.merge(spark.createDataFrame([("2020", 2, "b")], FIELDS), MergeSpec(keys=["year", "id"]))
    assert (set(os.listdir(folder)) if os.path.exists(folder) else set()) <= before and table.read().count() == 2


def test_empty_text_is_no_slice(spark, tmp_path):
    df = spark.createDataFrame([("", 1, "a")], FIELDS)
    with pytest.raises(Exception, match="empty text in slice column year"):
        SnapshotTable(spark, f"{tmp_path}/t", ["year"]).overwrite(df)
    with pytest.raises(Exception, match="empty text"):
        overwrite_slices(df, f"{tmp_path}/u", ["year"])


def test_merge_delete_wins_and_may_empty_a_slice(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([("2020", 1, "a"), ("2021", 2, "b"), ("2022", 3, "c")], FIELDS))
    source = spark.createDataFrame([("2020", 1, "z"), ("2021", 9, "n")], FIELDS)
    gone = spark.createDataFrame([("2020", 1), ("2021", 2)], "year string, id int")
    table.merge(source, MergeSpec(keys=["year", "id"]), deleted=gone)
    assert rows(table.read().select("year", "id", "v")) == [("2021", 9, "n"), ("2022", 3, "c")]


def test_merge_of_an_unsliced_table_writes_a_version(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.createDataFrame([("2020", 1, "a")], FIELDS))
    table.merge(spark.createDataFrame([("2020", 1, "b")], FIELDS), MergeSpec(keys=["year", "id"]))
    assert table.versions() == [1, 2] and rows(table.read()) == [("2020", 1, "b")]


def test_compact_then_vacuum(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.range(100).toDF("id").repartition(20))
    table.compact()
    assert len(files(table.current_path())) < 20
    assert spark_bag(table.read()) == spark_bag(spark.range(100).toDF("id"))
    assert table.vacuum() == [] and table.versions() == [1, 2]
    assert table.vacuum(retain_hours=0) == [1] and table.versions() == [2]
    assert table.read().count() == 100


def test_stream_applies_each_change_once(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    fields = "id int, v string, at int"
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.createDataFrame([(1, "old", 0), (2, "two", 0)], fields))

    def deliver(*changes):
        spark.createDataFrame(changes, fields).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(fields).parquet(feed)
        query = follow_feed(stream, table, MergeSpec(keys=["id"]), order="at", name=f"feed-{tmp_path.name}")
        query.awaitTermination(120)
        assert query.exception() is None

    deliver((1, "first", 1), (1, "second", 2), (3, "three", 1))
    assert rows(table.read()) == [(1, "second", 2), (2, "two", 0), (3, "three", 1)]
    versions = len(table.versions())
    deliver((2, "TWO", 5))
    assert rows(table.read()) == [(1, "second", 2), (2, "TWO", 5), (3, "three", 1)]
    assert len(table.versions()) == versions + 1


def test_register_and_view(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.sql("SELECT 1 AS a, 2 AS `b/c`, 3 AS hidden"))
    assert catalog.register_table(spark, "registered_once", table.current_path())
    assert not catalog.register_table(spark, "registered_once", table.current_path())
    for _ in range(2):
        view = catalog.reader_view(spark, "vw_registered_once", "registered_once", ["a", "b/c"])
        assert view.columns == ["a", "b/c"] and view.count() == 1
    found = catalog.catalog_inventory(spark, ["default", "no_such_schema"])
    expected = {"default": ["registered_once", "absent"], "no_such_schema": ["x"]}
    assert catalog.missing_tables(found, expected) == {"default": ["absent"], "no_such_schema": ["x"]}


def test_views_from_a_file(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.sql("SELECT 1 AS a, 2 AS `b/c`, 3 AS hidden"))
    catalog.register_table(spark, "listed", table.current_path())

    def views(*lines):
        path = f"{tmp_path}/views-{uuid.uuid4().hex}.csv"
        with open(path, "w") as out:
            out.write("\n".join(["view,table,position,column", *lines]))
        return read_view_columns(spark, path)

    made = catalog.reader_views(spark, views("vw_two,listed,2,a", "vw_two,listed,1,b/c", "vw_one,listed,1,a"))
    assert {v: df.columns for v, df in made.items()} == {"vw_one": ["a"], "vw_two": ["b/c", "a"]}
    with pytest.raises(ValueError, match="vw_one.*gone"):
        catalog.reader_views(spark, views("vw_one,listed,1,gone", "vw_two,listed,1,a"))
    assert spark.table("vw_two").columns == ["b/c", "a"]
    for wrong in (["v,t,1,a", "v,u,2,b"], ["v,t,1,a", "v,t,2,a"], ["v,t,1,a", "v,t,1,b"]):
        with pytest.raises(ValueError):
            views(*wrong)


def test_registration_follows_the_published_version(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.range(3).toDF("id"))
    catalog.register_table(spark, "followed", table.current_path())
    assert catalog.reader_view(spark, "vw_followed", "followed", ["id"]).count() == 3
    table.overwrite(spark.range(10).selectExpr("id", "'new' AS added"))
    assert not catalog.register_table(spark, "followed", table.current_path())
    assert spark.table("followed").count() == 10 and spark.table("followed").columns == ["id", "added"]
    assert spark.table("vw_followed").count() == 10
    table.compact()
    table.vacuum(retain_hours=0, registered=["followed"])
    assert spark.table("followed").count() == spark.table("vw_followed").count() == 10


def test_latest_change_of_a_key(spark):
    changes = spark.createDataFrame(
        [(1, "old", None), (2, "a", 1), (2, "b", 2), (3, "x", 5), (3, "y", 5), (4, None, None)], "id int, v string, at int"
    )
    got = {r.id: r for r in latest_per_key(changes, ["id"], "at").collect()}
    assert got[1].v == "old" and got[2].v == "b" and got[4].at is None and len(got) == 4


def test_stream_applies_deletes(spark, tmp_path):
    fields = "id int, v string, at int, op string"
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.createDataFrame([(1, "one", 0, "I"), (2, "two", 0, "I")], fields))
    spark.createDataFrame([(1, None, 1, "D"), (3, "three", 1, "I"), (3, None, 2, "D"), (2, "TWO", 1, "U")], fields).write.parquet(f"{tmp_path}/feed")
    stream = spark.readStream.schema(fields).parquet(f"{tmp_path}/feed")
    query = follow_feed(stream, table, MergeSpec(keys=["id"]), order="at", name=f"del-{tmp_path.name}", action="op")
    query.awaitTermination(120)
    assert rows(table.read()) == [(2, "TWO", 1, "U")]


def test_register_a_sliced_table(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([("y1", 1, "a"), ("y2", 2, "b")], FIELDS))
    for _ in range(2):
        catalog.register_table(spark, "registered_slices", table.current_path(), partitioned=True)
        assert spark.table("registered_slices").filter("year = 'y2'").count() == 1
        table.merge(spark.createDataFrame([("y3", 3, "c")], FIELDS), MergeSpec(keys=["year", "id"]))
        catalog.register_table(spark, "registered_slices", table.current_path(), partitioned=True)
        assert spark.table("registered_slices").count() == 3


def test_lookup_files(spark, tmp_path):
    (tmp_path / "map.csv").write_text("input,output\nTest Unit,Other\nP&T,Projects\n")
    got = read_csv_lookup(spark, f"{tmp_path}/map.csv", "input string, output string")
    assert rows(got) == [("P&T", "Projects"), ("Test Unit", "Other")]
    (tmp_path / "groups.json").write_text(
        '{"value": [{"id": "/g/1",\n "location": "here", "tags": {"Owner": "me"}}, {"id": "/g/2"}]}'
    )
    kind = "struct<id:string,location:string,tags:map<string,string>>"
    got = read_value_json(spark, f"{tmp_path}/groups.json", kind, multi_line=True).orderBy("id").collect()
    assert [(r.id, r.location, r.tags) for r in got] == [("/g/1", "here", {"Owner": "me"}), ("/g/2", None, None)]
    assert explode_value(spark.sql("SELECT 1 AS k, array(named_struct('a', 2)) AS value")).first() == (1, 2)
