"""Rows that change slice, ageing out, packing of small files, concurrent runs, changed types, and a fact from end to end."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.operators.evolve import TypeConflictError, common_schema, common_type, union_widened
from factloom.operators.merge import Upsert
from factloom.operators.quality import in_set_checks, not_null_checks, run_checks
from factloom.plans.publish import run_fact
from factloom.sources.runlog_table import RunLogTable
from factloom.sources.snapshot import SnapshotTable
from factloom.sources.suite_counts import StoredSuite
from factloom.spec import MergeSpec

FIELDS = "id int, v string, year string"
START = "2024-01-0{} 00:00:00"


def rows(table):
    return sorted((r.id, r.v, r.year) for r in table.read().collect())


def files(table):
    found = {}
    for d, _, names in os.walk(table.current_path()):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.relpath(os.path.join(d, name), table.current_path())] = os.path.getsize(os.path.join(d, name))
    return found


@pytest.fixture()
def years(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    made = [(1, "a", "2020"), (2, "b", "2021"), (3, "c", "2021"), (4, "d", "2022"), (5, "e", "2023"), (6, "f", None)]
    return table.overwrite(spark.createDataFrame(made, FIELDS))


def test_rows_change_slice_and_other_slices_keep_their_files(spark, years):
    before = files(years)
    source = [(2, "moved", "2022"), (6, "named", "2020"), (7, "new", "2030"), (3, "unnamed", None)]
    years.merge(spark.createDataFrame(source, FIELDS), MergeSpec(keys=["id"]), deleted=spark.createDataFrame([(1,), (99,), (None,)], "id int"))
    assert sorted(rows(years), key=str) == sorted(
        [(2, "moved", "2022"), (3, "unnamed", None), (4, "d", "2022"), (5, "e", "2023"), (6, "named", "2020"), (7, "new", "2030")], key=str
    )
    assert years.versions() == [1]
    assert {f for f in before if "2023" in f} == {f for f in files(years) if "2023" in f}
    assert not any("2021" in f for f in files(years))  # its rows moved away


def test_an_interrupted_move_is_finished_by_the_next_merge(spark, years, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "finish_pending", lambda self: self)
        years.merge(spark.createDataFrame([(2, "moved", "2022")], FIELDS), MergeSpec(keys=["id"]))
    years.merge(spark.createDataFrame([(4, "late", "2020")], FIELDS), MergeSpec(keys=["id"]))
    got = {r.id: (r.v, r.year) for r in years.read().collect()}
    assert got[2] == ("moved", "2022") and got[4] == ("late", "2020") and len(got) == 6


@pytest.mark.parametrize("spec", [MergeSpec(keys=["id"], update=["v"]), MergeSpec(keys=["id"], stamp={"year": "'2040'"})])
def test_merges_that_do_not_take_the_slice_from_the_source(spark, years, spec):
    years.merge(spark.createDataFrame([(2, "x", "2023"), (9, "y", "2023")], FIELDS), spec)
    got = {r.id: (r.v, r.year) for r in years.read().collect()}
    stamped = bool(spec.stamp)
    assert got[2] == ("x", "2040" if stamped else "2021") and got[9] == ("y", "2040" if stamped else "2023")
    assert len(got) == 7 and got[5] == ("e", "2023")


def test_null_safe_keys_are_found_wherever_they_are(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    table.overwrite(spark.createDataFrame([(None, "a", "2020"), (1, "b", "2021")], FIELDS))
    table.merge(spark.createDataFrame([(None, "z", "2021")], FIELDS), MergeSpec(keys=["id"], null_safe=["id"]))
    assert sorted(map(tuple, table.read().select("id", "v", "year").collect()), key=str) == [(1, "b", "2021"), (None, "z", "2021")]


def test_new_source_rows_are_found_by_the_target_s_keys_alone(spark, years):
    halves = Upsert(years.read(), spark.createDataFrame([(2, "x", "2021")], FIELDS), MergeSpec(keys=["id"]))
    plan = halves.matched()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int>" in plan
    assert [tuple(r) for r in halves.matched().collect()] == [(2,)]


def test_ageing_out_drops_folders_and_cuts_the_first_slice(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["month"])
    days = spark.range(100).selectExpr("cast(id as int) AS id", "date_add(DATE '2024-01-01', cast(id as int)) AS day")
    dated = days.withColumn("month", F.date_format("day", "yyyy-MM"))
    table.overwrite(dated.unionByName(spark.createDataFrame([(500, None, None), (501, None, "2024-03")], "id int, day date, month string")))
    before = files(table)
    assert table.age_out("day", dt.date(2024, 3, 10), "2024-03") == ["2024-01", "2024-02"]
    got = {r.id for r in table.read().collect()}
    assert got == {*range(69, 100), 500, 501}
    kept = {f for f in before if "2024-04" in f or "HIVE_DEFAULT" in f}
    assert kept <= set(files(table)) and not any("2024-01" in f for f in files(table))
    again = files(table)
    assert table.age_out("day", dt.date(2024, 3, 10), "2024-03") == [] and files(table) == again
    assert table.age_out("day", dt.date(2024, 5, 1), "2024-05") == ["2024-03", "2024-04"]
    assert {r.id for r in table.read().collect()} == {500}


@pytest.mark.parametrize("sliced", [True, False])
def test_small_files_are_packed_and_full_ones_stay(spark, tmp_path, sliced):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"] if sliced else [])
    path = f"{tmp_path}/t/version-00000001"
    writer = lambda df: df.write.mode("append").partitionBy(*table.slice_by).parquet(path)
    big = spark.range(20_000).selectExpr("cast(id as int) AS id", "sha2(cast(id as string), 256) AS v", "'2020' AS year")
    writer(big.coalesce(1))
    for i in range(3):
        small = spark.range(40).selectExpr(f"cast(id + {100_000 + 100 * i} as int) AS id", "'s' AS v", "concat('202', id % 3) AS year")
        writer(small.repartition(2))
    want, full = rows(table), max(files(table).items(), key=lambda f: f[1])
    before, after = table.compact_small(full[1])
    assert before == len(files(table)) + before - after and after < before
    assert rows(table) == want and files(table)[full[0]] == full[1]
    assert after == (4 if sliced else 2)
    kept = files(table)
    assert table.compact_small(full[1]) == (after, after) and files(table) == kept
    assert table.versions() == [1] and not os.path.exists(f"{tmp_path}/t/compacting")


def test_many_bins_of_one_slice_keep_all_rows_even_when_interrupted(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["year"])
    small = spark.range(4000).selectExpr("cast(id as int) AS id", "sha2(cast(id as string), 256) AS v", "'2020' AS year")
    small.repartition(24).write.partitionBy("year").parquet(f"{tmp_path}/t/version-00000001")
    want, size = rows(table), sum(files(table).values())
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "finish_compacting", lambda self: self)
        table.compact_small(size // 4)
    assert rows(table) == want and len(files(table)) == 24
    table.finish_compacting()
    assert rows(table) == want and 3 <= len(files(table)) <= 6


def test_two_runs_that_start_at_once_are_both_logged(spark, tmp_path):
    runs = RunLogTable(spark, f"{tmp_path}/log")
    starts = [threading.Thread(target=runs.start, args=("w", "p", i, "load"), kwargs={"as_of": START.format(i)}) for i in (1, 2)]
    for thread in starts:
        thread.start()
    for thread in starts:
        thread.join()
    assert sorted((r.run_id, r.process_order) for r in runs.read().collect()) == [(1, 1), (2, 2)]


def test_a_claim_that_was_left_behind_is_taken_over(spark, tmp_path):
    runs = RunLogTable(spark, f"{tmp_path}/log", claim_seconds=1)
    with pytest.raises(RuntimeError), runs._claimed("w"):
        raise RuntimeError
    left = RunLogTable(spark, f"{tmp_path}/log")
    claim = left._claimed("w")
    claim.__enter__()  # and its process dies
    runs.start("w", "p", 1, "load", as_of=START.format(1))
    assert runs.read().count() == 1 and not runs.completed("w")


def test_common_types():
    want = {
        ("int", "bigint"): "bigint", ("tinyint", "float"): "float", ("int", "double"): "double", ("float", "double"): "double",
        ("decimal(10,2)", "decimal(8,4)"): "decimal(12,4)", ("int", "decimal(5,2)"): "decimal(12,2)", ("date", "timestamp"): "timestamp",
        ("array<int>", "array<bigint>"): "array<bigint>", ("struct<a:int>", "struct<a:bigint,b:date>"): "struct<a:bigint,b:date>",
        ("map<string,int>", "map<string,bigint>"): "map<string,bigint>", ("string", "string"): "string",
    }
    for (a, b), c in want.items():
        for x, y in ((a, b), (b, a)):
            assert common_type(T.DataType.fromDDL(x), T.DataType.fromDDL(y)) == T.DataType.fromDDL(c), (x, y)
    for a, b in (("bigint", "double"), ("int", "string"), ("decimal(38,0)", "decimal(38,10)"), ("timestamp", "timestamp_ntz"), ("int", "float"), ("boolean", "int")):
        with pytest.raises(TypeConflictError):
            common_type(T.DataType.fromDDL(a), T.DataType.fromDDL(b))
    with pytest.raises(TypeConflictError, match="column b"):
        common_schema(T.StructType.fromDDL("a int, b int"), T.StructType.fromDDL("b string"))


def test_a_changed_type_is_widened_or_refused_before_writing(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t").overwrite(spark.sql("SELECT 1 AS a, DATE '2024-01-02' AS d, 'x' AS t"))
    table.overwrite_evolving(spark.sql("SELECT 5000000000 AS a, TIMESTAMP '2024-01-03 04:05:06' AS d, 2.5BD AS n"))
    assert dict(table.read().dtypes) == {"a": "bigint", "d": "timestamp", "n": "decimal(2,1)", "t": "string"}
    table.overwrite_evolving(spark.sql("SELECT 7 AS a"))
    assert dict(table.read().dtypes)["a"] == "bigint"
    both = union_widened(table.read_version(1), table.read_version(2)).orderBy("a").collect()
    assert [(r.a, r.d, r.t) for r in both] == [(1, dt.datetime(2024, 1, 2), "x"), (5000000000, dt.datetime(2024, 1, 3, 4, 5, 6), None)]
    with pytest.raises(TypeConflictError, match="column t"):
        table.overwrite_evolving(spark.sql("SELECT 1 AS t"))
    assert table.versions() == [1, 2, 3]
    with pytest.raises(FileNotFoundError):
        table.read_version(9)


def test_a_run_that_fails_is_repeated_from_where_it_began(spark, tmp_path):
    runs, table = RunLogTable(spark, f"{tmp_path}/log"), SnapshotTable(spark, f"{tmp_path}/t")
    marks = []

    def full(t):
        t.overwrite(spark.range(3).selectExpr("id"))

    def delta(t, mark):
        marks.append(str(mark.first()[0]))
        if len(marks) == 1:
            raise RuntimeError("lost")

    assert run_fact(runs, table, "w", full, delta, as_of=START.format(1)) == "full"
    with pytest.raises(RuntimeError):
        run_fact(runs, table, "w", full, delta, as_of=START.format(2))
    assert run_fact(runs, table, "w", full, delta, as_of=START.format(3)) == "delta"
    assert marks == [START.format(1)] * 2
    assert [(r.run_id, r.status) for r in runs.read().orderBy("run_id").collect()] == [(1, "completed"), (2, "started"), (3, "completed")]


def test_a_stored_suite_reads_what_changed_and_equals_a_full_run(spark, years, tmp_path):
    checks = [*not_null_checks([("v", {"mostly": 0.9}), ("year", {})]), *in_set_checks([("id", {"value_set": [1, 2, 3]})])]
    suite = StoredSuite(years, f"{tmp_path}/counts", checks)
    folders = lambda: [f.rsplit("/", 1)[1] for f in suite.refresh()]
    full = lambda: sorted(map(tuple, run_checks(years.read(), checks).collect()))
    stored = lambda: sorted(map(tuple, suite.results().collect()))
    assert sorted(map(tuple, suite.results().select("element_count", "success").collect())) == [(0, True)] * 3
    assert len(folders()) == 5 and stored() == full()
    assert folders() == [] and stored() == full()
    years.merge(spark.createDataFrame([(2, None, "2022")], FIELDS), MergeSpec(keys=["id"]))
    assert folders() == ["year=2021", "year=2022"] and stored() == full()
    years.merge(spark.createDataFrame([(5, "x", "2022")], FIELDS), MergeSpec(keys=["id"]))
    assert folders() == ["year=2022"] and stored() == full()  # the folder of 2023 is gone
    other = StoredSuite(years, f"{tmp_path}/counts", checks[:1])
    assert len(other.refresh()) == 4 and other.results().count() == 1
