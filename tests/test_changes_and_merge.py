"""Change unification, merge laws, deletes, tombstones, joins under skew."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import changes, joins, keys, merge
from factloom.operators.ranking import number_rows
from factloom.spec import Lookup, MergeSpec
from tests.compare import spark_bag

FIELDS = "k string, l string, v int, w string"


def rows(df):
    return spark_bag(df)[1]


def test_unify_both_naming_styles(spark):
    feed = spark.createDataFrame(
        [
            ("1", "2024-01-01", "C", None, None),
            ("2", "2024-01-01", "U", "2024-02-02", "D"),
            ("3", None, None, "2024-02-02", "C"),
            ("4", "2024-01-01", "XC", None, None),
            ("5", None, None, None, None),
        ],
        "k string, LAST_DTM string, LAST_ACTION_CD string, AEDATTM string, OPFLAG string",
    )
    unified = changes.unify_cdc_columns(feed)
    assert unified.columns == ["k", "AEDATTM", "OPFLAG"]
    assert [tuple(r)[1:] for r in unified.orderBy("k").collect()] == [
        ("2024-01-01", "I"), ("2024-02-02", "D"), ("2024-02-02", "I"), ("2024-01-01", "XC"), (None, None),
    ]


def test_merge_rules(spark):
    target = spark.createDataFrame([("a", "1", 1, "x"), ("b", "1", 2, "y"), (None, "1", 3, "z")], FIELDS)
    source = spark.createDataFrame([("a", "1", None, "new"), ("c", "1", 9, "c"), (None, "1", 7, "n")], FIELDS)
    spec = MergeSpec(keys=["k", "l"], update=["v"], insert=["k", "l", "v"], stamp={"w": "'stamp'"})
    got = rows(merge.merge_upsert(target, source, spec))
    want = spark.createDataFrame(
        [
            ("a", "1", None, "stamp"),  # a NULL from the source overwrites
            ("b", "1", 2, "y"),  # untouched
            (None, "1", 3, "z"),  # NULL keys match nothing ...
            (None, "1", 7, "stamp"),  # ... so the source row is inserted
            ("c", "1", 9, "stamp"),
        ],
        FIELDS,
    )
    assert got == rows(want)


def test_null_safe_key_matches_itself(spark):
    target = spark.createDataFrame([("a", None, 1, "x")], FIELDS)
    source = spark.createDataFrame([("a", None, 2, "y")], FIELDS)
    once = merge.merge_upsert(target, source, MergeSpec(keys=["k", "l"], null_safe=["l"]))
    assert rows(once) == rows(source)
    again = merge.merge_upsert(target, source, MergeSpec(keys=["k", "l"]))
    assert again.count() == 2


def test_duplicate_source_keys_are_an_error(spark):
    target = spark.createDataFrame([("a", "1", 1, "x")], FIELDS)
    twice = spark.createDataFrame([("b", "1", 1, "x"), ("b", "1", 2, "y")], FIELDS)
    with pytest.raises(merge.DuplicateKeyError):
        merge.merge_upsert(target, twice, MergeSpec(keys=["k", "l"]))
    unmatched = spark.createDataFrame([(None, "1", 1, "x"), (None, "1", 2, "y")], FIELDS)
    assert merge.merge_upsert(target, unmatched, MergeSpec(keys=["k", "l"])).count() == 3


def test_merge_needs_known_columns(spark):
    df = spark.createDataFrame([("a", "1", 1, "x")], FIELDS)
    with pytest.raises(ValueError):
        merge.merge_upsert(df, df, MergeSpec(keys=["k"], update=["missing"]))
    with pytest.raises(ValueError):
        MergeSpec(keys=[])
    with pytest.raises(ValueError):
        MergeSpec(keys=["k"], null_safe=["l"])


def test_merge_against_brute_force_and_idempotence(spark):
    draw = random.Random(7)
    target = {str(i): (draw.randint(0, 9), draw.choice("xyz")) for i in range(300)}
    source = {str(i): (draw.randint(10, 19), None) for i in draw.sample(range(600), 200)}

    def frame(data):
        return spark.createDataFrame([(k, "1", v, w) for k, (v, w) in data.items()], FIELDS)

    spec = MergeSpec(keys=["k"])
    want = rows(frame({**target, **source}))
    full = merge.merge_upsert(frame(target), frame(source), spec)
    assert rows(full) == want
    gone = spark.createDataFrame([(str(i), "1") for i in range(0, 600, 7)] + [(None, "1")], "k string, l string")
    left = {k: v for k, v in {**target, **source}.items() if int(k) % 7}
    assert rows(merge.merge_upsert(frame(target), frame(source), MergeSpec(keys=["k", "l"]), deleted=gone)) == rows(frame(left))
    assert rows(merge.merge_staged(frame(target), frame(source), spec)) == want
    assert rows(merge.merge_upsert(full, frame(source), spec)) == want


def test_delete_ignores_null_keys(spark):
    target = spark.createDataFrame([("a", "1", 1, "x"), (None, "1", 2, "y")], FIELDS)
    gone = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r.v for r in merge.delete_by_keys(target, gone, ["k"]).collect()] == [2]


def test_tombstone_blanks_payload(spark):
    df = spark.createDataFrame(
        [("a", "c1", 1, "U"), ("b", "c2", 2, "I")], "id string, client string, v int, OPFLAG string"
    ).withColumn("at", F.lit("2020-01-01"))
    gone = spark.createDataFrame([("a",), ("a",)], "id string")
    got = changes.tombstone_update(df, gone, ["id"], ["client"], {"at": "'2024-01-01'"})
    assert sorted(map(tuple, got.collect())) == [
        ("a", "c1", None, "D", "2024-01-01"), ("b", "c2", 2, "I", "2020-01-01"),
    ]


def test_effective_action(spark):
    df = spark.createDataFrame([("2024-01-01", "I"), ("2024-01-02", "I"), ("2024-01-03", None)], "at string, OPFLAG string")
    df = df.withColumn("ingested_at", F.col("at").cast("timestamp"))
    got = changes.with_effective_action(df, "2024-01-02").orderBy("at").collect()
    assert [r.OPFLAG for r in got] == ["U", "I", None]


def test_parent_child_join_equals_left_join_with_a_hot_parent(spark):
    parents = spark.range(40).selectExpr("cast(id as string) AS p", "id AS payload").unionByName(
        spark.createDataFrame([(None, 99)], "p string, payload long")
    )
    children = spark.range(900).selectExpr(
        "CASE WHEN id < 300 THEN '3' WHEN id < 310 THEN NULL ELSE cast(id % 60 as string) END AS c", "id AS line"
    )
    got = joins.parent_child_join(parents, children, {"p": "c"})
    want = parents.join(children, F.col("p") == F.col("c"), "left").drop("c")
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        joins.parent_child_join(parents, children.withColumnRenamed("line", "Payload"), {"p": "c"})


def test_lookup_join_spreads_missing_keys_without_matching_them(spark):
    left = spark.range(50).selectExpr(
        "cast(id as string) AS id", "CASE WHEN id % 3 = 0 THEN NULL ELSE cast(id as string) END AS k"
    )
    right = spark.createDataFrame([("1", 10), ("1", 11), ("2", 20), (None, 99)], "k string, v int")
    got = joins.lookup_join(left, Lookup(right, {"k": "k"}, {"v": "value"}), spread_by="id")
    want = left.join(right.withColumnRenamed("v", "value"), "k", "left").select("id", "k", "value")
    assert rows(got) == rows(want)


def test_spreading_compares_keys_as_they_are(spark):
    left = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "c")], "k double, id string")
    step = Lookup(spark.createDataFrame([(1, "one"), (3, "three")], "k int, v string"), {"k": "k"}, {"v": "v"})
    assert rows(joins.lookup_join(left, step, spread_by="id")) == rows(joins.lookup_join(left, step))
    assert joins.lookup_join(left, step, spread_by="id").filter("v IS NOT NULL").count() == 2


def test_lookup_join_spreads_rows_that_miss_a_later_key(spark):
    left = spark.range(900).selectExpr(
        "cast(id as string) AS id", "'2024' AS year", "CASE WHEN id < 300 THEN NULL ELSE cast(id % 5 as string) END AS k"
    )
    right = spark.createDataFrame([("2024", "1", 10), ("2024", None, 20), (None, "2", 30)], "year string, k string, v int")
    step = Lookup(right, {"year": "year", "k": "k"}, {"v": "v"})
    want = left.join(right, ["year", "k"], "left").select("id", "year", "k", "v")
    assert rows(joins.lookup_join(left, step, spread_by="id")) == rows(want)


def test_repeated_lookup_rows_can_be_reduced_first(spark):
    left = spark.createDataFrame([("1",), ("2",), ("9",)], "k string")
    right = spark.range(900).selectExpr("CASE WHEN id < 300 THEN '1' ELSE cast(id % 7 AS string) END AS k", "1 AS v")
    every = joins.lookup_join(left, Lookup(right, {"k": "k"}, {"v": "v"}))
    once = joins.lookup_join(left, Lookup(right, {"k": "k"}, {"v": "v"}, copies=False))
    assert every.count() > 300
    assert rows(once) == rows(every.distinct())


def test_keys_follow_references(spark):
    lines = spark.createDataFrame([("l1", "h1"), ("l2", "h2"), ("l3", "h1"), ("l4", None)], "line string, header string")
    headers = spark.createDataFrame([("h1", "m1"), ("h2", "m2"), ("h3", "m1")], "id string, move string")
    moved = spark.createDataFrame([("m1",), ("m1",), (None,)], "m string")
    hit = keys.keys_through(moved, [(headers, {"move": "m"}), (lines, {"header": "id"})], ["line"])
    assert sorted(r.line for r in hit.collect()) == ["l1", "l3"]


def test_numbering_equals_row_number_with_a_hot_group(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id < 1000 THEN 'hot' WHEN id < 1010 THEN NULL ELSE concat('g', id % 37) END AS g",
        "(id * 7919) % 500 AS t", "id",
    ).repartition(7)
    got = number_rows(df, ["g"], ["t", "id"], "n")
    want = df.selectExpr("*", "cast(row_number() OVER (PARTITION BY g ORDER BY t, id) AS bigint) AS n")
    assert rows(got) == rows(want)
