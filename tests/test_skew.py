"""Adaptive execution really splits the joins when one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from factloom.operators import changes, joins, keys, merge
from factloom.spec import Lookup, MergeSpec


@pytest.fixture()
def tight(spark):
    """A session in which a few kilobytes already count as skewed."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }.items():
        session.conf.set(name, value)
    return session


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(session, name):
    return session.range(0, 60000, 1, 8).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 2000) END AS {name}", "cast(id AS string) AS id", "uuid() AS text"
    )


def few(session):
    return session.range(2000).selectExpr("concat('k', id) AS k", "id AS v").union(
        session.sql("SELECT 'hot' AS k, cast(-1 AS bigint) AS v")
    )


def test_hot_parent_is_split(tight):
    joined = joins.parent_child_join(few(tight), hot_rows(tight, "c"), {"k": "c"})
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000 + 2001 - hot_rows(tight, "c").select("c").distinct().count()


def test_hot_lookup_key_is_split(tight):
    joined = joins.lookup_join(hot_rows(tight, "c"), Lookup(few(tight), {"c": "k"}, {"v": "v"}), spread_by="id")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000


def test_hot_key_in_a_semi_join_is_split(tight):
    hit = keys.rows_hit(hot_rows(tight, "c"), few(tight), {"c": "k"})
    assert "skew=true" in final_plan(hit)


def test_hot_key_in_a_lookup_without_copies_is_split(tight):
    repeated = few(tight).union(few(tight))
    joined = joins.lookup_join(hot_rows(tight, "c"), Lookup(repeated, {"c": "k"}, {"v": "v"}, copies=False))
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000


@pytest.mark.parametrize("reduced", [False, True])
def test_hot_key_in_deletes_and_tombstones_is_split(tight, reduced):
    gone = few(tight).select("k")
    gone = (gone.distinct() if reduced else gone.union(gone)).withColumnRenamed("k", "c")
    rows = hot_rows(tight, "c")
    assert "skew=true" in final_plan(merge.delete_by_keys(rows, gone, ["c"]))
    assert "skew=true" in final_plan(keys.changed_key_semi_join(rows, gone, ["c"]))
    assert "skew=true" in final_plan(changes.tombstone_update(rows, gone, ["c"], ["id"], action="text"))


def test_hot_key_in_a_merge_is_split(tight):
    target = hot_rows(tight, "c")
    source = few(tight).selectExpr("k AS c", "cast(v AS string) AS id", "'new' AS text")
    merged = merge.merge_upsert(target, source, MergeSpec(keys=["c"]), deleted=few(tight).limit(10).selectExpr("k AS c"))
    assert "skew=true" in final_plan(merged)


def test_missing_keys_are_spread_before_any_splitting(tight):
    left = hot_rows(tight, "c").selectExpr("nullif(c, 'hot') AS c", "id", "text")
    tight.conf.set("spark.sql.adaptive.enabled", "false")
    joined = joins.lookup_join(left, Lookup(few(tight), {"c": "k"}, {"v": "v"}), spread_by="id")
    sizes = [n for n in joined.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    assert sum(sizes) == 60000 and max(sizes) < 60000 / 8


def test_hot_key_of_a_late_lookup_is_split(tight):
    rows = hot_rows(tight, "c").withColumn("d", F.expr("CASE WHEN id % 5 = 0 THEN NULL ELSE id % 7 END"))
    steps = [
        Lookup(few(tight), {"c": "k"}, {"v": "v"}),
        Lookup(tight.range(7).selectExpr("id AS d", "id * 2 AS w"), {"d": "d"}, {"w": "w"}),
    ]
    late = joins.enrich_late(rows.withColumn("text", F.sha2("id", 256)), steps, ["text"])
    assert "skew=true" in final_plan(late)
    assert late.count() == 60000


def test_hot_key_on_one_of_many_paths_is_split(tight):
    rows = hot_rows(tight, "c")
    hit = keys.keys_hit_on_any_path(rows, [(few(tight), {"c": "k"}), (few(tight).limit(3), {"id": "k"})], ["id"])
    assert "skew=true" in final_plan(hit)
    assert hit.count() == 60000
