"""The ledger fact from six streams: random batches, repeated batches, failed and repeated drains."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import filters
from factloom.plans import ledger_line
from factloom.plans.ledger_line import CAPTURED, CHANGE_COLUMNS, LedgerFeeds
from factloom.streaming import inbox as inboxes
from factloom.streaming.inbox import LedgerInbox
from tests.compare import spark_bag
from workload.bindings import WATERMARK, ledger_feeds
from workload.facts import EARLIER_SPEC, LEDGER_SPEC

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return spark_bag(df)[1]


class Arrivals:
    """Feeds whose rows since the watermark arrive as files, some at a time."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.feeds = spark, folder, ledger_feeds(spark, FOLDER)
        self.known = replace(self.feeds, **{n: filters.before_watermark(getattr(self.feeds, n), WATERMARK).cache() for n in CAPTURED})

    def arrive(self, part, parts, names=CAPTURED):
        key = {"header": "BELNR", "movement": "MBLNR", "second_quantity": "MBLNR"}
        for n in names:
            fresh = filters.since_watermark(getattr(self.feeds, n), WATERMARK)
            mine = fresh.filter(F.pmod(F.xxhash64(F.col(key.get(n, "DOCLN" if n != "quantity" else "GL_SIRID")), F.lit(n)), F.lit(parts)) == part)
            mine.repartition(2).write.mode("append").parquet(f"{self.folder}/{n}")

    def now(self):
        def all_of(n):
            schema = getattr(self.feeds, n).schema
            return getattr(self.known, n).unionByName(self.spark.read.schema(schema).parquet(f"{self.folder}/{n}"))

        return replace(self.feeds, **{n: all_of(n) for n in CAPTURED})

    def streams(self):
        def one(n):
            reader = self.spark.readStream.schema(getattr(self.feeds, n).schema).option("maxFilesPerTrigger", 1)
            return reader.parquet(f"{self.folder}/{n}")

        return replace(self.feeds, **{n: one(n) for n in CAPTURED})


@pytest.fixture
def arrivals(spark, tmp_path):
    found = Arrivals(spark, f"{tmp_path}/feeds")
    yield found
    for n in CAPTURED:
        getattr(found.known, n).unpersist()


@pytest.fixture
def lines(spark, tmp_path, arrivals):
    table = ledger_line.published_table(spark, f"{tmp_path}/lines")
    ledger_line.publish_full(table, arrivals.known, EARLIER_SPEC)
    return table


def test_batches_of_six_feeds_give_the_rows_of_the_batch_delta(spark, tmp_path, arrivals, lines):
    inbox = LedgerInbox(spark, f"{tmp_path}/inbox")
    pick = np.random.default_rng(3)
    for part in range(2):
        arrivals.arrive(part, 2)
        for n in pick.permutation(CAPTURED):
            inbox.follow(str(n), getattr(arrivals.streams(), n)).awaitTermination()
    taken = inbox.waiting()
    assert set(taken) == set(CAPTURED) and all(len(paths) > 1 for paths in taken.values())
    # No drain has happened: nothing is published yet.
    assert lines.read().filter(f"ingested_at = '{LEDGER_SPEC.as_of}'").count() == 0
    assert inbox.drain(lines, arrivals.now(), LEDGER_SPEC) == sum(map(len, taken.values()))
    assert inbox.waiting() == {}

    batch = ledger_line.published_table(spark, f"{tmp_path}/batch")
    ledger_line.publish_full(batch, arrivals.known, EARLIER_SPEC)
    ledger_line.publish_delta(batch, arrivals.feeds, LEDGER_SPEC, WATERMARK)
    assert rows(lines.read()) == rows(batch.read())


def test_a_drain_that_fails_is_repeated_and_each_drain_equals_a_full_load(spark, tmp_path, arrivals, lines, monkeypatch):
    inbox = LedgerInbox(spark, f"{tmp_path}/inbox")
    arrivals.arrive(0, 2)
    inbox.follow_all(arrivals.streams())
    waiting = inbox.waiting()

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(inboxes, "publish_changes", fails)
        with pytest.raises(RuntimeError, match="lost"):
            inbox.drain(lines, arrivals.now(), LEDGER_SPEC)
    assert inbox.waiting() == waiting

    # Rows that no stream has taken in are there already, and come again with the second drain.
    arrivals.arrive(1, 2, ["quantity", "header"])
    inbox.drain(lines, arrivals.now(), LEDGER_SPEC)
    arrivals.arrive(1, 2, [n for n in CAPTURED if n not in ("quantity", "header")])
    inbox.follow_all(arrivals.streams())
    assert inbox.drain(lines, arrivals.now(), LEDGER_SPEC) > 0
    full = ledger_line.ledger_line_full(arrivals.feeds, LEDGER_SPEC)
    told = ("OPFLAG", "ingested_at", ledger_line.MONTH)
    assert rows(lines.read().drop(*told)) == rows(full.drop(*told))


def test_a_repeated_batch_is_kept_once_and_an_unfinished_one_not_counted(spark, tmp_path):
    inbox = LedgerInbox(spark, f"{tmp_path}/inbox")
    made = spark.range(3).selectExpr(*[f"CAST(id % 2 AS string) AS {c}" for c in CHANGE_COLUMNS["header"]])
    made.write.parquet(f"{tmp_path}/feed")
    stream = spark.readStream.schema(made.schema).parquet(f"{tmp_path}/feed")
    inbox.follow("header", stream).awaitTermination()
    (path,) = inbox.waiting()["header"]
    assert spark.read.parquet(path).count() == 2
    inbox.follow("header", stream).awaitTermination()
    assert inbox.waiting() == {"header": [path]}
    spark.read.parquet(path).coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{tmp_path}/inbox/changed/header/batch-000000000007"
    )
    assert inbox.waiting() == {"header": [path]}
    with pytest.raises(ValueError, match="no feed 'control'"):
        inbox.follow("control", stream)


def test_keys_of_feeds_without_a_batch_are_none(spark, tmp_path):
    feeds = ledger_feeds(spark, FOLDER)
    changed = LedgerInbox(spark, f"{tmp_path}/inbox").changed(feeds, {})
    assert isinstance(changed, LedgerFeeds)
    assert {n: getattr(changed, n).columns for n in CAPTURED} == {n: list(CHANGE_COLUMNS[n]) for n in CAPTURED}
    assert all(getattr(changed, n).count() == 0 for n in CAPTURED)
