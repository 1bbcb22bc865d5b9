"""The delta load of the ledger fact from streams: six feeds arrive by themselves, one drain publishes.

A line depends on six feeds, so no feed alone can say when it is derived anew. Every feed is followed by a
stream of its own, with its own checkpoint, whose micro-batches leave in the inbox which keys changed; a drain
takes what lies there, derives the lines reached from the feeds as they are now, merges them, and clears what it took.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from factloom.plans.ledger_line import CAPTURED, CHANGE_COLUMNS, LedgerFeeds, LedgerSpec, publish_changes
from factloom.sources.snapshot import SnapshotTable
from factloom.spec import quoted


class LedgerInbox:
    """Changed keys of the six captured feeds, under one folder that every executor can reach.

    A micro-batch is one folder of distinct keys, named after its number. It counts once Spark's commit marker is in it, and
    is then never written again, so a batch that is repeated after a failure adds nothing, and one that was drained
    already only has its lines derived once more.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self, path: str) -> bool:
        marker, fs = self._folder(f"{path}/_SUCCESS")
        return fs.exists(marker)

    def follow(self, name: str, rows: DataFrame) -> StreamingQuery:
        """Take in all changes of one feed that are available, then stop; the next call continues there.

        ``rows`` is a streaming DataFrame of the feed, which needs only the feed's ``CHANGE_COLUMNS``.
        """
        if name not in CAPTURED:
            raise ValueError(f"no feed {name!r}; there are {', '.join(CAPTURED)}")
        columns = [quoted(c) for c in CHANGE_COLUMNS[name]]

        def keep(batch: DataFrame, number: int) -> None:
            path = f"{self.path}/changed/{name}/batch-{number:012d}"
            if not self._complete(path):
                batch.distinct().write.mode("overwrite").parquet(path)

        return (
            rows.select(*columns)
            .writeStream.queryName(f"{name} into {self.path}")
            .foreachBatch(keep)
            .option("checkpointLocation", f"{self.path}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
        )

    def follow_all(self, feeds: LedgerFeeds) -> None:
        """Take in all six feeds at once, and wait for them. All are tried; the first failure is raised."""
        running = [self.follow(name, getattr(feeds, name)) for name in CAPTURED]
        failed = []
        for query in running:
            try:
                query.awaitTermination()
            except Exception as problem:  # noqa: BLE001  (the other feeds are waited for first)
                failed.append(problem)
        if failed:
            raise failed[0]

    def waiting(self) -> dict[str, list[str]]:
        """Folders of the complete batches that no drain has cleared, by feed."""
        found = {}
        for name in CAPTURED:
            folder, fs = self._folder(f"{self.path}/changed/{name}")
            names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
            paths = [f"{self.path}/changed/{name}/{n}" for n in sorted(names) if n.startswith("batch-")]
            found[name] = [p for p in paths if self._complete(p)]
        return {name: paths for name, paths in found.items() if paths}

    def changed(self, feeds: LedgerFeeds, taken: dict[str, list[str]]) -> LedgerFeeds:
        """The changed keys of some batches; none for feeds without one."""
        def keys(name: str) -> DataFrame:
            narrow = getattr(feeds, name).select(*[quoted(c) for c in CHANGE_COLUMNS[name]])
            if name not in taken:
                return narrow.limit(0)
            return self.spark.read.schema(narrow.schema).parquet(*taken[name])

        return replace(feeds, **{name: keys(name) for name in CAPTURED})

    def drain(self, table: SnapshotTable, feeds: LedgerFeeds, spec: LedgerSpec) -> int:
        """Publish what the waiting batches reach; returns how many batches that was.

        ``feeds`` are the source tables as they are now; they may hold rows that no stream has taken in yet, whose keys
        come with a later drain. The batches are cleared once the table is merged: a drain that fails is
        repeated by the next one, and leads to the same rows. One drain at a time; feeds may be followed meanwhile.
        With nothing waiting, the table still lets go of the months that have left the window of ``spec.as_of``.
        """
        taken = self.waiting()
        publish_changes(table, feeds, self.changed(feeds, taken), spec)
        paths = reduce(list.__add__, taken.values(), [])
        for path in paths:
            folder, fs = self._folder(path)
            fs.delete(folder, True)
        return len(paths)
