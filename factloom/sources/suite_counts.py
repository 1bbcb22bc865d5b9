"""Quality counts kept beside a published table, so that a delta re-checks only the slices it touched."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.quality import Check, check_counts, results_of
from factloom.sources.snapshot import SnapshotTable

COUNTS = "folder string, files long, mark long, suite string, check_no long, element_count long, unexpected_count long"


class StoredSuite:
    """A suite over a published table, as counts for each folder of it.

    A folder is known by the names and sizes of its files, which change whenever a merge, an age-out or a compaction
    replaces any of them. Counts that were made by other checks are made anew.
    """

    def __init__(self, table: SnapshotTable, path: str, checks: Sequence[Check]) -> None:
        self.table, self.checks = table, list(checks)
        self.counts = SnapshotTable(table.spark, path)
        self.suite = hashlib.sha256(repr(self.checks).encode()).hexdigest()

    def _stored(self) -> DataFrame:
        if not self.counts.versions():
            return self.table.spark.createDataFrame([], COUNTS)
        return self.counts.read()

    def refresh(self) -> list[str]:
        """Bring the counts to the table's current files; returns the folders whose rows were read for it."""
        spark, current = self.table.spark, self.table.current_path()
        folders = (
            self.table.files()
            .withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))
            .groupBy("folder")
            .agg(F.count("*").alias("files"), F.bit_xor(F.xxhash64("file_path", "file_size")).alias("mark"))
        )
        stored = self._stored().filter(F.col("suite") == self.suite)
        same = ["folder", "files", "mark"]
        kept = stored.join(folders, same, "left_semi")
        # The names of folders that changed; Spark's driver lists the folders of a table for every read of it.
        changed = [r.folder for r in folders.join(stored, same, "left_anti").select("folder").distinct().toLocalIterator()]
        if changed or self._stored().count() != kept.count():
            if changed:
                paths = [self.table.path_of(f).toString() for f in changed]
                rows = spark.read.schema(self.table.read().schema).option("basePath", current).parquet(*paths)
                rows = rows.withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
                made = check_counts(rows, self.checks, ["folder"]).join(folders, "folder")
                kept = kept.unionByName(made.withColumn("suite", F.lit(self.suite)))
            self.counts.overwrite(kept.coalesce(1))
        return sorted(changed)

    def results(self) -> DataFrame:
        """The results of the suite over the whole table, as :func:`factloom.operators.quality.run_checks` gives them."""
        return results_of(self._stored().filter(F.col("suite") == self.suite), self.checks)
