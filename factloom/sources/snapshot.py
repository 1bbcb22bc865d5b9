"""Published tables as Parquet snapshots.

A full load writes a new version folder; readers take the newest version that Spark's
committer has marked complete, so a failed load never shows. A delta rewrites only the
slices it touches.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.evolve import common_schema, widened
from factloom.operators.keys import join_keys, sieved
from factloom.operators.merge import Upsert, assert_unique_keys, merge_upsert
from factloom.sources.catalog import register_table
from factloom.sources.workspace import scratch, stage
from factloom.spec import MergeSpec, quoted


def overwrite_slices(df: DataFrame, path: str, slice_by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; other partitions stay.

    Rows are gathered by slice first, so that a slice does not get a file from every
    task; adaptive execution still divides a slice that is much larger than others.
    ``df`` must not read from ``path``: stage it first. Empty text in a slice column is
    an error, as a folder name cannot tell it from NULL.
    """
    (
        _sliceable(df, slice_by)
        .hint("rebalance", *slice_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slice_by)
        .parquet(path)
    )


def _sliceable(df: DataFrame, slice_by: Sequence[str]) -> DataFrame:
    """The rows, failing at the first with empty text in a slice column."""
    checked = {
        c: F.when(F.col(quoted(c)) == "", F.raise_error(F.lit(f"empty text in slice column {c}"))).otherwise(F.col(quoted(c)))
        for c in slice_by
        if df.schema[c].dataType.simpleString() == "string"
    }
    return df.withColumns(checked) if checked else df


class SnapshotTable:
    """A versioned Parquet table under one folder.

    ``slice_by`` names the partition columns; a mapping also gives their types, which
    are text otherwise (folder names alone would turn ``'0110'`` into a number).
    """

    def __init__(
        self, spark: SparkSession, path: str, slice_by: Sequence[str] | Mapping[str, str] = ()
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        types = slice_by if isinstance(slice_by, Mapping) else dict.fromkeys(slice_by, "string")
        self.slice_types = dict(types)
        self.slice_by = tuple(types)

    def _folder(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self) -> list[tuple[int, str, int]]:
        root, fs = self._folder(self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("version-"):
                found.append((int(name[8:]), f"{self.path}/{name}", status.getModificationTime()))
        return sorted(found)

    def _complete(self, path: str) -> bool:
        marker, fs = self._folder(f"{path}/_SUCCESS")
        return fs.exists(marker)

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        return [number for number, path, _ in self._entries() if self._complete(path)]

    def current_path(self) -> str:
        """Folder of the newest complete version."""
        for _, path, _ in reversed(self._entries()):
            if self._complete(path):
                return path
        raise FileNotFoundError(f"no complete version under {self.path}")

    def read(self) -> DataFrame:
        """The newest complete version.

        All files of a version have one schema (a merge never adds columns), so one
        footer tells it, however many files there are.
        """
        return self._read(self.current_path())

    def _read(self, path: str) -> DataFrame:
        if not self.slice_by:
            return self.spark.read.parquet(path)
        found = self.spark.read.parquet(path)
        typed = found.selectExpr(
            *[
                f"CAST({quoted(f.name)} AS {self.slice_types.get(f.name, f.dataType.simpleString())}) AS {quoted(f.name)}"
                for f in found.schema.fields
            ]
        )
        return self.spark.read.schema(typed.schema).parquet(path)

    def overwrite(self, df: DataFrame) -> "SnapshotTable":
        """Full load: write a new version. The new rows may be computed from the old ones."""
        return self._write(_sliceable(df, self.slice_by).hint("rebalance", *self.slice_by) if self.slice_by else df)

    def _write(self, df: DataFrame, file_rows: int = 0) -> "SnapshotTable":
        entries = self._entries()
        number = entries[-1][0] + 1 if entries else 1
        writer = df.write.mode("errorifexists").option("maxRecordsPerFile", file_rows)
        if self.slice_by:
            writer = writer.partitionBy(*self.slice_by)
        writer.parquet(f"{self.path}/version-{number:08d}")
        return self

    def overwrite_evolving(self, df: DataFrame) -> "SnapshotTable":
        """Full load whose schema also keeps the columns of the current version, if there is one.

        A column whose type changed takes one that holds the values of both versions; where there is none, a
        ``TypeConflictError`` names the column before anything is written.
        """
        if not self.versions():
            return self.overwrite(df)
        return self.overwrite(widened(df, common_schema(df.schema, self.read().schema)))

    def read_version(self, number: int) -> DataFrame:
        """A complete version by its number, with its own columns and types."""
        path = f"{self.path}/version-{number:08d}"
        if not self._complete(path):
            raise FileNotFoundError(f"no complete version {number} under {self.path}")
        return self._read(path)

    def merge(self, source: DataFrame, spec: MergeSpec, deleted: DataFrame | None = None) -> "SnapshotTable":
        """Upsert, then delete by key. Delete wins over upsert.

        The source is written once and used from there. Only the slices that the source
        or a deleted key touches are read, merged and replaced. When the slice columns are
        (not null-safe) keys, the source itself names them. Otherwise a row may move to
        another slice: a scan of the key and slice columns alone finds where the
        rows to be replaced are, and the source tells where they go. (A table without slices,
        or a merge that stamps or leaves out a slice column, is rewritten whole.)

        The rows of touched slices are read once: kept ones are written with a mark for
        those that the source had, and what was written tells which source rows are new.
        Rows that a sieve of the changed and deleted keys holds back are copied as they lie, without a shuffle.
        All are complete in the table's ``pending`` folder before any slice is replaced, whose files then move into
        the slices; a merge that was interrupted there is finished by the next one, or by :meth:`finish_pending`.
        """
        with scratch(self.spark):
            return self._merge(source, spec, deleted)

    def _merge(self, source: DataFrame, spec: MergeSpec, deleted: DataFrame | None) -> "SnapshotTable":
        self.finish_pending()
        source = stage(source, "merge-source")
        assert_unique_keys(source, spec.keys, spec.null_safe)
        if deleted is not None:
            deleted = stage(deleted.select(*[quoted(k) for k in spec.keys]), "merge-deletes")
        current = self.read()
        by_key = set(self.slice_by) <= set(spec.keys) - set(spec.null_safe)
        written = set(source.columns) - set(spec.stamp)
        for columns in (spec.update, spec.insert):
            written &= set(source.columns if columns is None else columns)
        if not self.slice_by or not (by_key or set(self.slice_by) <= written):
            return self.overwrite(merge_upsert(current, source, spec, check_unique=False, deleted=deleted))
        columns = [quoted(c) for c in self.slice_by]
        places = [source.select(*columns)]
        if not by_key:
            places.append(self._places(current, source, spec))
        if deleted is not None:
            places.append(deleted.select(*columns) if by_key else self._places(current, deleted, spec))
        touched = self._touched(reduce(DataFrame.unionByName, places))
        located = self._slices(current.withColumn("_file", F.col("_metadata.file_path")), touched)
        self._pend(Upsert(located.drop("_file"), source, spec, deleted, staged=True, gather=self.slice_by), located)
        return self.finish_pending()

    def _places(self, current: DataFrame, keyed: DataFrame, spec: MergeSpec) -> DataFrame:
        """Slices of the rows that have one of the keys."""
        narrow = current.select(*[quoted(c) for c in dict.fromkeys([*spec.keys, *self.slice_by])])
        narrow = (narrow if spec.null_safe else sieved(narrow, keyed, {k: k for k in spec.keys})).alias("t")
        same = [f"{quoted(k, 't')} {'<=>' if k in spec.null_safe else '='} {quoted(k, 's')}" for k in spec.keys]
        found = narrow.join(join_keys(keyed, spec.keys).alias("s"), F.expr(" AND ".join(same)), "left_semi")
        return found.select(*[quoted(c) for c in self.slice_by])

    def _touched(self, rows: DataFrame) -> DataFrame:
        """The slices of some rows. The filter on a written column lets Spark expect that they prune."""
        return stage(join_keys(rows, self.slice_by).withColumn("_touched", F.lit(1)), "touched-slices").filter("_touched > 0")

    def _slices(self, current: DataFrame, touched: DataFrame) -> DataFrame:
        """Rows of the touched slices. The semi join prunes partitions while Spark plans the scan.

        Rows without a slice match nothing there; they are read whenever such rows are touched.
        """
        unnamed = " OR ".join(f"{quoted(c)} IS NULL" for c in self.slice_by)
        named = current.join(touched, list(self.slice_by), "left_semi").select(*[quoted(c) for c in current.columns])
        return named if touched.filter(unnamed).isEmpty() else named.unionByName(current.filter(unnamed))

    def _pend(self, halves: Upsert, slices: DataFrame) -> None:
        """Write what is to be replaced; the commit marker of the last part makes it count.

        The mark is a folder, so that the files hold the table's columns alone. The files that are read are listed
        beside, to be deleted.
        """
        self._write_read(slices)
        self._write_pending(halves.kept("_matched"), "kept")
        schema = halves.target.schema.add("_matched", "boolean")
        matched = self.spark.read.schema(schema).parquet(f"{self.path}/pending/kept").filter("_matched")
        self._write_pending(halves.inserted(join_keys(matched, halves.spec.keys)).withColumn("_matched", F.lit(False)), "new")

    def _write_pending(self, rows: DataFrame, part: str) -> None:
        rows = _sliceable(rows, self.slice_by).write.mode("overwrite")
        rows.partitionBy("_matched", *self.slice_by).parquet(f"{self.path}/pending/{part}")

    def _write_read(self, slices: DataFrame) -> None:
        """The files of the slices that are going to be replaced. It opens files, but reads no column."""
        slices.select("_file").distinct().write.mode("overwrite").parquet(f"{self.path}/pending/read")

    def finish_pending(self) -> "SnapshotTable":
        """Replace the slices of a merge whose rows are complete; without one, change nothing.

        The new files move in, then the old ones go, with folders that are left empty. Doing it again, from wherever it
        stopped, leads to the same slices.
        """
        pending, fs = self._folder(f"{self.path}/pending")
        if self._complete(f"{self.path}/pending/new"):
            current = self.current_path()
            for part in ("kept", "new"):
                self._move_in(f"pending/{part}", "_matched", f"{current}", f"merged-{part}")
            for row in self.spark.read.parquet(f"{self.path}/pending/read").toLocalIterator():
                old = self.path_of(row._file)
                fs.delete(old, False)
                if fs.exists(old.getParent()) and not fs.listStatus(old.getParent()):
                    fs.delete(old.getParent(), True)
        if fs.exists(pending):
            fs.delete(pending, True)
        return self

    def _move_in(self, part: str, marker: str, current: str, prefix: str) -> None:
        """Move data files from below ``part/marker=x/`` to their slices' folders; x becomes part of the name, as files of several may share one."""
        root, fs = self._folder(f"{self.path}/{part}")
        made = fs.listFiles(root, True)
        while made.hasNext():
            file = made.next().getPath()
            if file.getName().endswith(".parquet"):
                number, inside = file.toString().rsplit(f"/{part}/{marker}=", 1)[1].split("/", 1)
                folder = f"{current}/{inside}".rsplit("/", 1)[0]
                target, _ = self._folder(f"{folder}/{prefix}-{number}-{file.getName()}")
                fs.mkdirs(target.getParent())
                if not fs.rename(file, target):
                    raise OSError(f"{file} cannot take its place in {folder}")

    def path_of(self, uri: str):
        """A Hadoop path from the text that Spark gives as a file's path."""
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))

    def age_out(self, column: str, first, first_slice: str) -> list[str]:
        """Delete the rows whose ``column`` is before ``first``, in a table sliced by one text that rises with it.

        ``first_slice`` is the slice in which ``first`` lies. Earlier slices are deleted by folder, without reading a
        column; of ``first_slice`` the rows from ``first`` on are kept; all other files stay as they are, and so do rows
        without a slice. Returns the slices deleted.
        """
        if len(self.slice_by) != 1:
            raise ValueError("age_out needs a table that is sliced by one column")
        (name,) = self.slice_by
        with scratch(self.spark):
            self.finish_pending()
            current = self.read().withColumn("_file", F.col("_metadata.file_path"))
            folder = F.regexp_replace("_file", "/[^/]*$", "").alias("_folder")
            dropped = []
            for row in current.filter(F.col(quoted(name)) < first_slice).select(quoted(name), folder).distinct().toLocalIterator():
                path = self.path_of(row._folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
                dropped.append(row[name])
            boundary = current.filter(F.col(quoted(name)) == first_slice)
            old = F.col(quoted(column)) < F.lit(first)
            if not boundary.filter(old).isEmpty():
                self._write_read(boundary)
                left = boundary.drop("_file").filter(~F.coalesce(old, F.lit(False)))
                left = left.withColumn("_matched", F.lit(False))
                self._write_pending(left, "kept")
                self._write_pending(left.limit(0), "new")
                self.finish_pending()
        return sorted(dropped)

    def compact_small(self, target_bytes: int = 128 << 20) -> tuple[int, int]:
        """Pack files below half of ``target_bytes`` into files of about that size, slice by slice; full files stay.

        Returns the number of files before and after. A file that is alone in its slice in being small stays too, so a
        second run changes nothing. New files are complete in the table's ``compacting`` folder before any takes its
        place; a run that was interrupted is finished by the next one, or by :meth:`finish_compacting`. Only paths and
        sizes of undersized files, which Spark lists for every read anyway, come to the driver.
        """
        self.finish_pending().finish_compacting()
        current = self.current_path()
        files = self.files()
        before = files.count()
        packed = (
            files.filter(F.col("file_size") * 2 < target_bytes)
            .withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))
            .selectExpr("*", f"""cast((sum(file_size) OVER (PARTITION BY folder ORDER BY file_path) - file_size) DIV {target_bytes} AS int) AS part""")
            .selectExpr("file_path", "concat(folder, '#', part) AS bin", "count(*) OVER (PARTITION BY folder, part) AS together")
            .filter("together > 1")
        )
        packed = packed.selectExpr("file_path", "dense_rank() OVER (ORDER BY bin) AS bin")
        packed.write.mode("overwrite").parquet(f"{self.path}/compacting/old")
        chosen = self.spark.read.parquet(f"{self.path}/compacting/old")
        paths = [self.path_of(row.file_path).toString() for row in chosen.select("file_path").toLocalIterator()]
        if paths:
            rows = self.spark.read.schema(self.read().schema).option("basePath", current).parquet(*paths)
            binned = rows.withColumn("_file", F.col("_metadata.file_path")).join(
                chosen.withColumnRenamed("file_path", "_file"), "_file"
            )
            bins = chosen.agg(F.max("bin")).first()[0]
            ordered = binned.drop("_file").withColumnRenamed("bin", "_bin").repartition(bins, "_bin")
            ordered.write.mode("overwrite").partitionBy("_bin", *self.slice_by).parquet(f"{self.path}/compacting/new")
        self.finish_compacting()
        return before, self.files().count()

    def files(self) -> DataFrame:
        """Path and size of each data file of the current version; no file is opened."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        return listing.load(self.current_path()).select("_metadata.file_path", "_metadata.file_size")

    def finish_compacting(self) -> "SnapshotTable":
        """Put complete new files in place of those that they replace; doing it again leads to the same files."""
        work, fs = self._folder(f"{self.path}/compacting")
        if self._complete(f"{self.path}/compacting/new"):
            current = self.current_path()
            self._move_in("compacting/new", "_bin", current, "packed")
            for row in self.spark.read.parquet(f"{self.path}/compacting/old").select("file_path").toLocalIterator():
                fs.delete(self.path_of(row.file_path), False)
        if fs.exists(work):
            fs.delete(work, True)
        return self

    def compact(self, file_rows: int = 5_000_000) -> "SnapshotTable":
        """Rewrite the current version into fewer, evenly filled files; same rows.

        Sliced tables are gathered by slice, but large slices are still split, since
        the rebalance hint lets adaptive execution divide them.
        """
        return self._write(self.read().hint("rebalance", *self.slice_by), file_rows)

    def vacuum(self, retain_hours: float = 168.0, registered: Sequence[str] = ()) -> list[int]:
        """Delete versions older than the retention, never the current one; returns them.

        Give the names of tables ``registered`` over this one: they follow to the current
        version first, so that none is left reading a deleted folder.
        """
        current = self.current_path()
        for name in registered:
            register_table(self.spark, name, current, partitioned=bool(self.slice_by))
        limit = (time.time() - retain_hours * 3600) * 1000
        removed = []
        for number, path, changed in self._entries():
            if path != current and path < current and changed <= limit:
                folder, fs = self._folder(path)
                fs.delete(folder, True)
                removed.append(number)
        return removed
