"""The run log as a stored table, one partition per workflow."""

from __future__ import annotations

import hashlib
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.runlog import COMPLETED, RUN_LOG_SCHEMA, run_log_end, run_log_start, watermark_lookup
from factloom.sources.snapshot import overwrite_slices
from factloom.sources.workspace import scratch, stage


class RunLogTable:
    """Starts and ends runs; only the slice of the workflow concerned is replaced, by one caller at a time."""

    def __init__(self, spark: SparkSession, path: str, claim_seconds: float = 900.0):
        self.spark = spark
        self.path = path.rstrip("/")
        self.claim_seconds = claim_seconds

    def read(self) -> DataFrame:
        """All runs; empty before the first start."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], RUN_LOG_SCHEMA)
        return self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path)

    def _now(self, as_of):
        """The moment to record: as given, or the session's clock."""
        return self.spark.sql("SELECT CAST(current_timestamp() AS string)").first()[0] if as_of is None else as_of

    def start(
        self, workflow: str, project_name: str, process_order: int, process_name: str, job_id: int | None = None, as_of=None
    ) -> None:
        """Append a started run and renumber the workflow's runs."""
        moment = self._now(as_of)
        with self._claimed(workflow):
            runs = run_log_start(self.read(), workflow, project_name, process_order, process_name, job_id, moment)
            self._replace(runs)

    def end(self, workflow: str, as_of=None) -> None:
        """Mark the workflow's highest run as completed."""
        moment = self._now(as_of)
        with self._claimed(workflow):
            self._replace(run_log_end(self.read(), moment, workflow))

    def completed(self, workflow: str) -> bool:
        """Whether any run of the workflow has completed."""
        return not self.read().filter((F.col("workflow") == workflow) & (F.col("status") == COMPLETED)).isEmpty()

    def watermark(self, workflow: str) -> DataFrame:
        """One row: where the workflow's next delta starts.

        The last run that completed counts, so a run in progress reads from the start of
        the one before it.
        """
        return watermark_lookup(self.read().filter(F.col("workflow") == workflow), workflow)

    @contextmanager
    def _claimed(self, workflow: str) -> Iterator[None]:
        """Inside, nobody else changes the workflow's slice: reading, numbering and replacing are one step.

        The claim is a file beside the log that only one caller can create. Others wait; a claim older than
        ``claim_seconds`` belongs to a run that died, and is taken over.
        """
        claim = f"{self.path}.claims/{hashlib.sha256(workflow.encode()).hexdigest()}"
        while not self._created(claim):
            time.sleep(0.1)
        try:
            yield
        finally:
            hadoop, fs = self._file(claim)
            fs.delete(hadoop, False)

    def _file(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _created(self, claim: str) -> bool:
        """Whether this call created the file; stale ones are removed on the way."""
        hadoop, fs = self._file(claim)
        if fs.exists(hadoop):
            if time.time() * 1000 - fs.getFileStatus(hadoop).getModificationTime() > self.claim_seconds * 1000:
                fs.delete(hadoop, False)
            return False
        fs.mkdirs(hadoop.getParent())
        if fs.getUri().getScheme() == "file":
            # The local file system looks first and creates then; the operating system does both at once.
            try:
                os.close(os.open(hadoop.toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        try:
            fs.create(hadoop, False).close()
        except Py4JJavaError:
            if fs.exists(hadoop):
                return False
            raise
        return True

    def _replace(self, runs: DataFrame) -> None:
        with scratch(self.spark):
            overwrite_slices(stage(runs, "run-log"), self.path, ["workflow"])
