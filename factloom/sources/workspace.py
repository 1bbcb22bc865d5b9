"""The shared folder for intermediate and published tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="factloom-")
    return _local_folders[context.applicationId]


def table_path(spark: SparkSession, name: str) -> str:
    """Path of a named table of this application in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}"


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application staged. Call it when no result is in use any more."""
    _delete(spark, table_path(spark, "stage"))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end: for work whose result is written elsewhere by then.

    Inside another one, the outer one deletes.
    """
    if _scratch.get() is not None:
        yield
        return
    path = table_path(spark, f"stage/scratch-{uuid.uuid4().hex}")
    token = _scratch.set(path)
    try:
        yield
    finally:
        _scratch.reset(token)
        _delete(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write rows once and read them back: lineage ends here, lost executors cost nothing.

    The size of what comes back is known exactly, so Spark broadcasts it in later joins
    if, and only if, it is below the broadcast threshold. The end of :func:`scratch` deletes
    it, or else :func:`clear_stage`.
    """
    spark = df.sparkSession
    path = f"{_scratch.get() or table_path(spark, 'stage')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(**frames: DataFrame) -> list[DataFrame]:
    """:func:`stage` several independent frames at once, so their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        runs = [pool.submit(copy_context().run, stage, df, name.replace("_", "-")) for name, df in frames.items()]
        return [r.result() for r in runs]
