"""The run log: which workflow ran when, and from where the next delta starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.operators.ranking import number_rows

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("project_name", T.StringType()),
        T.StructField("process_order", T.IntegerType()),
        T.StructField("process_name", T.StringType()),
        T.StructField("workflow", T.StringType()),
        T.StructField("workflow_job_id", T.LongType()),
        T.StructField("run_start", T.TimestampType()),
        T.StructField("run_update", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

STARTED, COMPLETED = "started", "completed"


def renumber_runs(log: DataFrame, workflow: str = "workflow") -> DataFrame:
    """Number the runs of each workflow from 1 in order of start, then old run id.

    A run that has no id yet comes after the runs that started at the same moment.
    """
    ordered = log.withColumn("_no_id", F.col("run_id").isNull()).withColumn("_old_id", F.col("run_id"))
    numbered = number_rows(ordered, [workflow], ["run_start", "_no_id", "_old_id"], "run_id")
    return numbered.select(*log.columns)


def run_log_start(
    log: DataFrame,
    workflow: str,
    project_name: str,
    process_order: int,
    process_name: str,
    workflow_job_id: int,
    as_of,
) -> DataFrame:
    """The workflow's log slice with a started run appended and ids renumbered."""
    kinds = {f.name: f.dataType for f in log.schema.fields}
    moment = F.lit(as_of).cast("timestamp")
    values = {
        "run_id": F.lit(None),
        "project_name": F.lit(project_name),
        "process_order": F.lit(process_order),
        "process_name": F.lit(process_name),
        "workflow": F.lit(workflow),
        "workflow_job_id": F.lit(workflow_job_id),
        "run_start": moment,
        "run_update": moment,
        "status": F.lit(STARTED),
    }
    row = log.sparkSession.range(1).select(*[values[c].cast(kinds[c]).alias(c) for c in log.columns])
    return renumber_runs(log.filter(F.col("workflow") == workflow).unionByName(row))


def run_log_end(log: DataFrame, as_of, workflow: str | None = None) -> DataFrame:
    """Mark the highest run of the workflow (of each workflow by default) as completed."""
    if workflow is not None:
        log = log.filter(F.col("workflow") == workflow)
    last = log.groupBy("workflow").agg(F.max("run_id").alias("run_id")).withColumn("_last", F.lit(True))
    ended = F.col("_last").isNotNull()
    kind = log.schema["run_update"].dataType
    return log.join(last, ["workflow", "run_id"], "left").select(
        *[c for c in log.columns if c not in ("run_update", "status")],
        F.when(ended, F.lit(as_of).cast(kind)).otherwise(F.col("run_update")).alias("run_update"),
        F.when(ended, F.lit(COMPLETED)).otherwise(F.col("status")).alias("status"),
    ).select(*log.columns)


def latest_completed(log: DataFrame) -> DataFrame:
    """Start of the highest completed run of each workflow (no row if none completed)."""
    done = log.filter(F.col("status") == COMPLETED)
    return done.groupBy("workflow").agg(F.max_by("run_start", "run_id").alias("watermark"))


def watermark_lookup(log: DataFrame, workflow: str, earliest="0001-01-01 00:00:00") -> DataFrame:
    """One row, one column: where the next delta of a workflow starts.

    Without a completed run it is ``earliest``, so that the next delta reads everything.
    """
    done = log.filter((F.col("workflow") == workflow) & (F.col("status") == COMPLETED))
    kind = log.schema["run_start"].dataType
    found = F.max_by("run_start", "run_id")
    return done.agg(F.coalesce(found, F.lit(earliest).cast(kind)).alias("watermark"))
