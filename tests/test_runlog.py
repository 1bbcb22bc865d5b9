"""The run log and the watermark it supplies."""

from factloom.operators import runlog

START = "2024-01-0{} 00:00:00"


def log(spark, *runs):
    rows = [
        (run_id, "p", 1, "load", workflow, 7, start, start, status) for run_id, workflow, start, status in runs
    ]
    text = "run_id long, project_name string, process_order int, process_name string, workflow string, " \
        "workflow_job_id long, run_start string, run_update string, status string"
    df = spark.createDataFrame(rows, text)
    return df.withColumns({c: df[c].cast("timestamp") for c in ("run_start", "run_update")}).to(runlog.RUN_LOG_SCHEMA)


def ids(df):
    return sorted((r.workflow, r.run_id, str(r.run_start), r.status) for r in df.collect())


def test_start_appends_and_renumbers_only_its_workflow(spark):
    before = log(
        spark, (5, "a", START.format(2), "completed"), (2, "a", START.format(1), "completed"),
        (1, "b", START.format(3), "completed"),
    )
    after = runlog.run_log_start(before, "a", "p", 1, "load", 7, START.format(4))
    assert after.schema.names == before.schema.names
    assert ids(after) == [
        ("a", 1, START.format(1), "completed"), ("a", 2, START.format(2), "completed"), ("a", 3, START.format(4), "started"),
    ]


def test_first_run_of_a_workflow(spark):
    after = runlog.run_log_start(log(spark, (1, "b", START.format(1), "completed")), "a", "p", 1, "load", 7, START.format(2))
    assert ids(after) == [("a", 1, START.format(2), "started")]


def test_end_completes_the_highest_run(spark):
    before = log(spark, (1, "a", START.format(1), "started"), (2, "a", START.format(2), "started"), (1, "b", START.format(1), "started"))
    after = runlog.run_log_end(before, START.format(5), "a")
    got = sorted((r.run_id, r.status, str(r.run_update)) for r in after.collect())
    assert got == [(1, "started", START.format(1)), (2, "completed", START.format(5))]
    assert after.columns == before.columns


def test_watermark_skips_runs_that_did_not_complete(spark):
    runs = log(
        spark, (1, "a", START.format(1), "completed"), (2, "a", START.format(2), "completed"),
        (3, "a", START.format(3), "started"), (9, "b", START.format(4), "completed"),
    )
    assert str(runlog.watermark_lookup(runs, "a").first().watermark) == START.format(2)
    latest = {r.workflow: str(r.watermark) for r in runlog.latest_completed(runs).collect()}
    assert latest == {"a": START.format(2), "b": START.format(4)}


def test_no_completed_run_means_everything(spark):
    runs = log(spark, (1, "a", START.format(1), "started"))
    found = runlog.watermark_lookup(runs, "a", "1900-01-01 00:00:00").first()
    assert str(found.watermark) == "1900-01-01 00:00:00"
    assert runlog.latest_completed(runs).count() == 0


def test_stored_log_over_several_runs(spark, tmp_path):
    from factloom.operators.filters import since_watermark, watermark_text
    from factloom.sources.runlog_table import RunLogTable

    runs = RunLogTable(spark, f"{tmp_path}/log")
    assert runs.read().count() == 0
    runs.start("0042", "p", 1, "load", as_of=START.format(1))
    facts = spark.createDataFrame([(START.format(d),) for d in (1, 2, 3)], "at string").selectExpr(
        "CAST(at AS timestamp) AS ingested_at"
    )
    assert since_watermark(facts, runs.watermark("0042")).count() == 3  # nothing completed: everything
    runs.end("0042", as_of=START.format(2))
    runs.start("other", "p", 1, "load", as_of=START.format(3))
    runs.start("0042", "p", 1, "load", as_of=START.format(3))
    assert ids(runs.read()) == [
        ("0042", 1, START.format(1), "completed"), ("0042", 2, START.format(3), "started"), ("other", 1, START.format(3), "started"),
    ]
    assert since_watermark(facts, runs.watermark("0042")).count() == 3
    runs.end("0042")
    assert since_watermark(facts, runs.watermark("0042")).count() == 1
    assert START.format(3) in watermark_text(facts, "ingested_at", runs.watermark("0042"))
    assert {(r.workflow, r.status) for r in runs.read().collect() if r.workflow == "other"} == {("other", "started")}
