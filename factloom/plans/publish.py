"""One run of a published fact: from the run log's watermark to the run log's end."""

from __future__ import annotations

from collections.abc import Callable

from factloom.sources.runlog_table import RunLogTable
from factloom.sources.snapshot import SnapshotTable


def run_fact(
    runs: RunLogTable,
    table: SnapshotTable,
    workflow: str,
    full: Callable[[SnapshotTable], None],
    delta: Callable[[SnapshotTable, object], None],
    project: str = "project",
    process_order: int = 1,
    as_of=None,
) -> str:
    """Start a run, publish, end the run; returns which load it was, ``full`` or ``delta``.

    The first run, and any run before one has completed, is a full load. Later ones read from where the last completed
    run started. A run that fails stays ``started``: the next one begins where this one did, and since merges finish or
    repeat what was interrupted, it leads to the same rows.
    """
    load = "delta" if table.versions() and runs.completed(workflow) else "full"
    runs.start(workflow, project, process_order, load, as_of=as_of)
    if load == "full":
        full(table)
    else:
        delta(table, runs.watermark(workflow))
    runs.end(workflow, as_of=as_of)
    return load
