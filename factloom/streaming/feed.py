"""Apply a change feed to a published table as it arrives.

The batch delta load asks the run log where to start; here the streaming checkpoint
remembers it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.filters import split_changes
from factloom.sources.snapshot import SnapshotTable
from factloom.sources.workspace import scratch, shared_dir
from factloom.spec import MergeSpec, quoted


def latest_per_key(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last change of each key. Older versions fall away before the shuffle.

    A change without a time is older than any with one; ties go to the largest hash of the row.
    """
    columns = [quoted(c) for c in changes.columns]
    age = F.struct(F.col(quoted(order)).isNotNull(), F.col(quoted(order)), F.xxhash64(*columns))
    newest = F.max_by(F.struct(*columns), age).alias("_row")
    return changes.groupBy(*[quoted(k) for k in keys]).agg(newest).select("_row.*")


def follow_feed(
    feed: DataFrame,
    table: SnapshotTable,
    spec: MergeSpec,
    order: str,
    name: str,
    derive: Callable[[DataFrame], DataFrame] = lambda changes: changes,
    action: str | None = None,
) -> StreamingQuery:
    """Merge all changes that are available, then stop; the next call continues there.

    ``derive`` turns feed rows into table rows. With an ``action`` column, rows whose last
    action is a delete are removed from the table. Merging the same batch twice changes
    nothing, so a batch that is repeated after a failure does no harm.
    """
    def merge(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        with scratch(batch.sparkSession):
            last = latest_per_key(derive(batch), list(spec.keys), order)
            if action is None:
                table.merge(last, spec)
            else:
                upserts, deletes = split_changes(last, action)
                table.merge(upserts, spec, deleted=deletes.select(*[quoted(k) for k in spec.keys]))

    return (
        feed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{shared_dir(feed.sparkSession)}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
