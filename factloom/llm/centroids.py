"""Lloyd's centroids with the dimensions dealt over the tasks.

Vectors are packed by some thousand into chunks and cut into blocks of columns; a record is one block of one chunk.
A record meets nothing but the slice of the centroids for its own columns: it gives exact partial distances, which
are added over the blocks of a chunk, where the nearest centroid is taken; then it gives the sums of its columns by
nearest centroid, and every block's new slice comes from the sums of that block alone. No task and not the driver
holds whole vectors, all labels or all centroids, and all arithmetic is on integers, so that results are exact and do
not depend on how the table is dealt.

Records are stored in buckets by chunk: a round shuffles partial distances and labels, never the vectors.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.sources.workspace import stage, table_path

#: Components are integers within +-LARGEST, so that the squared distance of up to 256 components fits 64 bits.
LARGEST = 1 << 26
MOST_COMPONENTS = 256

RECORD = "chunk long, block int, size int, data binary"


def usable(column: str, components: int) -> Column:
    """Whether a vector has exactly so many components, none of them NULL, NaN or infinite."""
    value = F.col(column)
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce((F.size(value) == components) & fine, F.lit(False))


def whole_numbers(column: str, scale: int) -> Column:
    """Every component x as the integer floor(scale * x), held within +-LARGEST."""
    return F.transform(
        column,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long"),
    )


def records(vectors: DataFrame, width: int, chunk_rows: int) -> DataFrame:
    """Blocks of chunks of ``vectors`` (id, values); the ids of a chunk are its block -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for cut in range(0, len(whole), chunk_rows):
                batch = whole.slice(cut, chunk_rows)
                values = batch.column("values").flatten().to_numpy().reshape(len(batch), -1).astype("<i4")
                ids = batch.column("id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                parts = [ids.fill_null(0).to_numpy().astype("<i8").tobytes() + known.tobytes()]
                parts += [np.ascontiguousarray(values[:, a : a + width]).tobytes() for a in range(0, values.shape[1], width)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * n, pa.int64()),
                        pa.array(range(-1, n - 1), pa.int32()),
                        pa.array([len(batch)] * n, pa.int32()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["chunk", "block", "size", "data"],
                )
                chunk += 1

    return vectors.mapInArrow(run, RECORD)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def partial_distances(blocks: DataFrame, slices: DataFrame, k: int) -> DataFrame:
    """Squared distances over the columns of a block, to each of the ``k`` centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            x = np.frombuffer(row["data"], "<i4").reshape(row["size"], -1).astype(np.int64)
            c = np.array(row["slice"], np.int64).reshape(k, -1)
            out = np.empty((len(x), k), "<i8")
            for j in range(k):
                off = x - c[j]
                np.einsum("ij,ij->i", off, off, out=out[:, j])
            yield _batch(
                {
                    "chunk": ([row["chunk"]], pa.int64()),
                    "size": ([row["size"]], pa.int32()),
                    "distances": ([out.tobytes()], pa.binary()),
                }
            )

    return blocks.join(slices, "block").mapInArrow(run, "chunk long, size int, distances binary")


def nearest(distances: DataFrame, k: int) -> DataFrame:
    """Adds up the blocks of each chunk: the nearest centroid (ties: the smaller number) and the distance to it."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros((rows.column("size")[0].as_py(), k), np.int64)
        for data in rows.column("distances"):
            total += np.frombuffer(data.as_buffer(), "<i8").reshape(-1, k)
        label = total.argmin(axis=1)
        return pa.Table.from_batches(
            [
                _batch(
                    {
                        "chunk": ([key[0].as_py()], pa.int64()),
                        "labels": ([label.astype("<u2").tobytes()], pa.binary()),
                        "distance": ([total[np.arange(len(total)), label].astype("<i8").tobytes()], pa.binary()),
                    }
                )
            ]
        )

    # A chunk has one small row for each block, however many vectors there are.
    return distances.groupBy("chunk").applyInArrow(run, "chunk long, labels binary, distance binary")


def column_sums(blocks: DataFrame, labels: DataFrame, k: int, width: int) -> DataFrame:
    """For each block, centroid and column: the sum over the vectors that are nearest to the centroid, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}

        def sent() -> pa.RecordBatch:
            rows = [(b, j, d, int(s), int(counts[b][j])) for b, x in sums.items() for j in range(k) for d, s in enumerate(x[j]) if counts[b][j]]
            names = ("block", "centroid", "place", "total", "n")
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            sums.clear()
            return _batch({c: ([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types, strict=True))})

        for row in _rows(batches):
            x = np.frombuffer(row["data"], "<i4").reshape(row["size"], -1).astype(np.int64)
            label = np.frombuffer(row["labels"], "<u2").astype(np.int64)
            b = row["block"]
            if b not in sums:
                if len(sums) * k * width >= 1 << 18:
                    yield sent()
                sums[b], counts[b] = np.zeros((k, x.shape[1]), np.int64), np.zeros(k, np.int64)
            order = np.argsort(label, kind="stable")
            there, first = np.unique(label[order], return_index=True)
            sums[b][there] += np.add.reduceat(x[order], first, axis=0)
            counts[b] += np.bincount(label, minlength=k)
        if sums:
            yield sent()

    per_task = blocks.join(labels.select("chunk", "labels"), "chunk").mapInArrow(
        run, "block int, centroid int, place int, total long, n long"
    )
    return per_task.groupBy("block", "centroid", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def as_slices(centroids: DataFrame) -> DataFrame:
    """(block, slice): a block's columns of all centroids, centroid by centroid."""
    cells = F.array_sort(F.collect_list(F.struct("centroid", "place", "value")))
    return centroids.groupBy("block").agg(F.transform(cells, lambda c: c["value"]).alias("slice"))


def start(vectors: DataFrame, k: int, seed: int, width: int) -> DataFrame:
    """The first ``k`` vectors by the hash of seed and id (ties: by their values), in that order, as centroid rows."""
    hashed = vectors.where("id IS NOT NULL").withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = hashed.orderBy("hash", "values").limit(k).select(F.collect_list(F.struct("hash", "values")).alias("all"))
    return first.selectExpr("posexplode(array_sort(all)) AS (centroid, vector)").selectExpr(
        "centroid", "posexplode(vector.values) AS (d, value)"
    ).selectExpr(f"CAST(d DIV {width} AS int) AS block", "centroid", f"d % {width} AS place", "value")


def bucketed(df: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """The rows stored in buckets by chunk in the shared folder, and the name under which the session knows them."""
    spark = df.sparkSession
    name = f"factloom_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "chunk").option("path", table_path(spark, f"stage/{name}")).saveAsTable(name)
    return spark.table(name), name


def lloyd(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
    width: int = 16,
    chunk_rows: int = 4096,
) -> tuple[DataFrame, DataFrame]:
    """Clusters the vectors that have exactly ``components`` components, none NULL, NaN or infinite.

    A component x counts as floor(scale * x), held within +-2**26. The first centroids are the ``k`` vectors with the
    smallest hash of seed and id; each round assigns every vector to the nearest one (squared distance, ties to the
    smaller number) and replaces every centroid that has vectors by the floors of their means; at last all vectors are
    assigned once more. Blocks have ``width`` columns.

    Returns the vectors' rows (``id``, ``cluster``, ``distance``) and the centroids (block, centroid, place, value).
    Every row counts, repeated ones too; a vector without an id is assigned, but never a first centroid. Fewer vectors
    than ``k`` give fewer centroids, none give no rows. Other columns are ignored, whatever their names.
    """
    if not 0 < components <= MOST_COMPONENTS or k > 1 << 16:
        raise ValueError(f"at most {MOST_COMPONENTS} components and 65,536 centroids")
    spark = vectors.sparkSession
    kept = vectors.where(usable(vector_column, components)).select(
        F.col(id_column).cast("long").alias("id"), whole_numbers(vector_column, scale).alias("values")
    )
    centroids = stage(start(kept, k, seed, width), "centroids")
    k = centroids.agg(F.countDistinct("centroid")).first()[0]
    if not k:
        return spark.createDataFrame([], "id long, cluster int, distance long"), centroids
    packed, name = bucketed(records(kept, width, chunk_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        ids, blocks = packed.where("block = -1"), packed.where("block >= 0")
        for _ in range(rounds):
            labels = nearest(partial_distances(blocks, as_slices(centroids), k), k)
            sums = column_sums(blocks, labels, k, width)
            means = "(total - pmod(total, n)) DIV n"  # DIV cuts towards zero; the difference is a multiple of n
            moved = centroids.join(sums, ["block", "centroid", "place"], "left").selectExpr(
                "block", "centroid", "place", f"coalesce({means}, value) AS value"
            )
            centroids = stage(moved, "centroids")
        labels = nearest(partial_distances(blocks, as_slices(centroids), k), k)
        assigned = stage(ids.join(labels, "chunk").mapInArrow(_unpacked, "id long, cluster int, distance long"), "assigned")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return assigned, centroids


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        n = row["size"]
        ids, known = np.frombuffer(row["data"], "<i8", n), np.frombuffer(row["data"], bool, offset=8 * n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=~known),
                pa.array(np.frombuffer(row["labels"], "<u2").astype(np.int32)),
                pa.array(np.frombuffer(row["distance"], "<i8")),
            ],
            names=["id", "cluster", "distance"],
        )


def cluster_digest(assigned: DataFrame, centroids: DataFrame, width: int = 16) -> DataFrame:
    """The rows of :func:`lloyd` with the sums of distances and a hash of each final centroid's components."""
    # A centroid has no more cells than a vector has components.
    cells = F.array_sort(F.collect_list(F.struct((F.col("block") * width + F.col("place")).alias("d"), "value")))
    text = F.concat_ws(",", F.transform(cells, lambda c: c["value"].cast("string")))
    hashes = centroids.groupBy(F.col("centroid").alias("cluster")).agg(F.sha2(text, 256).alias("centroid_sha256"))
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # One row for each cluster.
    totals = sums.withColumn("inertia", F.expr("sum(cluster_inertia) OVER ()")).join(hashes, "cluster")
    return assigned.join(totals, "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
