"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Every tree splits by random orthogonal directions, one for each level, at thresholds that halve a bounded
sample; every vector is then routed to one leaf of each tree. A query walks all trees through one priority
queue, ordered by the squared distance to a node's cell along the split directions, until the leaves it has
reached hold enough vectors. Vectors and queries meet leaf by leaf, where scores are exact.

Largest inner product becomes nearest neighbour by one more coordinate, sqrt(M^2 - |x|^2) with M the largest
norm, which is 0 for queries. How many vectors a query must reach is measured: a bounded set of queries is
also searched by brute force, and the effort is the least that finds the wanted share of their neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.workspace import stage

#: Vectors that the trees are fitted on at most, in components, and queries that the effort is measured with.
FIT_COMPONENTS, MEASURED_QUERIES = 1 << 22, 128
#: Vectors of a leaf wanted; sample vectors of a leaf at least; vectors of a block that queries meet at once.
LEAF_ROWS, LEAF_SAMPLE, BLOCK_ROWS = 64, 16, 16384


@dataclass
class Forest:
    """``directions[t]``: depth x (dimension + 1); ``cuts[t][level]``: a threshold for each node of the level."""

    directions: list[np.ndarray]
    cuts: list[list[np.ndarray]]
    norm: float

    @property
    def depth(self) -> int:
        return len(self.cuts[0])

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0.0))
        return np.column_stack([x, rest])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree: rows x trees."""
        lifted, out = self.lifted(x), np.zeros((len(x), len(self.cuts)), np.int32)
        for t, levels in enumerate(self.cuts):
            along = lifted @ self.directions[t].T
            for level, cut in enumerate(levels):
                out[:, t] = 2 * out[:, t] + (along[:, level] > cut[out[:, t]])
        return out

    def along(self, q: np.ndarray) -> list[np.ndarray]:
        return [d[:, :-1] @ q for d in self.directions]

    def visit(self, q: np.ndarray, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue until ``enough`` vectors are reached."""
        along, depth, reached, out = self.along(q), self.depth, 0, []
        queue = [(0.0, t, 0, 0) for t in range(len(self.cuts))]
        while queue and reached < enough:
            cost, t, level, node = heapq.heappop(queue)
            if level == depth:
                out.append((t, node))
                reached += counts[t, node]
                continue
            beyond = along[t][level] - self.cuts[t][level][node]
            far = cost + beyond * beyond
            near_right = beyond > 0
            heapq.heappush(queue, (far if near_right else cost, t, level + 1, 2 * node))
            heapq.heappush(queue, (cost if near_right else far, t, level + 1, 2 * node + 1))
        return out

    def reach(self, q: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For every (tree, leaf): how many vectors the queue has reached once it has taken that leaf."""
        costs = []
        for t, along in enumerate(self.along(q)):
            cost = np.zeros(1)
            for level, cut in enumerate(self.cuts[t]):
                beyond = along[level] - cut
                cost = np.column_stack([cost + np.maximum(beyond, 0) ** 2, cost + np.maximum(-beyond, 0) ** 2]).ravel()
            costs.append(cost)
        flat = np.concatenate(costs)
        order = np.argsort(flat, kind="stable")
        out = np.empty(len(flat), np.int64)
        out[order] = np.cumsum(counts.ravel()[order])
        return out.reshape(counts.shape)


def fit_forest(sample: np.ndarray, rows: int, norm: float, trees: int, seed: int = 7) -> Forest:
    """Random directions, and the sample's medians as thresholds. The depth follows the number of rows."""
    wide = sample.shape[1] + 1
    by_rows, by_sample = rows / LEAF_ROWS, max(1, len(sample)) / LEAF_SAMPLE
    depth = max(0, int(np.ceil(np.log2(max(1.0, min(by_rows, by_sample))))))
    random, forest = np.random.default_rng(seed), Forest([], [], norm)
    for _ in range(trees):
        drawn = [np.linalg.qr(random.standard_normal((wide, wide)))[0].T for _ in range(-(-depth // wide) or 1)]
        directions = np.concatenate(drawn)[:depth]
        along = forest.lifted(sample) @ directions.T
        node, levels = np.zeros(len(sample), np.int64), []
        for level in range(depth):
            cut = np.zeros(1 << level)
            order = np.argsort(node, kind="stable")
            for rows_of in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                if len(rows_of):
                    cut[node[rows_of[0]]] = np.median(along[rows_of, level])
            node = 2 * node + (along[:, level] > cut[node])
            levels.append(cut)
        forest.directions.append(directions)
        forest.cuts.append(levels)
    return forest


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, queries x vectors, summed component by component: equal vectors score equal bits."""
    total = np.zeros((len(q), len(x)))
    for k in range(x.shape[1]):
        total += q[:, k, None] * x[None, :, k]
    return total


def best(score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``most`` largest of every row; ties to the smaller id. ``ids`` ascend."""
    order = np.argsort(-score, axis=1, kind="stable")[:, :most]
    return np.repeat(np.arange(len(score)), order.shape[1]), order.ravel()


def usable(vectors: DataFrame) -> DataFrame:
    """One row for each vec_id that has a finite, non-zero vector of the usual dimension.

    An id that occurs more than once counts with the vector of the smallest hash.
    """
    good = vectors.select("vec_id", "embedding").where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 "
        "AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(embedding, x -> x <> 0)"
    )
    one = good.groupBy("vec_id").agg(F.min_by("embedding", F.struct(F.xxhash64("embedding"), "embedding")).alias("embedding"))
    one = stage(one, "vectors")
    usual = one.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return one.where(F.size("embedding") == usual["dim"]) if usual else one.where("false")


def search(vectors: DataFrame, is_query, nearest: int = 20, trees: int = 4, recall: float = 0.96) -> DataFrame:
    """The ``nearest`` vectors found for each query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``is_query``: condition on ``vec_id``. Candidates are all usable vectors but the query's own; score is the
    inner product in double precision; ties go to the smaller vec_id. Vectors that are NULL, zero, of an
    unusual length or hold NULL or non-finite components take no part. Equal vectors are one entry of the
    index with their ``nearest`` + 1 smallest ids, which loses none that a query could rank. An empty table,
    or one without usable queries, gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    keyed = rows.select("vec_id", "embedding", F.xxhash64("embedding").alias("qa"), F.xxhash64(F.lit(11), "embedding").alias("qb"))
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    entries = stage(
        rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= nearest + 1)
        .groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("entry"), "ids", "embedding"),
        "entries",
    )
    queries = stage(keyed.where(is_query), "queries")
    distinct = stage(queries.groupBy("qa", "qb").agg(F.min("vec_id").alias("first"), F.min_by("embedding", "vec_id").alias("embedding")), "query-vectors")

    count, square, dim = entries.agg(
        F.count("*"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), F.max(F.size("embedding"))
    ).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    by_hash = [F.xxhash64("entry"), F.col("entry")]
    sample = matrix(entries.orderBy(*by_hash).limit(max(1, FIT_COMPONENTS // dim)).select("embedding").toArrow()["embedding"])
    forest = fit_forest(sample, count, float(np.sqrt(square)), trees)
    leaves_of = 1 << forest.depth

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.leaves(matrix(batch.column("embedding")))
            for t in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), t, np.int32)), pa.array(found[:, t]), batch.column("entry")], names=["tree", "leaf", "entry"]
                )

    routed = entries.select("entry", "embedding").mapInArrow(route, "tree int, leaf int, entry long")
    counts = np.zeros((trees, leaves_of), np.int64)
    for r in routed.groupBy("tree", "leaf").count().collect():  # trees x leaves, bounded by the fitting sample
        counts[r["tree"], r["leaf"]] = r["count"]
    enough = max(trees * (nearest + 1), effort(entries, distinct, forest, counts, nearest, recall))

    # Consecutive leaves make a block; a leaf above a block's size is dealt over several.
    first_block, parts, block, filled = np.zeros((trees, leaves_of), np.int32), np.ones((trees, leaves_of), np.int32), 0, 0
    for t in range(trees):
        for leaf in range(leaves_of):
            n = int(counts[t, leaf])
            if filled and filled + n > BLOCK_ROWS:
                block, filled = block + 1, 0
            first_block[t, leaf], parts[t, leaf] = block, max(1, -(-n // BLOCK_ROWS))
            block, filled = block + parts[t, leaf] - 1, filled + n
            if parts[t, leaf] > 1:
                block, filled = block + 1, 0
        block, filled = block + 1, 0
    kind = entries.schema["embedding"].dataType.simpleString()
    meeting = f"block int, kind int, leaf int, entry long, other long, leaves array<int>, embedding {kind}"
    list_type = pa.list_(pa.int32())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            found, ids = forest.leaves(matrix(column)), batch.column("entry").to_numpy()
            for t in range(trees):
                at = first_block[t, found[:, t]] + (ids % parts[t, found[:, t]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(np.zeros(len(ids), np.int32)), pa.array(found[:, t]), pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), list_type), column],
                    names=["block", "kind", "leaf", "entry", "other", "leaves", "embedding"],
                )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 64):
                batch = whole.slice(begin, 64)
                at, row, lists = [], [], []
                for i, q in enumerate(matrix(batch.column("embedding"))):
                    blocks: dict[int, list[int]] = {}
                    for t, leaf in forest.visit(q, counts, enough):
                        for part in range(parts[t, leaf]):
                            blocks.setdefault(int(first_block[t, leaf]) + part, []).append(leaf)
                    for b in sorted(blocks):
                        at.append(b)
                        row.append(i)
                        lists.append(blocks[b])
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array([1] * len(at), pa.int32()), pa.nulls(len(at), pa.int32()), batch.column("qa").take(take), batch.column("qb").take(take), pa.array(lists, list_type), batch.column("embedding").take(take)],
                    names=["block", "kind", "leaf", "entry", "other", "leaves", "embedding"],
                )

    met = (
        entries.select("entry", "embedding").mapInArrow(deal, meeting)
        .unionByName(distinct.select("qa", "qb", "embedding").mapInArrow(walk, meeting))
    )
    found = met.repartition("block").sortWithinPartitions("block", "kind", "leaf", "entry").mapInArrow(
        lambda batches: meet(batches, nearest + 1), "qa long, qb long, entries array<long>, scores array<double>"
    )
    top = found.repartition("qa", "qb").sortWithinPartitions("qa", "qb").mapInArrow(
        lambda batches: merge(batches, nearest + 1), "qa long, qb long, entry long, score double"
    )
    spread = top.join(entries.select("entry", "ids"), "entry").select("qa", "qb", "score", F.explode("ids").alias("vec_id"))
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        spread.join(queries.select("qa", "qb", F.col("vec_id").alias("query_id")), ["qa", "qb"])
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def meet(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Exact scores, leaf by leaf, of rows sorted by block, vectors before queries. Holds one block's vectors."""
    block, held, index = None, [], None
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        kinds = batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
        for begin, end in zip([0, *edges], [*edges, len(numbers)], strict=True):
            if begin == end:
                continue
            part = batch.slice(int(begin), int(end - begin))
            if numbers[begin] != block:
                block, held, index = numbers[begin], [], None
            if kinds[begin] == 0:
                held.append((part.column("leaf").to_numpy(), part.column("entry").to_numpy(), matrix(part.column("embedding"))))
                continue
            if not held:
                continue
            if index is None:
                leaf, ids, x = (np.concatenate(c) for c in zip(*held, strict=True))
                starts = np.concatenate([[0], np.flatnonzero(np.diff(leaf)) + 1, [len(leaf)]])
                index = {int(leaf[a]): (ids[a:b], x[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)}
            for cut in range(0, len(part), 512):
                yield from meet_queries(part.slice(cut, 512), index, most)


def meet_queries(part: pa.RecordBatch, index: dict, most: int) -> Iterator[pa.RecordBatch]:
    q = matrix(part.column("embedding"))
    lists = part.column("leaves")
    owner = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
    leaf = lists.flatten().to_numpy()
    order = np.argsort(leaf, kind="stable")
    who, ids, scores = [], [], []
    for rows in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
        entry = index.get(int(leaf[rows[0]])) if len(rows) else None
        if entry is None:
            continue
        score = products(q[owner[rows]], entry[1])
        r, c = best(score, entry[0], most)
        who.append(owner[rows][r])
        ids.append(entry[0][c])
        scores.append(score[r, c])
    if who:
        who, ids, scores = leading(np.concatenate(who), np.concatenate(ids), np.concatenate(scores), most)
        rows, begins = np.unique(who, return_index=True)
        take, offsets = pa.array(rows), pa.array(np.append(begins, len(who)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("entry").take(take),
                part.column("other").take(take),
                pa.ListArray.from_arrays(offsets, pa.array(ids)),
                pa.ListArray.from_arrays(offsets, pa.array(scores)),
            ],
            names=["qa", "qb", "entries", "scores"],
        )


def leading(who: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` best entries of each query, best first; an entry found in several trees counts once."""
    order = np.lexsort((ids, -scores, who))
    who, ids, scores = who[order], ids[order], scores[order]
    again = np.zeros(len(who), bool)
    again[1:] = (who[1:] == who[:-1]) & (ids[1:] == ids[:-1])  # equal entries have equal scores, so they are neighbours
    who, ids, scores = who[~again], ids[~again], scores[~again]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < most
    return who[keep], ids[keep], scores[keep]


def merge(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The best entries of each query over all blocks, from rows sorted by query. Holds the last query's rows."""

    def merged(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        qa, qb = rows.column("qa").to_numpy(), rows.column("qb").to_numpy()
        query = np.concatenate([[0], np.cumsum((np.diff(qa) != 0) | (np.diff(qb) != 0))])
        lists = rows.column("entries").combine_chunks()
        who = np.repeat(query, np.diff(lists.offsets.to_numpy()))
        who, ids, scores = leading(who, lists.flatten().to_numpy(), rows.column("scores").combine_chunks().flatten().to_numpy(), most)
        first = np.searchsorted(query, who)
        return pa.RecordBatch.from_arrays([pa.array(qa[first]), pa.array(qb[first]), pa.array(ids), pa.array(scores)], names=["qa", "qb", "entry", "score"])

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        qa, qb = held.column("qa").to_numpy(), held.column("qb").to_numpy()
        ends = np.flatnonzero((np.diff(qa) != 0) | (np.diff(qb) != 0))
        if len(ends):
            cut = int(ends[-1]) + 1
            yield merged(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield merged(held)


def effort(entries: DataFrame, distinct: DataFrame, forest: Forest, counts: np.ndarray, nearest: int, recall: float) -> int:
    """How many vectors a query must reach so that a share ``recall`` of true neighbours is found.

    Measured on at most ``MEASURED_QUERIES`` queries, those with the smallest hashes, against all vectors.
    """
    few = distinct.orderBy("qa", "qb").limit(MEASURED_QUERIES).select("first", "embedding").toArrow()
    if not len(few):
        return 0
    q, own, trees = matrix(few["embedding"]), few["first"].to_numpy(), len(forest.cuts)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for cut in range(0, len(whole), 2048):
                batch = whole.slice(cut, 2048)
                x, ids = matrix(batch.column("embedding")), batch.column("entry").to_numpy()
                score = q @ x.T
                score[own[:, None] == ids[None, :]] = -np.inf
                r, c = best(score, ids, nearest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r), pa.array(score[r, c]), pa.array(list(forest.leaves(x)[c]), pa.list_(pa.int32()))], names=["q", "score", "leaves"]
                )

    by_score = Window.partitionBy("q").orderBy(F.desc("score"))
    true = (
        entries.select("entry", "embedding").mapInArrow(brute, "q long, score double, leaves array<int>")
        .withColumn("n", F.row_number().over(by_score)).where((F.col("n") <= nearest) & (F.col("score") > float("-inf")))
        .select("q", "leaves").collect()
    )
    reach: dict[int, np.ndarray] = {}
    needed = []
    for r in true:  # at most MEASURED_QUERIES x nearest rows
        if r["q"] not in reach:
            reach[r["q"]] = forest.reach(q[r["q"]], counts)
        needed.append(min(reach[r["q"]][t, r["leaves"][t]] for t in range(trees)))
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if needed else 0
