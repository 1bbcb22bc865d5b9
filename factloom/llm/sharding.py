"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups sorted by size enter the bin with the tightest remaining capacity that still holds them. The
remaining capacities are kept in a balanced tree. Best fit looks at sizes only, and the tightest bin stays the
tightest until it holds no more groups of a size; so the groups of one size are placed in runs, and what a
task packs is a row for each distinct size. Sizes that differ add up: n of them need n * (n + 1) / 2 bytes.
Every group then finds its bin by its rank among the groups of its size.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import running_total
from factloom.sources.workspace import stage

#: Ranks within a size that meet the runs of that size under one key.
RANKS_A_KEY = 256


class CapacityTree:
    """A treap of (remaining capacity, bin): insert, and take out the least entry at or above a size."""

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        mixed = (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xC2B2AE3D27D4EB4F) & (2**64 - 1)
        return (mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9 & (2**64 - 1)

    def _split(self, node, key):
        """Entries below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high

    def insert(self, remaining: int, number: int) -> None:
        key = (remaining, number)
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self._priority(key), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest entry that holds ``size``; ties go to the lower bin."""
        node, found = self.root, None
        while node is not None:
            if node[0][0] >= size:
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found is not None:
            low, rest = self._split(self.root, found)
            _, high = self._split(rest, (found[0], found[1] + 1))
            self.root = self._merge(low, high)
        return found


def best_fit_runs(sizes: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """Places (size, number of groups) rows, which must come in descending order: runs of (size, first, end, bin).

    A run holds the groups of a size from number ``first`` up to ``end``. Bins are numbered as they are opened;
    a group above the capacity gets a bin alone.
    """
    tree, runs, opened = CapacityTree(), [], 0
    for size, count in sizes:
        first = 0
        while first < count:
            found = tree.take(size)
            if found is None:
                found, opened = (max(capacity, size), opened), opened + 1
            end = min(count, first + found[0] // size) if size else count
            runs.append((size, first, end, found[1]))
            if left := found[0] - (end - first) * size:
                tree.insert(left, found[1])
            first = end
    return runs


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> list[int]:
    """The bin of each size. Sizes must come in descending order; one above the capacity gets a bin alone."""
    counted = [(size, len(list(equal))) for size, equal in groupby(sizes)]
    return [b for _, first, end, b in best_fit_runs(counted, capacity) for _ in range(end - first)]


def bins_needed(sizes: list[tuple[int, int]], capacity: int) -> int:
    return max((b for *_, b in best_fit_runs(sizes, capacity)), default=-1) + 1


def least_capacity(sizes: list[tuple[int, int]], bins: int) -> int:
    """About the least capacity with which best fit decreasing needs no more than ``bins`` bins (bisection)."""
    low = max(-(-sum(size * n for size, n in sizes) // bins), max((size for size, _ in sizes), default=1), 1)
    if bins_needed(sizes, low) <= bins:
        return low
    high = low
    while bins_needed(sizes, high) > bins:
        high += max(1, high // 64)
    while high - low > max(1, low // 20_000):
        middle = (low + high) // 2
        if bins_needed(sizes, middle) <= bins:
            high = middle
        else:
            low = middle
    return high


def pack_groups(groups: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """Bins for (``item``, ``size``) rows: ``item``, ``shard``, numbered without gaps from 0.

    Give ``shards`` for that many bins of a capacity as small as possible, or ``capacity`` for as few bins
    as possible. Sizes of rows of the same item add up; a NULL size is 0. Groups of equal size are placed in the
    order of their items. An empty table has no bins. A group above the capacity gets a bin of its own.
    """
    whole = stage(groups.groupBy("item").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("size")), "groups")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        sizes = list(zip(rows["size"].tolist(), rows["n"].tolist(), strict=True))
        return pd.DataFrame(best_fit_runs(sizes, least_capacity(sizes, shards) if shards else capacity), columns=["size", "start", "stop", "shard"])

    sizes = whole.groupBy("size").agg(F.count("*").alias("n"))
    runs = stage(sizes.groupBy(F.lit("all").alias("all")).applyInPandas(pack, "size long, start long, stop long, shard int"), "runs")
    key = "explode(sequence(start div {0}, (stop - 1) div {0})) AS key".format(RANKS_A_KEY)
    ranked = running_total(whole.withColumn("one", F.lit(1).cast("long")), ["size"], ["item"], {"rank": "one"})
    found = ranked.withColumn("key", F.expr(f"rank div {RANKS_A_KEY}")).join(runs.selectExpr("*", key), ["size", "key"])
    return found.where("rank >= start AND rank < stop").select("item", "shard")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Puts every document into one of ``shards`` shards of nearly equal bytes; equal texts stay together.

    Size is the number of UTF-8 bytes of the text plus 1. Result: ``doc_id``, ``size``, ``text_crc32``,
    ``shard``, ``slot`` (gapless from 0 within the shard, by a hash of the document). NULL text counts as
    empty (size 1, checksum 0) and is in the group of the empty text. Repeated rows get a slot each. An
    empty table gives no rows. If one group exceeds an equal share, the other shards share the rest.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("item"),
        ),
        "sized",
    )
    groups = rows.groupBy("item").agg(F.sum("size").alias("size"))
    placed = rows.join(pack_groups(groups, shards=shards), "item").select(
        "doc_id", "size", "text_crc32", "shard", F.xxhash64("doc_id", "item").alias("mixed"), F.lit(1).cast("long").alias("one")
    )
    return running_total(placed, ["shard"], ["mixed", "doc_id"], {"slot": "one"}).drop("mixed", "one")
