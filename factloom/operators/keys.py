"""Finding the keys a change reaches, directly or through other tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import literal
from factloom.sources.workspace import stage
from factloom.spec import quoted, renamed

# Bits of a sieve for each key, and at most (32 MB of bits); up to so many keys Spark broadcasts the keys themselves.
SIEVE_BITS_PER_KEY, SIEVE_BITS_MOST, SIEVE_KEYS_LEAST = 16, 1 << 28, 20_000

def distinct_keys(df: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Distinct key tuples; a mapping renames them. Reduced map-side before the shuffle."""
    mapping = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    return df.selectExpr(*renamed(mapping)).distinct()


def join_keys(df: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Distinct key tuples as the right side of a semi, anti or marking join.

    ``keys`` are columns, or a mapping from the name in the result to the column.
    Plain distinct keys arrive partitioned by the key, so a join would use them as they
    are, and adaptive execution then cannot split a hot key on the other side: it only
    divides joins whose two inputs were shuffled for that join. Reducing the tuples as
    one struct leaves the (small) shuffle to the join.
    """
    sources = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    fields = ", ".join(f"{literal(name)}, {quoted(source)}" for name, source in sources.items())
    return df.selectExpr(f"named_struct({fields}) AS _key").distinct().select("_key.*")


def may_hit(rows: DataFrame, keys: DataFrame, on: Mapping[str, str], flag: str) -> DataFrame | None:
    """The rows with a column ``flag``: true wherever the key occurs among ``keys`` (row column -> key column), and seldom else.

    The hashes of the keys mark bits (a Bloom filter), which are broadcast in pages of 512: at most ``SIEVE_BITS_MOST`` of them, so
    that their size is bounded; with more keys than they are made for, more rows pass. An exact join must follow,
    but it has only the rows that pass to shuffle. ``keys`` are counted and read once more, so they should be staged. None means
    that nothing is gained (few keys, which Spark broadcasts itself) or that hashes of equal keys may differ (their types).
    """
    row_types, key_types = dict(rows.dtypes), dict(keys.dtypes)
    hashed = ("string", "tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "timestamp_ntz")
    if any(row_types[r] != key_types[k] or row_types[r] not in hashed for r, k in on.items()):
        return None
    keyed = keys.dropna(subset=list(on.values()))
    count = keyed.count()
    if count < SIEVE_KEYS_LEAST:
        return None
    pages = min(SIEVE_BITS_MOST, 1 << (count * SIEVE_BITS_PER_KEY - 1).bit_length()) // 512
    # A key's hash chooses a page by its low bits and three of the page's 512 bits by others.
    places = [f"CAST(shiftrightunsigned(_hash, {shift}) & 511 AS int)" for shift in (32, 41, 50)]
    marks = keyed.selectExpr(f"xxhash64({', '.join(quoted(c) for c in on.values())}) AS _hash")
    marks = marks.selectExpr(f"_hash & {pages - 1}L AS _page", *[f"{p} AS _p{i}" for i, p in enumerate(places)])
    bit = "CASE WHEN _p{0} DIV 64 = {1} THEN shiftleft(1L, _p{0} % 64) ELSE 0L END"
    words = [f"bit_or({' | '.join(bit.format(i, w) for i in range(len(places)))})" for w in range(8)]
    sieve = marks.groupBy("_page").agg(F.expr(f"array({', '.join(words)})").alias("_words"))
    missing = " OR ".join(f"{quoted(r)} IS NULL" for r in on)
    held = rows.selectExpr("*", f"CASE WHEN {missing} THEN NULL ELSE xxhash64({', '.join(quoted(c) for c in on)}) END AS _hash")
    found = held.join(F.broadcast(sieve), F.expr(f"_hash & {pages - 1}L = _page"), "left")
    test = " AND ".join(f"getbit(_words[{p} DIV 64], {p} % 64) = 1" for p in places)
    return found.selectExpr(*[quoted(c) for c in rows.columns], f"coalesce({test}, false) AS {quoted(flag)}")


def sieved(rows: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """The rows without most of those whose key does not occur among the staged ``keys``; see :func:`may_hit`."""
    marked = may_hit(rows, keys, on, "_may")
    return rows if marked is None else marked.filter("_may").drop("_may")


def rows_hit(rows: DataFrame, changed: DataFrame, on: Mapping[str, str], staged: bool = False) -> DataFrame:
    """Rows whose key occurs among the changed rows (``on``: row column -> changed column).

    The changed side is cut to its distinct keys, so a key that changed a million
    times is one row in the semi join. Where it is ``staged``, a sieve of its keys goes first.
    """
    if staged:
        rows = sieved(rows, changed, on)
    keys = join_keys(changed, {f"_c_{r}": c for r, c in on.items()})
    same = " AND ".join(f"{quoted(r)} = {quoted('_c_' + r)}" for r in on)
    return rows.join(keys, F.expr(same), "left_semi")


def keys_through(
    changed: DataFrame, hops: Sequence[tuple[DataFrame, Mapping[str, str]]], key: Sequence[str], staged: bool = False
) -> DataFrame:
    """Follow a change through a chain of tables to the keys of the last one.

    Each hop is ``(table, {table column: column of the previous step})``; the previous
    step is the changed rows, then the rows hit so far. One hop answers "which rows
    reference a changed row", more hops follow references of references. ``staged`` says
    that the changed rows are.
    """
    hit = changed
    for number, (table, on) in enumerate(hops):
        hit = rows_hit(table, hit, on, staged and number == 0)
    return distinct_keys(hit, key)


def keys_hit_on_any_path(
    rows: DataFrame, paths: Sequence[tuple[DataFrame, Mapping[str, str]]], key: Sequence[str]
) -> DataFrame:
    """Distinct ``key`` tuples of the rows that a change reaches on at least one path. The rows are read once.

    A path is (changed rows, ``{row column: changed column}``). Every row offers one tagged key for each path; the
    changed keys of all paths are one tagged set, written once, so that Spark knows its size. One semi join decides
    for all paths; a NULL matches nothing. Keys meet as text, so both sides of a pair must have the same type.
    """
    width = max(len(on) for _, on in paths)
    parts = [f"_k{i}" for i in range(width)]

    def tagged(number: int, columns: Sequence[str]) -> str:
        values = [f"CAST({quoted(c)} AS string)" for c in columns] + ["''"] * (width - len(columns))
        return f"named_struct('_path', {number}, {', '.join(f'{literal(p)}, {v}' for p, v in zip(parts, values, strict=True))})"

    changed_keys = []
    for number, (changed, on) in enumerate(paths):
        row_types, changed_types = dict(rows.dtypes), dict(changed.dtypes)
        unlike = [(r, c) for r, c in on.items() if row_types[r] != changed_types[c] or row_types[r] in ("float", "double")]
        if unlike:
            raise ValueError(f"columns that cannot meet as text: {unlike}")
        changed_keys.append(changed.selectExpr(f"{tagged(number, list(on.values()))} AS _key"))
    wanted = stage(reduce(DataFrame.unionByName, changed_keys).distinct().select("_key.*"), "changed-keys")
    offers = [tagged(n, list(on)) for n, (_, on) in enumerate(paths)]
    offered = rows.selectExpr(*[quoted(k) for k in key], f"explode(array({', '.join(offers)})) AS _offer")
    offered = sieved(offered.select(*[quoted(k) for k in key], "_offer.*"), wanted, {c: c for c in ("_path", *parts)})
    return offered.join(wanted, ["_path", *parts], "left_semi").select(*[quoted(k) for k in key]).distinct()


def union_distinct(*key_sets: DataFrame) -> DataFrame:
    """Union of key sets without repeats."""
    return reduce(DataFrame.unionByName, key_sets).distinct()


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    """Concatenate frames whose columns agree by name, in whatever order."""
    return reduce(DataFrame.unionByName, frames)


def changed_key_semi_join(rows: DataFrame, keys: DataFrame, on: Sequence[str], staged: bool = False) -> DataFrame:
    """Rows whose key is in a key set; row multiplicity is unchanged. A sieve of ``staged`` keys goes first."""
    if staged:
        rows = sieved(rows, keys, {c: c for c in on})
    return rows.join(join_keys(keys, on), list(on), "left_semi")
