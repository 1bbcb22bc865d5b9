"""Spelling variants: words one edit apart, found by a bit-sliced position index.

For every (place, letter) the index holds a bitset over the words that have this letter at this place. A word
is looked up in all of a bitset's words at once, letter by letter, by three recurrences: the words that agree so
far (no error), those that agree but for one replaced letter, and those that agree but for one letter more, which
are followed in the places shifted by one.

Words meet only where they can be near. Of two words one edit apart, the shorter with m letters, either the first
m // 2 letters agree or all after them do; so the vocabulary is dealt into blocks by m and one of these halves, and
only the other half is looked up. A block is cut into lanes of 64 words, one machine word for each bitset; a block
beyond ``tile_words`` is dealt over several tasks, each with a part of its index and a part of its queries. No pair
is found in two blocks, and none is lost.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.workspace import stage

#: Letters of words: A-Z and a-z count as one, U+00C0 to U+00FF as they are. All have one byte in Latin-1.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Latin-1 text to lower-case letters and spaces. What Latin-1 lacks is written as "?", hence a space.
TO_WORDS = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 0xC0 else 32 for b in range(256))
#: Letters as numbers; one number more stands for "past the end" and is in no bitset.
END = len(LETTERS)
NUMBER = np.full(256, END, np.int64)
NUMBER[LETTERS] = np.arange(END)
#: Words that a task counts before it sends them on.
COUNTED = 400_000
#: Rows of whole blocks looked up together, cells of their bitsets, and pairs of a query and a lane at once.
ROWS, CELLS, ITEMS = 200_000, 1 << 22, 1 << 18
ONE = np.uint64(1)


def lower_runs(text: str | None) -> list[bytes]:
    """The letter runs of a text in Latin-1, A-Z in lower case; none for None."""
    return text.encode("latin-1", "replace").translate(TO_WORDS).split() if text else []


def dropped(run: bytes, row: bytes, every: int) -> bytes:
    """The run, without one of its letters if its keyed checksum is a multiple of ``every``."""
    check = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(row + b":"))
    at = check % len(run)
    return run[:at] + run[at + 1 :] if check % every == 0 else run


def count_words(docs: DataFrame, shortest: int = 7, fewest: int = 2, drop_every: int | None = None) -> DataFrame:
    """``word`` and its number ``n`` of occurrences in ``text``, of at least ``shortest`` letters and ``fewest`` occurrences.

    With ``drop_every``, a run loses a letter where the checksum of ``doc_id:run`` is a multiple of it, before its
    length counts; a NULL id is empty text there. NULL and empty texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def sent() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            made = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for row, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found = lower_runs(text.as_py())
                if drop_every is None:
                    counts.update(w for w in found if len(w) >= shortest)
                else:
                    key = b"" if row.as_py() is None else str(row.as_py()).encode()
                    for w, n in Counter(w for w in found if len(w) >= shortest).items():
                        made = dropped(w, key, drop_every)
                        if len(made) >= shortest:
                            counts[made] += n
                if len(counts) >= COUNTED:
                    yield sent()
        if counts:
            yield sent()

    return (
        docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)
    )


def in_blocks(words: DataFrame, tile_words: int) -> DataFrame:
    """A row for each word and tile of each of its blocks; ``open`` is the half that may differ."""
    halves = words.selectExpr("word", "n", "explode(filter(array(length(word), length(word) - 1), m -> m > 0)) AS m")
    rows = halves.selectExpr(
        "word", "n",
        """explode(array(
          struct('p' || m || ':' || left(word, m div 2) AS block, substring(word, m div 2 + 1) AS open, m - m div 2 AS short, false AS tail),
          struct('s' || m || ':' || right(word, m - m div 2) AS block, left(word, length(word) - m + m div 2) AS open, m div 2 AS short, true AS tail)
        )) AS half""",
    ).select("word", "n", "half.*")
    sizes = rows.groupBy("block").agg(F.count("*").alias("size"))
    large = stage(sizes.where(F.col("size") > tile_words).selectExpr("block", f"ceil(size / {tile_words}) AS parts"), "blocks")
    # Words are distinct, so a hash deals a block evenly; every part of the index meets every part of the queries.
    dealt = rows.join(large, "block", "left").selectExpr(
        "*", "coalesce(parts, 1) AS of", "pmod(xxhash64(word), coalesce(parts, 1)) AS part"
    )
    return dealt.selectExpr(
        "block", "word", "n", "open", "short", "tail",
        """explode(concat(
          transform(sequence(0, of - 1), q -> struct(part * of + q AS tile, true AS indexed, q = part AS asks)),
          transform(filter(sequence(0, of - 1), i -> i <> part AND length(open) = short), i -> struct(i * of + part AS tile, false AS indexed, true AS asks))
        )) AS role""",
    ).select("block", "word", "n", "open", "short", "tail", "role.*")


class Bitsets:
    """Bitsets of 64 words, for each lane, place and letter; a table of all cells, or of those in use if that is too large."""

    def __init__(self, lane: np.ndarray, bit: np.ndarray, letters: np.ndarray, lanes: int) -> None:
        self.width = letters.shape[1]
        cell = self.cell(lane[:, None], np.arange(self.width), letters)
        there = letters != END
        cell, value = cell[there], np.broadcast_to((ONE << bit)[:, None], letters.shape)[there]
        count = lanes * self.width * (END + 1)
        self.used = None
        if count > 4 * CELLS:
            self.used, cell = np.unique(cell, return_inverse=True)
            count = len(self.used)
        self.sets = np.zeros(count, np.uint64)
        np.bitwise_or.at(self.sets, cell, value)

    def cell(self, lane, place, letter):
        return (lane * self.width + place) * (END + 1) + letter

    def get(self, lane: np.ndarray, place: int, letter: np.ndarray) -> np.ndarray:
        cell = self.cell(lane, place, letter)
        if self.used is None:
            return self.sets[cell]
        at = np.minimum(np.searchsorted(self.used, cell), len(self.used) - 1)
        return np.where(self.used[at] == cell, self.sets[at], np.uint64(0))


def one_error(sets: Bitsets, lane: np.ndarray, queries: np.ndarray, short: int, full: np.ndarray) -> tuple[np.ndarray, ...]:
    """For pairs of a lane and a query of ``short`` letters: words that agree, that differ in one letter, that have one more."""
    same, replaced, longer = full[lane], np.zeros(len(lane), np.uint64), full[lane]
    for i in range(short):
        letter = queries[:, i]
        here = sets.get(lane, i, letter)
        replaced = (replaced & here) | (same & ~here)
        same = same & here
        longer = (longer & sets.get(lane, i + 1, letter)) | same
    return same, replaced, longer


def members(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the bits that are set."""
    row = np.flatnonzero(bits)
    each = np.unpackbits(bits[row].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, place = np.nonzero(each)
    return row[at], place


def near_in_blocks(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers whose words are one edit apart; ``rows`` holds whole tiles, each in one stretch."""
    keys = [rows.column(c).combine_chunks() for c in ("block", "tile")]
    new = np.zeros(len(rows), bool)
    for key in keys:
        new[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    group = np.cumsum(new)
    opened = rows.column("open").combine_chunks()
    sizes = pc.utf8_length(opened).to_numpy().astype(np.int64)
    text = np.frombuffer("".join(opened.to_pylist()).encode("latin-1"), np.uint8)
    begins = np.cumsum(sizes) - sizes
    short, tail, indexed, asks = (rows.column(c).to_numpy() for c in ("short", "tail", "indexed", "asks"))
    asks = asks & (sizes == short)
    # Tiles that hold a single word, or no query, have no pairs.
    useful = (np.bincount(group, indexed) > 0) & (np.bincount(group, asks) > 0) & (np.bincount(group) > 1)
    for a in np.unique(short):
        some = np.flatnonzero((short == a) & useful[group])
        if not len(some):
            continue
        _, groups = np.unique(group[some], return_inverse=True)
        words_in = np.bincount(groups, indexed[some]).astype(np.int64)
        lanes_in = -(-words_in // 64)
        per_cut = max(CELLS // ((a + 1) * (END + 1)), 1)
        cut = (np.cumsum(lanes_in) - lanes_in) // per_cut
        for c in np.unique(cut):
            at = some[cut[groups] == c]
            yield from _near_in_cut(at, group[at], int(a), sizes[at], begins[at], text, indexed[at], asks[at], tail[at])


def _near_in_cut(at, group, short, sizes, begins, text, indexed, asks, tail) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    _, group = np.unique(group, return_inverse=True)
    place = np.arange(short + 1)
    spot = np.minimum(begins[:, None] + place, max(len(text) - 1, 0))
    letters = np.where(place < sizes[:, None], NUMBER[text[spot]] if len(text) else END, END)
    own = np.flatnonzero(indexed)
    words_in = np.bincount(group[own], minlength=group[-1] + 1)
    nth = np.arange(len(own)) - (np.cumsum(words_in) - words_in)[group[own]]
    lanes_in = -(-words_in // 64)
    first_lane = np.cumsum(lanes_in) - lanes_in
    lane, bit = first_lane[group[own]] + nth // 64, (nth % 64).astype(np.uint64)
    lanes = int(lanes_in.sum())
    sets = Bitsets(lane, bit, letters[own], lanes)
    full, long_ = np.zeros(lanes, np.uint64), np.zeros(lanes, np.uint64)
    np.bitwise_or.at(full, lane, ONE << bit)
    is_long = sizes[own] > short
    np.bitwise_or.at(long_, lane[is_long], ONE << bit[is_long])
    row_of = np.full(lanes * 64, -1, np.int64)
    row_of[lane * 64 + bit.astype(np.int64)] = at[own]
    asking = np.flatnonzero(asks)
    todo = np.cumsum(lanes_in[group[asking]])
    for c in np.unique(todo // ITEMS) if len(todo) else ():
        some = asking[todo // ITEMS == c]
        times = lanes_in[group[some]]
        query = np.repeat(some, times)
        ends = np.cumsum(times)
        of_item = np.arange(len(query)) - np.repeat(ends - times, times) + np.repeat(first_lane[group[some]], times)
        same, replaced, longer = one_error(sets, of_item, letters[query], short, full)
        # Where the first halves agree, the block of that half has the pair.
        longer = longer & long_[of_item] & ~np.where(tail[query], same, np.uint64(0))
        for found, both in ((replaced & ~long_[of_item], False), (longer, True)):
            item, b = members(found)
            left, right = at[query[item]], row_of[of_item[item] * 64 + b]
            yield left, right
            if both:
                yield right, left


def near_words(words: DataFrame, tile_words: int = 16_384) -> DataFrame:
    """Rows (``word``, ``near``, ``near_n``) for every ordered pair of words one inserted, deleted or replaced letter apart.

    ``words`` has distinct, non-empty words of :data:`LETTERS` with a number ``n``. No pair comes twice.
    """
    tiles = in_blocks(words, tile_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            names, counts = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
            for left, right in near_in_blocks(rows):
                for cut in range(0, len(left), 100_000):
                    a, b = (pa.array(x[cut : cut + 100_000]) for x in (left, right))
                    yield pa.RecordBatch.from_arrays([names.take(a), names.take(b), counts.take(b)], names=["word", "near", "near_n"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < ROWS:
                continue
            rows = pa.Table.from_batches(held)
            # The last tile may go on in the next batch.
            last = [pc.equal(rows.column(c), rows.column(c)[-1]) for c in ("block", "tile")]
            others = size - pc.sum(pc.and_(*last)).as_py()
            if others:
                yield from found(rows.slice(0, others))
                held = rows.slice(others).to_batches()
                size -= others
        if size:
            yield from found(pa.Table.from_batches(held))

    dealt = tiles.repartition("block", "tile").sortWithinPartitions("block", "tile")
    return dealt.mapInArrow(run, "word string, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(``word``, ``root``) where following ``form`` ends. Every pass doubles the steps taken.

    Links lead to words that occur at least ten times as often, so there are fewer than twenty in a row, and no circles.
    """
    reached = stage(links.selectExpr("word", "form AS root", "true AS open"), "roots")
    while not reached.where("open").isEmpty():
        # Many words lead to the same form; the words looked up there are distinct, so the left side can be split.
        onward = reached.selectExpr("word AS root", "root AS next", "open AS next_open")
        reached = stage(
            reached.join(onward, "root", "left").selectExpr(
                "word", "coalesce(next, root) AS root", "next IS NOT NULL AND next_open AS open"
            ),
            "roots",
        )
    return reached.select("word", "root")


def group_variants(words: DataFrame, times: int = 10, tile_words: int = 16_384) -> DataFrame:
    """Words with their near words counted and the form that they are a variant of.

    ``words`` has distinct words with a number ``n``, as :func:`count_words` gives them. A word's form is its most
    frequent near word (ties: the first in code-point order) if that occurs at least ``times`` (at least 2) as often.
    Columns: word, n, ``n_near``, ``form``, ``form_n`` (NULL without a form) and ``root``, the last of the forms (the
    word itself without one). No words, no rows.
    """
    if times < 2:
        raise ValueError("times must be at least 2, or forms could lead round in circles")
    words = stage(words.select("word", "n"), "words")
    # Strings are ordered by UTF-8 bytes, which is the order of code points.
    best = near_words(words, tile_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    formed = f"-best.less >= {times} * n"
    known = words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near",
        f"CASE WHEN {formed} THEN best.near END AS form", f"CASE WHEN {formed} THEN -best.less END AS form_n",
    )
    known = stage(known, "forms")
    ends = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
