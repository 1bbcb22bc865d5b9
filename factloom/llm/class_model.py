"""Language-model scores by Brown class bigrams.

The probability of a word is that of its class after the class before, times that of the word in its class.
Classes come from exchange clustering over the word bigrams of the whole training corpus: a word moves to the
class in which it adds most to the bigram likelihood. Every task takes up its words one after another, each
judged by classes and class bigrams that hold all earlier moves of that task. The moves of all tasks are then
counted together; should they lower the likelihood, as tasks don't see each other's moves, only those of the
tasks that gained most stay. The moves of one task never lower it, so it grows until it gains nothing more.
The most frequent words are exchanged first, in one task, so that all tasks start from classes that mean
something; the other words join the class that their neighbours favour. Most rounds judge only the words whose
neighbours favour another class than theirs; it ends with rounds that judge every word.

Words too rare to tell their use are in classes by their ending, as unseen words are; the members share the
add-one estimate. Class transitions are smoothed with the classes' own frequencies.

Counts of all words stay distributed, and so do the neighbours of the clustered words. What travels to every
task, and what comes to the driver, is bounded by parameters: the most frequent words with their counts and
classes, and matrices of the classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import running_total
from factloom.llm.text import slices
from factloom.sources.workspace import stage

#: Words whose counts every task knows; their classes; classes by ending of words that occur less than so often.
KNOWN_WORDS, CLASSES, ENDINGS, LEAST_COUNT = 1 << 17, 64, 32, 5
#: Words that are exchanged first; files of the table of neighbours, which tasks share out.
HEADS, PARTS = 1 << 11, 64
#: Weight of the classes' own frequencies in a transition, in tokens.
SMOOTHING = 20.0
#: Words, and bigrams, that a task adds up before it sends them on; distinct bigrams that it deals to both of their words at once;
#: bigrams that are merged at once, on average.
FLUSH_WORDS, FLUSH_BIGRAMS, DEALT, MERGED = 2_000_000, 1_500_000, 300_000, 500_000


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts with A-Z lower-cased, one after another, and how many each text has; none for NULL."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    counts, words = found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), found.flatten()
    real = pc.not_equal(words, "")  # white space at the ends of a text leaves an empty word
    empty = np.flatnonzero(~real.to_numpy(zero_copy_only=False))
    counts -= np.bincount(np.searchsorted(np.cumsum(counts), empty, "right"), minlength=len(counts))
    return (words.filter(real) if len(empty) else words), counts


def ending(word: bytes) -> int:
    return (word[-1] + 7 * word[-2] if len(word) > 1 else word[-1]) % ENDINGS


def endings(words: pa.Array) -> np.ndarray:
    """:func:`ending` of each word."""
    if not len(words):
        return np.empty(0, np.int64)
    data, ends = numbers(words, np.uint8)
    last = data[ends[1:] - 1].astype(np.int64)
    return (last + np.where(np.diff(ends) > 1, 7 * data[ends[1:] - 2].astype(np.int64), 0)) % ENDINGS


def count_words(training: DataFrame) -> DataFrame:
    """(``word``, ``n``) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def flush() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held))
            return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

        for batch in slices(batches):
            held.append(tokens(batch.column("text"))[0])
            if sum(map(len, held)) > FLUSH_WORDS:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return training.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def clustered_words(counts: np.ndarray) -> int:
    """How many of these counts, in descending order, are those of clustered words."""
    return int((np.asarray(counts) >= LEAST_COUNT).sum())


@dataclass
class Vocabulary:
    """The most frequent words with their counts, most frequent first, and totals of all words."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    types: int
    documents: int
    ending_tokens: np.ndarray
    ending_types: np.ndarray

    @property
    def clustered(self) -> int:
        return clustered_words(self.counts)

    def symbols(self) -> np.ndarray:
        """What stands for the numbers of :meth:`numbering` in bigrams: clustered words by rank, the end, endings."""
        n = self.clustered
        rare = n + 1 + endings(pa.array(self.words[n:], pa.binary()))
        return np.concatenate([np.arange(n), rare, n + np.arange(1 + ENDINGS)])

    def numbering(self) -> Callable[[pa.Array], np.ndarray]:
        """Numbers words: by rank, and unseen ones after the text's end by ending."""
        words = pa.array(self.words, pa.binary()).cast(pa.string())

        def numbers_of(found: pa.Array) -> np.ndarray:
            distinct = found.dictionary_encode()
            known = pc.index_in(distinct.dictionary, value_set=words.cast(found.type))
            ids = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            unseen = np.flatnonzero(ids < 0)
            ids[unseen] = len(words) + 1 + endings(distinct.dictionary.take(pa.array(unseen)))
            return ids[distinct.indices.to_numpy(zero_copy_only=False)]

        return numbers_of


def learn_vocabulary(counts: DataFrame, documents: int) -> tuple[Vocabulary, int]:
    """The vocabulary, and the least count of its words: all words that often, at most ``KNOWN_WORDS``."""
    levels = counts.groupBy(F.col("n").alias("level")).agg(F.count("*").alias("types"))
    levels = running_total(levels.withColumn("down", -F.col("level")), [], ["down"], {"before": "types"})
    least = levels.where(F.col("before") + F.col("types") <= KNOWN_WORDS).agg(F.min("level")).first()[0]
    least = 2**62 if least is None else least
    rows = counts.where(F.col("n") >= least).toPandas()  # at most KNOWN_WORDS rows
    rows["word"] = [w.encode() for w in rows["word"]]
    rows = rows.sort_values(["n", "word"], ascending=[False, True])
    words = rows["word"].tolist()
    clustered = clustered_words(rows["n"])

    def by_ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, types = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
        for batch in batches:
            kinds = endings(batch.column("word"))
            n += np.bincount(kinds, batch.column("n").to_numpy(), ENDINGS).astype(np.int64)
            types += np.bincount(kinds, minlength=ENDINGS)
        yield pa.RecordBatch.from_arrays([pa.array(range(ENDINGS), pa.int64()), pa.array(n), pa.array(types)], names=["e", "n", "types"])

    totals = np.zeros((ENDINGS, 2), np.int64)
    summed = counts.mapInArrow(by_ending, "e long, n long, types long").groupBy("e").agg(F.sum("n"), F.sum("types"))
    for e, n, types in summed.collect():
        totals[e] = n, types
    all_tokens, all_types = totals.sum(axis=0)
    for word, n in zip(words[:clustered], rows["n"][:clustered], strict=True):
        totals[ending(word)] -= (int(n), 1)
    known = Vocabulary(
        words, rows["n"].to_numpy(np.int64), int(all_tokens) + documents, int(all_types) + (documents > 0), documents, totals[:, 0], totals[:, 1]
    )
    return known, least


def count_bigrams(training: DataFrame, known: Vocabulary) -> DataFrame:
    """(``a``, ``b``, ``n``): neighbours among clustered words, endings and the end, from end to end of a text.

    Bigrams travel as packed numbers, in parts by remainder, of which each holds about ``MERGED`` of a task's results.
    """
    symbols, end = known.symbols(), known.clustered
    width, parts = end + 1 + ENDINGS, 8 + known.tokens // MERGED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        number, each = known.numbering(), -(-width * width // parts)

        def flush() -> pa.RecordBatch:
            pairs = np.concatenate(held)
            pairs = np.sort(pairs % parts * each + pairs // parts)
            first = starts_of_runs(pairs)
            pairs, n = pairs[first], np.diff(first, append=len(pairs))
            ends = np.searchsorted(pairs, np.arange(parts + 1) * each)
            columns = [pa.array(np.arange(parts)), binaries(pairs % each, ends), binaries(n.astype(np.int32), ends)]
            return pa.RecordBatch.from_arrays(columns, names=["part", "pairs", "n"]).filter(pa.array(np.diff(ends) > 0))

        for batch in slices(batches):
            words, counts = tokens(batch.column("text"))
            row = symbols[with_ends(number(words), counts, len(known.words))]
            held.append(row[:-1] * width + row[1:])
            if sum(map(len, held)) > FLUSH_BIGRAMS:
                yield flush()
                held.clear()
        if held:
            yield flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (pairs, n) in by_part(batches, pairs=np.int64, n=np.int32):
            at = ordered(pairs)
            pairs, n = pairs[at], n[at]
            first = starts_of_runs(pairs)
            n = np.add.reduceat(n.astype(np.int64), first)
            pairs = pairs[first] * parts + part
            columns = [(pairs // width).astype(np.int32), (pairs % width).astype(np.int32), n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "n"])

    found = training.select("text").mapInArrow(run, "part long, pairs binary, n binary")
    return found.repartition("part").sortWithinPartitions("part").mapInArrow(merged, "a int, b int, n long")


def with_ends(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The numbers of the words of several texts, with the end's number before, between and after the texts."""
    row = np.full(len(ids) + len(counts) + 1, end, np.int64)
    words = np.ones(len(row), bool)
    words[ends_of(counts)] = False
    row[words] = ids
    return row


def ends_of(counts: np.ndarray) -> np.ndarray:
    """Where :func:`with_ends` puts the ends."""
    return np.concatenate([[0], np.cumsum(counts + 1)])


def starts_of_runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def ordered(keys: np.ndarray) -> np.ndarray:
    """The places of these numbers (from 0) in ascending order. Key and place are sorted as one number, which is faster, if it fits."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> (63 - bits):
        return np.argsort(keys, kind="stable")
    return np.sort((keys.astype(np.int64) << bits) | np.arange(len(keys))) & ((1 << bits) - 1)


def by_part(batches: Iterator[pa.RecordBatch], **kinds: type) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Joins the packed columns of all rows of each ``part``; rows come sorted by it."""
    held: list[list[np.ndarray]] = []
    now = None
    for batch in batches:
        parts = batch.column("part").to_numpy()
        columns = [numbers(batch.column(name), kind) for name, kind in kinds.items()]
        first = starts_of_runs(parts)
        for i, j in zip(first, [*first[1:], len(parts)], strict=True):
            if held and parts[i] != now:
                yield now, [np.concatenate(x) for x in zip(*held, strict=True)]
                held.clear()
            now = int(parts[i])
            held.append([values[ends[i] : ends[j]].copy() for values, ends in columns])
    if held:
        yield now, [np.concatenate(x) for x in zip(*held, strict=True)]


def neighbours(bigrams: DataFrame, known: Vocabulary) -> DataFrame:
    """A row for each clustered word with its neighbours on both sides, packed; those of other words are only one another.

    A file holds the words of equal hash, most frequent first. They are put together in parts of it by rank.
    """
    n, width = known.clustered, known.clustered + 1 + ENDINGS
    files = bigrams.sparkSession.range(width).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(PARTS)).alias("file"))
    files = files.toPandas()["file"].to_numpy(np.int64)  # a number for each clustered word
    steps = 1 + known.tokens // (PARTS * MERGED)
    weight = np.cumsum(np.minimum(np.concatenate([known.counts[:n], np.ones(1 + ENDINGS, np.int64)]), width))
    part_of = files * steps + np.minimum(weight * steps // weight[-1], steps - 1)
    in_parts = np.argsort(part_of, kind="stable")
    place, limits = np.argsort(in_parts), np.searchsorted(part_of[in_parts], np.arange(PARTS * steps + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            a, b, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            right, left = np.flatnonzero((a < n) | (b >= n)), np.flatnonzero((b < n) | (a >= n))
            keys = np.concatenate([place[a[right]] * 2 * width + b[right], (place[b[left]] * 2 + 1) * width + a[left]])
            at = ordered(keys)
            keys, sent = keys[at], counts[np.concatenate([right, left])[at]]
            ends = np.searchsorted(keys, limits * 2 * width)
            words, others = np.divmod(keys, width)
            words = in_parts[words // 2] + words % 2 * width  # on the left, numbered after those on the right
            columns = [pa.array(np.arange(len(limits) - 1)), *[binaries(x, ends) for x in (words.astype(np.int32), others.astype(np.int32), sent)]]
            return pa.RecordBatch.from_arrays(columns, names=["part", "words", "others", "n"]).filter(pa.array(np.diff(ends) > 0))

        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("a", "b", "n")])
            if sum(len(x[0]) for x in held) > DEALT:
                yield flush()
                held.clear()
        if held:
            yield flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (words, others, counts) in by_part(batches, words=np.int32, others=np.int32, n=np.int64):
            at = ordered(words.astype(np.int64) * width + others)
            words, others, counts = words[at], others[at], counts[at]
            found = np.unique(words % width)
            columns = [pa.array(found)]
            for first in (0, width):
                ends = np.searchsorted(words, np.append(found + first, first + width).astype(np.int32))
                here = slice(ends[0], ends[-1])
                columns += [binaries(others[here], ends - ends[0]), binaries(counts[here], ends - ends[0])]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "right", "right_n", "left", "left_n"])

    sent = bigrams.select("a", "b", "n").mapInArrow(run, "part long, words binary, others binary, n binary")
    sent = sent.repartitionById(PARTS, F.floor(F.col("part") / steps).cast("int")).sortWithinPartitions("part")
    return sent.mapInArrow(merged, "word int, right binary, right_n binary, left binary, left_n binary")


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


class Exchange:
    """Rounds of exchange clustering over a table with a row for each clustered word and its neighbours."""

    def __init__(self, bigrams: DataFrame, known: Vocabulary) -> None:
        n = known.clustered
        self.fixed, self.words = 1 + ENDINGS, n
        self.size = CLASSES + self.fixed
        # Every round reads them all: as packed numbers, they pass from the files to Python untouched. The words of a task stay together.
        rows = stage(neighbours(bigrams, known), "neighbours")
        self.rows = rows.where(f"word < {n}")
        self.still = np.zeros((self.size, self.size))
        for batch in rows.where(f"word >= {n}").toArrow().to_batches():  # at most 1 + ENDINGS rows, with as many neighbours
            word, (b, counts, ends) = batch.column("word").to_numpy(), lists(batch, "right")
            self.still[CLASSES + np.repeat(word, np.diff(ends)) - n, CLASSES + b - n] = counts
        by_ending = CLASSES + 1 + endings(pa.array(known.words[:n], pa.binary()))
        of_words = np.where(np.arange(n) < HEADS, np.arange(n) % CLASSES, by_ending)
        self.classes = np.concatenate([of_words, CLASSES + np.arange(self.fixed)])
        self.total = self.matrix(self.classes)

    def run(self, least_gain: float) -> None:
        """Exchanges words until a round that judges all of them gains no more than ``least_gain``."""
        heads = stage(self.rows.where(f"word < {HEADS}"), "heads").coalesce(1).sortWithinPartitions("word")
        while self.round(heads)[1] > least_gain:
            pass
        self.join_favoured()
        every = False
        while True:
            gained = self.round(self.rows, every)[1] > least_gain
            if every and not gained:
                return
            every = not gained

    def join_favoured(self) -> None:
        """Puts the words that have none yet into the class that their neighbours favour."""
        classes, total = self.classes, self.total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = batch.column("word").to_numpy()
                to, new = favoured(batch, classes, total), classes[words] >= CLASSES
                yield pa.RecordBatch.from_arrays([pa.array(words[new], pa.int64()), pa.array(to[new], pa.int64())], names=["word", "to"])

        found = self.rows.mapInArrow(run, "word long, to long").toPandas()  # at most a row for each clustered word
        self.classes = classes.copy()
        self.classes[found["word"].to_numpy(np.int64)] = found["to"].to_numpy(np.int64)
        self.total = self.matrix(self.classes)

    def matrix(self, classes: np.ndarray) -> np.ndarray:
        """Bigrams of classes, counted from the neighbours of all words."""
        size, words = self.size, self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size * size)
            for batch in batches:
                own = classes[batch.column("word").to_numpy()]
                r, rn, ends = lists(batch, "right")
                total += np.bincount(np.repeat(own, np.diff(ends)) * size + classes[r], rn, size * size)
                l, ln, ends = lists(batch, "left")
                outside = l >= words
                total += np.bincount(classes[l[outside]] * size + np.repeat(own, np.diff(ends))[outside], ln[outside], size * size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

        out = self.still.copy().ravel()
        for cell, n in self.rows.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n")).collect():
            out[cell] += n
        return out.reshape(size, size)

    def moved(self, classes: np.ndarray, rows: DataFrame | None = None) -> np.ndarray:
        """Bigrams of classes, from those of the present classes and the neighbours of the words that move, all in ``rows``."""
        old, size, words = self.classes, self.size, self.words
        if 2 * (classes != old).sum() > words:
            return self.matrix(classes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size * size)
            for batch in batches:
                word = batch.column("word").to_numpy()
                batch = batch.filter(pa.array(old[word] != classes[word]))
                word = batch.column("word").to_numpy()
                r, rn, ends = lists(batch, "right")
                own = np.repeat(word, np.diff(ends))
                # The bigrams of two words that move are with the first of them.
                l, ln, ends = lists(batch, "left")
                stays = old[l] == classes[l]
                l, ln, behind = l[stays], ln[stays], np.repeat(word, np.diff(ends))[stays]
                for of, sign in ((classes, 1), (old, -1)):
                    total += sign * np.bincount(of[own] * size + of[r], rn, size * size)
                    total += sign * np.bincount(of[l] * size + of[behind], ln, size * size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

        out = self.total.copy().ravel()
        for cell, n in (rows or self.rows).mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n")).collect():
            out[cell] += n
        return out.reshape(size, size)

    def round(self, rows: DataFrame, every: bool = True) -> tuple[int, float]:
        """Moves words of these rows to better classes: the number of words that moved, and the gain in likelihood.

        Without ``every``, only words whose neighbours favour another class are judged.
        """
        start, size, total = self.classes, self.size, self.total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            classes, cells, out = start.copy(), Cells(total.copy()), []
            for batch in batches:
                words = batch.column("word").to_numpy()
                at = np.arange(len(words)) if every else np.flatnonzero(favoured(batch, classes, cells.total) != classes[words])
                (r, rn, r_ends), (l, ln, l_ends) = lists(batch, "right"), lists(batch, "left")
                for i in at:
                    word, here, there = words[i], slice(r_ends[i], r_ends[i + 1]), slice(l_ends[i], l_ends[i + 1])
                    old, itself = classes[word], rn[here][r[here] == word]
                    right = np.bincount(classes[r[here]], rn[here], size)
                    left = np.bincount(classes[l[there]], ln[there], size)
                    own = float(itself[0]) if len(itself) else 0.0
                    right[old] -= own
                    left[old] -= own
                    cells.add(old, -right, -left, -own)
                    to, gain = cells.best_class(right, left, own, old)
                    cells.add(to, right, left, own)
                    if to != old:
                        classes[word] = to
                        out.append((word, to, gain))
            words, classes_to, gains = zip(*out, strict=True) if out else ((), (), ())
            part = pa.array([TaskContext.get().partitionId()] * len(out), pa.int64())
            columns = [part, pa.array(words, pa.int64()), pa.array(classes_to, pa.int64()), pa.array(gains, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "word", "to", "gain"])

        # At most a row for each clustered word.
        moves = rows.mapInArrow(run, "part long, word long, to long, gain double").toPandas()
        before = likelihood(total)
        parts = moves.groupby("part")["gain"].sum().sort_values(ascending=False, kind="stable").index.tolist()
        while parts:
            chosen = moves[moves["part"].isin(parts)]
            classes = start.copy()
            classes[chosen["word"].to_numpy()] = chosen["to"].to_numpy()
            matrix = self.moved(classes, rows)
            gain = likelihood(matrix) - before
            if gain > 0:
                self.classes, self.total = classes, matrix
                return len(chosen), gain
            parts = parts[: len(parts) // 2]
        return 0, 0.0


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte strings of the numbers in [ends[i], ends[i + 1])."""
    starts = pa.py_buffer((ends * values.dtype.itemsize).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, starts, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all byte strings of a column, and where each string's start and end."""
    wide = column.cast(pa.large_binary())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    size = np.dtype(kind).itemsize
    data = np.frombuffer(wide.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
    return data.view(kind), (ends - ends[0]) // size


def likelihood(total: np.ndarray) -> float:
    """What the assignment of classes adds to the log likelihood of the bigrams."""
    return float(xlogx(total).sum() - xlogx(total.sum(axis=1)).sum() - xlogx(total.sum(axis=0)).sum())


class Cells:
    """Class bigrams with the logs that judging a word needs, kept up as words leave and enter classes.

    ``cells`` and ``logs`` have a row for each class that may follow, then for each that may come before, and a column
    for each class that a word may be in, so that both sides of a word are judged at once.
    """

    def __init__(self, total: np.ndarray) -> None:
        self.total, self.sums, self.size = total, total.sum(axis=1), len(total)
        self.cells = np.concatenate([total[:CLASSES].T, total[:, :CLASSES]])
        self.logs = xlogx(self.cells)

    def add(self, c: int, right: np.ndarray, left: np.ndarray, own: float) -> None:
        """Adds a word to class ``c``: its neighbours other than itself, and how often it follows itself."""
        total, size = self.total, self.size
        total[c] += right
        total[:, c] += left
        total[c, c] += own
        self.sums += left
        self.sums[c] += right.sum() + own
        sides = np.array([total[c], total[:, c]])
        for of, (after, before) in ((self.cells, sides), (self.logs, xlogx(sides))):
            of[:size, c], of[size:, c], of[c], of[size + c] = after, before, before[:CLASSES], after[:CLASSES]

    def best_class(self, right: np.ndarray, left: np.ndarray, own: float, old: int) -> tuple[int, float]:
        """Where a word that is in no class adds most to the likelihood, and how much more than in ``old``."""
        sides = np.concatenate([right, left])
        at = np.flatnonzero(sides)
        cells = self.cells.take(at, axis=0)
        cells += sides[at, None]
        gain = (xlogx(cells) - self.logs.take(at, axis=0)).sum(axis=0)
        # The cell of a class with itself takes both sides at once.
        corner, r, l, sums = self.cells.diagonal(), right[:CLASSES], left[:CLASSES], self.sums[:CLASSES]
        both, one, other, more, now = xlogx(np.array([corner + r + l + own, corner + r, corner + l, sums + right.sum() + own, sums]))
        gain += both - one - other + self.logs.diagonal() - 2 * (more - now)
        to = int(np.argmax(gain))
        more = float(gain[to] - gain[old])
        return (to, more) if more > 1e-6 else (old, 0.0)


def lists(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours on one side of all words of a batch, their counts, and where each word's start and end."""
    ids, ends = numbers(batch.column(side), np.int32)
    return ids, numbers(batch.column(f"{side}_n"), np.int64)[0], ends


def favoured(batch: pa.RecordBatch, classes: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The class under whose present transitions each word's neighbours are likeliest."""
    m, size = batch.num_rows, len(total)
    sides = []
    for side in ("right", "left"):
        ids, n, ends = lists(batch, side)
        at = np.repeat(np.arange(m), np.diff(ends))
        sides.append(np.bincount(at * size + classes[ids], n, m * size).reshape(m, size))
    right, left = sides
    after, before = np.log(total[:CLASSES] + 0.1), np.log(total[:, :CLASSES] + 0.1)
    sums = np.log(total.sum(axis=1)[:CLASSES] + 0.1 * size)
    return np.argmax(right @ after.T + left @ before - 2 * right.sum(axis=1, keepdims=True) * sums, axis=1)


@dataclass
class ClassModel:
    """Logs, to base 10, that score known words: by class and by unigram."""

    known: Vocabulary
    classes: np.ndarray  # of clustered words, the end, and endings
    moves: np.ndarray  # class x class

    def __post_init__(self) -> None:
        known, n = self.known, self.known.clustered
        weight = np.bincount(self.classes[:n], known.counts[:n], len(self.moves))
        ids = known.symbols()[: len(known.words)]
        self.endings = -np.log10(known.ending_tokens + known.ending_types + 1.0)
        in_class = np.where(ids < n, np.log10(np.maximum(known.counts, 1) / np.maximum(weight[self.classes[ids]], 1)), np.log10(known.counts + 1.0))
        rare = ids > n
        in_class[rare] += self.endings[ids[rare] - n - 1]
        self.word_class, self.in_class = self.classes[ids], in_class
        self.floor = -math.log10(known.tokens + known.types + 1)
        self.unigram = np.log10(known.counts + 1.0) + self.floor


def transitions(total: np.ndarray) -> np.ndarray:
    """Logs of smoothed class transitions."""
    own = total.sum(axis=0) + 1.0
    own /= own.sum()
    return np.log10((total + SMOOTHING * own) / (total.sum(axis=1, keepdims=True) + SMOOTHING))


def learn(training: DataFrame, least_gain: float = 0.002) -> tuple[ClassModel, DataFrame]:
    """The model, and the counts of the words that it doesn't hold itself.

    Words are exchanged until a round moves none, or adds less than ``least_gain`` a token to the log likelihood.
    """
    counts = stage(count_words(training), "word-counts")
    known, least = learn_vocabulary(counts, training.count())
    exchange = Exchange(count_bigrams(training, known), known)
    exchange.run(least_gain * known.tokens)
    return ClassModel(known, exchange.classes, transitions(exchange.total)), counts.where(F.col("n") < least)


def score(docs: DataFrame, is_training) -> DataFrame:
    """Scores of every text by a model learned from the rows for which ``is_training`` holds.

    Result: ``doc_id``, ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score`` (the class model), both sums of log10.
    NULL and empty texts have the end alone. Repeated rows are scored each. Without training rows, every word is
    unseen and the scores are those of empty counts. An empty table gives no rows.
    """
    model, others = learn(docs.where(is_training))
    known, end = model.known, model.known.clustered
    first = math.log10((known.documents + 1) / (known.tokens + known.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, count, classes = known.numbering(), len(known.words), np.concatenate([model.word_class, model.classes[end:]])
        logs = np.concatenate([model.in_class, [0.0], model.endings])
        unigram = np.concatenate([model.unigram, [first], np.full(ENDINGS, model.floor)])
        moves, size = model.moves.ravel(), len(model.moves)
        for batch in slices(batches):
            words, counts = tokens(batch.column("text"))
            ids = number(words)
            row = with_ends(ids, counts, count)
            starts, steps = ends_of(counts)[:-1], classes[row]
            base = np.add.reduceat(unigram[row[1:]], starts)
            score = np.add.reduceat(logs[row[1:]] + moves[steps[:-1] * size + steps[1:]], starts)
            # Distinct unseen words of each text, and how often it has them.
            unseen = np.flatnonzero(ids > count)
            rare = words.take(pa.array(unseen)).dictionary_encode()
            text_of = np.searchsorted(np.cumsum(counts), unseen, "right")
            pairs = np.sort(text_of * len(unseen) + rare.indices.to_numpy(zero_copy_only=False))
            at = starts_of_runs(pairs)
            times, (text, word) = np.diff(at, append=len(pairs)), np.divmod(pairs[at], max(len(unseen), 1))
            ends = pa.array(np.searchsorted(text, np.arange(len(counts) + 1)), pa.int32())
            known_n = counts - np.bincount(text_of, minlength=len(counts)) + (known.documents > 0)
            found = pa.ListArray.from_arrays(ends, rare.dictionary.take(pa.array(word)).cast(pa.string()))
            columns = [counts + 1, known_n, base, score, found, pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))]
            names = ["doc_id", "n_tokens", "n_known", "base", "class", "rare", "rare_n"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns[:4]), *columns[4:]], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base double, class double, rare array<string>, rare_n array<long>"
    )
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times"))
    # Words outside the vocabulary: their counts come by a join, and only the log of count + 1 is missing.
    added = (
        rare.join(others.hint("shuffle_hash"), "word")
        .groupBy("row")
        .agg(F.sum("times").alias("also_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("added"))
    )
    return scored.join(added, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("added", F.lit(0.0))).alias("base_score"),
        (F.col("class") + F.coalesce("added", F.lit(0.0))).alias("score"),
    )
