"""Removal of repeated passages, found by fixed-block anchors.

A passage of W words that occurs twice holds, in its earlier occurrence, a whole block of W // 2 words that
starts at a multiple of W // 2. So only the non-overlapping blocks of every document are a reference index; every
rolling window of that length probes it. Hits are extended: the W-word windows around a hit are compared whole,
and a word goes if a window over it also starts earlier; neighbouring windows so make up maximal repeats.

Documents are dealt to slices of bounded size by a hash of their id and text. A slice sends its probes to partitions
of the hash space, packed as arrays of a few bytes a window (each hash once for a slice, however often it
occurs there), and gets back the positions of hits; it sends the windows around them in the same way and gets
back the positions that start earlier elsewhere. No pairs are formed, and what one task holds is bounded.
Shortened hashes only make more windows to compare; the last comparison uses 64 bits within a partition
that an independent hash chooses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from factloom.llm.common import WORD
from factloom.llm.text import WindowHasher, mixed, within, words_of

FIRST, LAST = -(2**63), 2**63 - 1
MESSAGE = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
MESSAGE_DDL = "part long, slice long, kind int, data binary"
REPLY = pa.schema([("slice", pa.int64()), ("data", pa.binary())])
REPLY_DDL = "slice long, data binary"
FOUND, SENT = 0, 1


def pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers as one byte for most steps."""
    steps = np.diff(numbers, prepend=0)
    far = steps[steps >= 255].astype("<u4")
    return np.array([len(numbers), len(far)], "<u4").tobytes() + np.minimum(steps, 255).astype("u1").tobytes() + far.tobytes()


def unpack(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The numbers, and where what follows them begins."""
    count, far = np.frombuffer(data, "<u4", 2, at)
    steps = np.frombuffer(data, "u1", count, at + 8).astype(np.int64)
    steps[steps == 255] = np.frombuffer(data, "<u4", far, at + 8 + int(count))
    return np.cumsum(steps), at + 8 + int(count) + 4 * int(far)


class Slice:
    """The documents of one slice in order of id and text, as one list of words.

    The order does not depend on how rows arrive: those that it leaves open have the same text.
    """

    def __init__(self, rows: pa.Table) -> None:
        by = [rows.column(c).to_numpy() for c in ("text_hash", "tie", "order")]
        rows = rows.take(pa.array(np.lexsort(by)))
        self.number = rows.column("slice")[0].as_py()
        self.docs = rows.column("doc").combine_chunks()
        self.docs = self.docs.chunk(0) if isinstance(self.docs, pa.ChunkedArray) else self.docs
        self.texts = self.docs.field("text").to_pylist()
        each = [words_of(t) for t in self.texts]
        self.counts = np.array([len(w) for w in each], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.words = [w for ws in each for w in ws]
        self.order, self.tie = rows.column("order").to_numpy(), rows.column("tie").to_numpy()
        self.rank = ranks(self.order, self.tie)
        self.owner = np.repeat(np.arange(len(each)), self.counts)

    def windows(self, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows that lie within a document, and their hashes."""
        at = np.flatnonzero(within(self.counts, size))
        return at, WindowHasher(seed).windows(self.words, size)[at] if len(at) else np.empty(0, np.uint64)

    def place(self, at: np.ndarray) -> np.ndarray:
        """Position within the document."""
        return at - self.starts[self.owner[at]]


def ranks(order: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Place of each document among those given, from 0; the same document has the same."""
    at = np.lexsort((tie, order))
    new = (np.diff(order[at]) != 0) | (np.diff(tie[at]) != 0)
    out = np.zeros(len(at), np.int64)
    out[at[1:]] = np.cumsum(new)
    return out


def groups(keys: np.ndarray, *then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by key and then by the others, and the first place of every key in it."""
    order = np.lexsort((*then[::-1], keys)) if then else np.argsort(keys, kind="stable")
    found = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)


def message(parts, number: int, kinds, data) -> pa.Table:
    n = len(data)
    return pa.Table.from_arrays(
        [pa.array(parts, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())], schema=MESSAGE
    )


def by_part(part: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each partition, in order of position."""
    order = np.lexsort((at, part))
    for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(rows):
            yield int(part[rows[0]]), rows


def probe(rows: pa.Table, block: int, parts: int) -> pa.Table:
    """A slice's probes for the partitions: each hash once, with whether a reference block has it."""
    own = Slice(rows)
    at, hashes = own.windows(block, 1)
    order, first = groups(hashes)
    if not len(order):
        return message([], own.number, [], [])
    aligned = (own.place(at) % block == 0)[order]
    counts = np.diff(np.append(first, len(order)))
    # What occurs twice in the slice is a hit without asking; it is sent all the same, for other slices.
    again = at[order[np.repeat(counts > 1, counts)]]
    referred = np.logical_or.reduceat(aligned, first)
    at, hashes = at[order[first]], hashes[order[first]]
    part = (hashes % np.uint64(parts)).astype(np.int64)
    to, kinds, data = [], [], []
    for p, chosen in by_part(part, at):
        to.append(p)
        kinds.append(SENT)
        short = (hashes[chosen] >> np.uint64(32)).astype("<u4")
        data.append(pack(at[chosen]) + short.tobytes() + np.packbits(referred[chosen]).tobytes())
    if len(again):
        to.append(own.number % parts)
        kinds.append(FOUND)
        data.append(pack(np.sort(again)))
    return message(to, own.number, kinds, data)


def answer_probes(rows: pa.Table) -> pa.Table:
    """Hits of one partition: hashes that two slices sent, of which a reference block has one."""
    out, slices, at, hashes, referred = [], [], [], [], []
    for number, kind, data in zip(*(rows.column(c).to_pylist() for c in ("slice", "kind", "data")), strict=True):
        if kind == FOUND:
            out.append((number, data))
            continue
        places, end = unpack(data)
        slices.append(np.full(len(places), number, np.int64))
        at.append(places)
        hashes.append(np.frombuffer(data, "<u4", len(places), end))
        referred.append(np.unpackbits(np.frombuffer(data, "u1", -1, end + 4 * len(places)), count=len(places)).astype(bool))
    if hashes:
        slices, at, hashes, referred = map(np.concatenate, (slices, at, hashes, referred))
        order, first = groups(hashes)
        counts = np.diff(np.append(first, len(order)))
        hit = (counts > 1) & np.logical_or.reduceat(referred[order], first)
        out += replies(slices, at, order[np.repeat(hit, counts)])
    return as_replies(out)


def replies(slices: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> list[tuple[int, bytes]]:
    return [(number, pack(at[chosen][rows])) for number, rows in by_part(slices[chosen], at[chosen])]


def as_replies(out: list[tuple[int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], schema=REPLY)


def positions(told: pa.Table) -> np.ndarray:
    found = [unpack(d)[0] for d in told.column("data").to_pylist()]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def extend(rows: pa.Table, told: pa.Table, block: int, window: int, parts: int) -> pa.Table:
    """The windows around a slice's hits, for comparison: each hash once, with what orders its document."""
    if not rows.num_rows or not told.num_rows:
        return message([], 0, [], [])
    own, hits = Slice(rows), positions(told)
    marks = np.zeros(len(own.words) + 1, np.int64)
    np.add.at(marks, np.maximum(hits - (window - block), 0), 1)
    np.add.at(marks, hits + 1, -1)
    near = np.cumsum(marks)[:-1] > 0
    at, hashes = own.windows(window, 2)
    if not len(at):
        return message([], own.number, [], [])
    chosen = near[at]
    other = WindowHasher(3).windows(own.words, window)[at[chosen]]
    at, hashes = at[chosen], hashes[chosen]
    if not len(at):
        return message([], own.number, [], [])
    doc, place = own.rank[own.owner[at]], own.place(at)
    order, first = groups(hashes, doc, place)
    counts = np.diff(np.append(first, len(order)))
    lead = np.repeat(order[first], counts)
    earliest = (doc[order] == doc[lead]) & (place[order] == place[lead])
    later = np.sort(at[order[~earliest]])
    keep = order[earliest]
    at, hashes, other = at[keep], hashes[keep], other[keep]
    part = (mixed(other) % np.uint64(parts)).astype(np.int64)
    to, kinds, data = [], [], []
    for p, c in by_part(part, at):
        docs, held = np.unique(own.owner[at[c]], return_counts=True)
        to.append(p)
        kinds.append(SENT)
        data.append(
            pack(at[c]) + hashes[c].astype("<u8").tobytes()
            + np.array([len(docs)], "<u4").tobytes() + held.astype("<u4").tobytes()
            + np.stack([own.order[docs], own.tie[docs], own.starts[docs]]).astype("<i8").tobytes()
        )
    if len(later):
        to.append(own.number % parts)
        kinds.append(FOUND)
        data.append(pack(later))
    return message(to, own.number, kinds, data)


def answer_windows(rows: pa.Table) -> pa.Table:
    """Windows of one partition that also start earlier, in another document or in another row of the same."""
    out, slices, at, hashes, held, docs = [], [], [], [], [], []
    for number, kind, data in zip(*(rows.column(c).to_pylist() for c in ("slice", "kind", "data")), strict=True):
        if kind == FOUND:
            out.append((number, data))
            continue
        places, end = unpack(data)
        slices.append(np.full(len(places), number, np.int64))
        at.append(places)
        hashes.append(np.frombuffer(data, "<u8", len(places), end))
        end += 8 * len(places)
        n = int(np.frombuffer(data, "<u4", 1, end)[0])
        held.append(np.frombuffer(data, "<u4", n, end + 4))
        docs.append(np.frombuffer(data, "<i8", 3 * n, end + 4 + 4 * n).reshape(3, n))
    if hashes:
        slices, at, hashes, held = map(np.concatenate, (slices, at, hashes, held))
        order, tie, starts = np.concatenate(docs, axis=1)
        # A document's rank among those met here, then the place of the window in it, as one number.
        when = (np.repeat(ranks(order, tie), held) << 32) + at - np.repeat(starts, held)
        order, first = groups(hashes, when)
        counts = np.diff(np.append(first, len(order)))
        later = when[order] > np.repeat(when[order[first]], counts)
        out += replies(slices, at, order[later])
    return as_replies(out)


def cut_text(text: str, gone: np.ndarray) -> str:
    """The text without the words marked in ``gone``, each with the space after it."""
    spans = [m.span() for m in re.finditer(WORD, text)]
    kept, last = [], 0
    for k in np.flatnonzero(gone):
        begin, end = spans[k][0], spans[k + 1][0] if k + 1 < len(spans) else len(text)
        kept.append(text[last:begin])
        last = end
    return "".join([*kept, text[last:]])


def remove(rows: pa.Table, told: pa.Table, window: int, names: list[str], schema: pa.Schema) -> pa.Table:
    if not rows.num_rows:
        return schema.empty_table()
    own = Slice(rows)
    starts = positions(told) if told.num_rows else np.empty(0, np.int64)
    marks = np.zeros(len(own.words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    gone = np.cumsum(marks)[:-1] > 0
    texts, removed = own.texts, []
    for i, (begin, count) in enumerate(zip(own.starts, own.counts, strict=True)):
        part = gone[begin : begin + count]
        removed.append(int(part.sum()))
        if removed[-1]:
            texts[i] = cut_text(texts[i], part)
    columns = [pa.array(texts, pa.string()) if c == "text" else own.docs.field(c) for c in names]
    return pa.Table.from_arrays([*columns, pa.array(own.counts, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_words", "n_removed"])


def deal(docs: DataFrame, names: list[str], slices: int) -> DataFrame:
    """The documents by slice, with what orders them: the id, then the text's hash for those without one."""
    number, text_hash = F.col("doc_id").cast("long"), F.xxhash64("text")
    return docs.select(
        F.pmod(F.xxhash64(number, text_hash), F.lit(slices)).alias("slice"),
        F.coalesce(number, F.lit(LAST)).alias("order"),
        F.when(number.isNull(), text_hash).otherwise(F.lit(FIRST)).alias("tie"),
        text_hash.alias("text_hash"),
        F.struct(*names).alias("doc"),
    )


def remove_repeats(docs: DataFrame, window: int = 20, slice_bytes: int = 4 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """The documents with words cut out that a window of ``window`` words covers which also starts earlier.

    Earlier is a smaller doc_id, or an earlier place in the same document; windows are judged on the input.
    Adds ``n_words`` and ``n_removed`` (columns of those names are replaced); ``text`` is what is left, with
    the white space that follows each kept word. NULL and empty texts have no words and stay. Rows of the same
    doc_id are the same document, so that windows at the same place of both are not earlier than each other. Rows
    without a doc_id come after all others, in order of their text's 64-bit hash; those of the same text are the same
    document. An empty table gives no rows. ``slice_bytes`` and ``part_bytes`` say how much text a slice of
    documents, and a partition of the hash space, stands for; only rows equal in id and text must share a slice.
    """
    block, names = window // 2, [c for c in docs.columns if c not in ("n_words", "n_removed")]
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    slices, parts = max(1, -(-size // slice_bytes)), max(1, -(-size // part_bytes))
    # One shuffle of the documents serves all three passes: each plan below begins with this grouping.
    dealt = deal(docs, names, slices)
    in_slices = lambda: dealt.groupBy("slice")
    out = docs.select(*names).schema.add("n_words", "long").add("n_removed", "long")
    arrow = to_arrow_schema(out)

    probes = in_slices().applyInArrow(lambda t: probe(t, block, parts), MESSAGE_DDL)
    hits = probes.groupBy("part").applyInArrow(answer_probes, REPLY_DDL)
    windows = in_slices().cogroup(hits.groupBy("slice")).applyInArrow(lambda t, h: extend(t, h, block, window, parts), MESSAGE_DDL)
    later = windows.groupBy("part").applyInArrow(answer_windows, REPLY_DDL)
    return in_slices().cogroup(later.groupBy("slice")).applyInArrow(lambda t, h: remove(t, h, window, names, arrow), out)
