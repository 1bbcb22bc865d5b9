"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that its encoding ends with, and the encoding of the
prefix without that token is what comes before it. So it is enough to store the last token of every prefix: it is the
longest token that ends there and that the merges would leave standing beside the last token of the prefix before it.
Encodings are read backwards from the end; bytes are appended without touching what is there; after an edit only
prefixes near it are worked out anew, up to where the last tokens agree with the old ones again.

Whether two tokens stand beside each other is decided by the merges that made them: each token has one pair of parts,
so its right edge (or left edge) went through a short list of tokens, and the pair stands if no two of these would have
been merged, by their rank, before their own parents were.

A text is first cut by a pattern, and each match is encoded separately. ``slow`` is the merge loop itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from factloom.llm.text import slices

#: Matches that a task remembers beside those of a batch.
REMEMBERED = 400_000
#: Prefixes of so few strings are worked out one by one, others side by side.
FEW = 24
#: Places for remembered verdicts on pairs of tokens.
VERDICTS = 1 << 20
SPOT_SHIFT, GOLDEN = np.uint64(64 - 20), np.uint64(0x9E3779B97F4A7C15)
FREE = np.iinfo(np.int64).max


def read_ranks(file: bytes) -> list[bytes]:
    """The tokens of a rank file, each line a token in base 64 and its number; numbers must run from 0."""
    ranks = {int(number): base64.b64decode(token) for token, number in (line.split() for line in file.splitlines() if line)}
    if sorted(ranks) != list(range(len(ranks))) or len(set(ranks.values())) != len(ranks):
        raise ValueError("ranks must be distinct and run from 0")
    return [ranks[i] for i in range(len(ranks))]


@dataclass
class Merges:
    """Tables of a vocabulary, worked out once; they travel to the tasks as they are."""

    tokens: list[bytes]
    left: np.ndarray = field(init=False)
    right: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        ranks = {t: i for i, t in enumerate(self.tokens)}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.left = np.full(len(self.tokens), -1, np.int32)
        self.right = np.full(len(self.tokens), -1, np.int32)
        for i, token in enumerate(self.tokens):
            if len(token) > 1:
                parts = slow(token, ranks, below=i)
                if len(parts) != 2:
                    raise ValueError(f"token {i} is not made by a merge of two earlier tokens")
                self.left[i], self.right[i] = parts
        size = len(self.tokens)
        made = np.flatnonzero(self.left >= 0)
        pair = self.left[made].astype(np.int64) * size + self.right[made]
        order = np.argsort(pair)
        self.pairs, self.merged = pair[order], made[order]
        self.right_edge, self.left_edge = self._edge(self.right), self._edge(self.left)
        self._reversed_trie()

    @classmethod
    def restored(cls, state: dict) -> Merges:
        """The tables from ``vars()`` of others: these are plain lists and arrays, which any executor can read."""
        tables = cls.__new__(cls)
        vars(tables).update(state)
        return tables

    def _edge(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token the tokens its edge went through, last first, and until which merge each stood there."""
        seen, until, counts = [], [], []
        for token in range(len(self.tokens)):
            at, limit, n = token, FREE, 0
            while at >= 0:
                seen.append(at)
                until.append(limit)
                n += 1
                at, limit = int(part[at]), at
            counts.append(n)
        return np.array(seen, np.int64), np.array(until, np.int64), np.concatenate([[0], np.cumsum(counts)])

    def _reversed_trie(self) -> None:
        """Tokens read from their ends: ``step`` maps node * 256 + byte to the next node, ``ends`` a node to its token."""
        step: dict[int, int] = {}
        ends = [-1]
        for i, token in enumerate(self.tokens):
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(ends)
                    ends.append(-1)
            ends[node] = i
        keys = np.array(sorted(step), np.int64)
        self.step_keys, self.step_nodes = keys, np.array([step[k] for k in keys.tolist()], np.int32)
        self.ends = np.array(ends, np.int32)

    def stands(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the merges leave ``first`` and ``second`` standing beside each other."""
        (a, a_until, a_at), (b, b_until, b_at) = self.right_edge, self.left_edge
        n_a, n_b = a_at[first + 1] - a_at[first], b_at[second + 1] - b_at[second]
        both = n_a * n_b
        row = np.repeat(np.arange(len(first)), both)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
        i, j = a_at[first][row] + nth // n_b[row], b_at[second][row] + nth % n_b[row]
        pair = a[i] * len(self.tokens) + b[j]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        rank = np.where(self.pairs[at] == pair, self.merged[at], FREE)
        # Of merges of equal rank the left one comes first: before one in ``second``, after one in ``first``.
        joined = (rank < a_until[i]) & (rank <= b_until[j]) & (rank < FREE)
        out = np.ones(len(first), bool)
        out[row[joined]] = False
        return out


def slow(text: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[int]:
    """The merge loop: of all neighbours that make a token (of a rank ``below``), those of the least rank, leftmost first."""
    parts = [text[i : i + 1] for i in range(len(text))]
    while len(parts) > 1:
        found = [(ranks.get(a + b, FREE), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(found)
        if rank == FREE or (below is not None and rank >= below):
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Encoder:
    """Encodes byte strings with the tables of a vocabulary."""

    def __init__(self, merges: Merges, pattern: str) -> None:
        self.merges, self.pattern = merges, regex.compile(pattern)
        self.lengths = np.array([len(t) for t in merges.tokens], np.int64)
        self.known: dict[str, bytes] = {}
        self.pair_keys, self.pair_stands = np.full(VERDICTS, -1, np.int64), np.zeros(VERDICTS, bool)
        self.pair_memo: dict[int, bool] = {}

    @cached_property
    def step(self) -> dict[int, int]:
        return dict(zip(self.merges.step_keys.tolist(), self.merges.step_nodes.tolist(), strict=True))

    def stands(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Verdicts of :meth:`Merges.stands`, remembered."""
        pair = first.astype(np.int64) * len(self.lengths) + second
        spot = (pair.astype(np.uint64) * GOLDEN >> SPOT_SHIFT).astype(np.int64)
        out = self.pair_stands[spot]
        new = np.flatnonzero(self.pair_keys[spot] != pair)
        if len(new):
            _, one, back = np.unique(pair[new], return_index=True, return_inverse=True)
            verdict = self.merges.stands(first[new][one].astype(np.int64), second[new][one].astype(np.int64))
            out[new] = verdict[back]
            self.pair_keys[spot[new][one]], self.pair_stands[spot[new][one]] = pair[new][one], verdict
            # Two pairs that fall on one place in the same call: the place must hold the verdict of the pair it names.
            lost = self.pair_keys[spot[new][one]] != pair[new][one]
            if lost.any():
                self.pair_keys[spot[new][one][lost]] = -1
        return out

    def stand(self, first: int, second: int) -> bool:
        pair = first * len(self.lengths) + second
        if pair not in self.pair_memo:
            if len(self.pair_memo) > REMEMBERED:
                self.pair_memo.clear()
            self.pair_memo[pair] = bool(self.merges.stands(np.array([first]), np.array([second]))[0])
        return self.pair_memo[pair]

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of ``data[:end]``, given those of all shorter prefixes (``last[i]`` is that of i + 1 bytes)."""
        node, at, found = 0, end, []
        step, ends = self.step, self.merges.ends
        while at > 0:
            at -= 1
            node = step.get(node << 8 | data[at], 0)
            if not node:
                break
            token = int(ends[node])
            if token >= 0:
                found.append((token, at))
        for token, at in reversed(found):
            if at == 0 or self.stand(last[at - 1], token):
                return token
        raise AssertionError("a byte always stands")

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Appends the last tokens of the prefixes of ``data`` that are longer than those known."""
        for end in range(len(last) + 1, len(data) + 1):
            last.append(self.last_token(data, end, last))
        return last

    def side_by_side(self, strings: list[bytes]) -> list[np.ndarray]:
        """Last tokens of all prefixes of many strings, one length of prefix after the other."""
        sizes = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        text = np.frombuffer(b"".join(strings[i] for i in order), np.uint8)
        begins = np.cumsum(sizes) - sizes
        last = np.full(len(text), -1, np.int32)
        # Beyond the length that only a few strings have, these go on alone.
        longest = int(sizes[FEW]) if len(sizes) > FEW else 0
        for end in range(1, longest + 1):
            rows = begins[: np.searchsorted(-sizes, -end, side="right")]
            self._column(text, last, rows, end)
        out: list[np.ndarray] = [last[:0]] * len(strings)
        for i, begin, size in zip(order.tolist(), begins.tolist(), sizes.tolist(), strict=True):
            mine = last[begin : begin + size]
            if size > longest:
                mine = np.array(self.extend(strings[i], mine[:longest].tolist()), np.int32)
            out[i] = mine
        return out

    def _column(self, text: np.ndarray, last: np.ndarray, rows: np.ndarray, end: int) -> None:
        """Fills in the last tokens of the first ``end`` bytes of the strings that begin at ``rows``."""
        m = self.merges
        node, alive = np.zeros(len(rows), np.int64), np.arange(len(rows))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, end + 1):
            key = node << 8 | text[rows[alive] + (end - length)]
            at = np.minimum(np.searchsorted(m.step_keys, key), len(m.step_keys) - 1)
            there = m.step_keys[at] == key
            alive, node = alive[there], m.step_nodes[at[there]].astype(np.int64)
            if not len(alive):
                break
            token = m.ends[node]
            is_token = token >= 0
            found.append((alive[is_token], token[is_token]))
        open_ = np.ones(len(rows), bool)
        for length in range(len(found), 0, -1):
            row, token = found[length - 1]
            still = open_[row]
            row, token = row[still], token[still]
            if length < end:
                fits = self.stands(last[rows[row] + (end - length - 1)], token)
                row, token = row[fits], token[fits]
            last[rows[row] + (end - 1)] = token
            open_[row] = False

    def read_back(self, last, begin: int, end: int) -> list[int]:
        """The tokens of the bytes from ``begin`` to ``end``, where ``last`` holds last tokens of prefixes from ``begin``."""
        out = []
        lengths = self.lengths
        while end > begin:
            token = int(last[end - 1])
            out.append(token)
            end -= int(lengths[token])
        return out[::-1]

    def packed(self, strings: list[bytes]) -> list[bytes]:
        """Tokens of many strings as little-endian 32-bit numbers."""
        lasts = self.side_by_side(strings)
        sizes = np.array([len(x) for x in lasts], np.int64)
        flat = np.concatenate(lasts) if lasts else np.empty(0, np.int32)
        begins = np.cumsum(sizes) - sizes
        # All strings are read back at once: a step takes the last token of what is left of each.
        where, rows, taken = begins + sizes, np.arange(len(lasts)), []
        while len(rows):
            token = flat[where[rows] - 1]
            taken.append((rows, token))
            where[rows] -= self.lengths[token]
            rows = rows[where[rows] > begins[rows]]
        row = np.concatenate([r for r, _ in taken]) if taken else np.empty(0, np.int64)
        turn = np.repeat(np.arange(len(taken)), [len(r) for r, _ in taken])
        token = np.concatenate([t for _, t in taken]) if taken else np.empty(0, np.int32)
        order = np.lexsort((-turn, row))
        data = token[order].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(row, minlength=len(lasts)))
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Tokens of texts as little-endian 32-bit numbers; none for None. Every match is worked out once and remembered."""
        matches = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [m for m in set(chain.from_iterable(matches)) if m not in self.known]
        if new:
            self.known.update(zip(new, self.packed([as_bytes(m) for m in new]), strict=True))
        known = self.known
        return [b"".join([known[m] for m in found]) for found in matches]

    def prefixes(self, text: str) -> Prefixes:
        return Prefixes(self, text)


def as_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Prefixes:
    """A text with the last token of every prefix of every match, for appends and edits.

    ``worked`` counts the prefixes worked out so far.
    """

    def __init__(self, encoder: Encoder, text: str = "") -> None:
        self.encoder, self.text, self.worked = encoder, "", 0
        self.begins: list[int] = []  # of matches, in characters
        self.lasts: list[list[int]] = []
        self.edit(0, 0, text)

    def tokens(self) -> list[int]:
        return [t for last in self.lasts for t in self.encoder.read_back(last, 0, len(last))]

    def append(self, text: str) -> None:
        self.edit(len(self.text), len(self.text), text)

    def edit(self, begin: int, end: int, text: str) -> None:
        """Replaces the characters from ``begin`` to ``end``.

        The pattern is matched again from the first match that could look at the edit: it sees at most one character
        beyond its end. It stops where a new match ends at the old end of a match after the edit. In a match that
        changes, last tokens before the edit stay, and those after it are taken over once as many of them as the
        longest token has bytes agree.
        """
        old, shift = self.text, len(text) - (end - begin)
        new = old[:begin] + text + old[end:]
        stops = [*self.begins[1:], len(old)] if self.begins else []
        first = 0
        while first < len(stops) and stops[first] + 1 < begin:
            first += 1
        starts_after = {b + shift: i for i, b in enumerate(self.begins) if b >= end and i >= first}
        at = self.begins[first] if first < len(self.begins) else len(new)
        if first >= len(self.begins):
            at = stops[-1] if stops else 0
        begins, lasts, resume = [], [], len(self.begins)
        while at < len(new):
            if at in starts_after and at >= begin + len(text):
                resume = starts_after[at]
                break
            found = self.encoder.pattern.match(new, at)
            if not found or found.end() == at:
                at += 1  # a pattern may leave characters out
                continue
            i = first + len(begins)
            before = self.lasts[i] if i < len(self.lasts) and self.begins[i] == at else []
            begins.append(at)
            lasts.append(self._again(as_bytes(found.group()), as_bytes(old[at : stops[i]]) if before else b"", before))
            at = found.end()
        self.text = new
        self.begins = self.begins[:first] + begins + [b + shift for b in self.begins[resume:]]
        self.lasts = self.lasts[:first] + lasts + self.lasts[resume:]

    def _again(self, data: bytes, old: bytes, before: list[int]) -> list[int]:
        same = 0
        while same < min(len(data), len(old)) and data[same] == old[same]:
            same += 1
        tail = 0
        while tail < min(len(data), len(old)) - same and data[-1 - tail] == old[-1 - tail]:
            tail += 1
        last, agree = before[:same], 0
        longest = int(self.encoder.lengths.max())
        while len(last) < len(data):
            # Within the common tail, a run of equal last tokens as long as any token decides all that follow.
            if agree >= longest:
                return last + before[len(last) - len(data) + len(old) :]
            last.append(self.encoder.last_token(data, len(last) + 1, last))
            self.worked += 1
            there = len(last) - 1 - len(data) + len(old)
            in_tail = len(data) - len(last) < tail
            agree = agree + 1 if in_tail and before[there] == last[-1] else 0
        return last


def load(file: bytes) -> Merges:
    return Merges(read_ranks(file))


def encode(docs: DataFrame, merges: Merges, pattern: str) -> DataFrame:
    """Adds ``token_bytes``, the ids of the text's tokens as little-endian 32-bit numbers, to the columns of ``docs``.

    NULL and empty texts have none. A column of that name is replaced. An empty table gives no rows.
    """
    rows = docs.drop("token_bytes")
    carried, shared = rows.columns, _shared(docs.sparkSession, merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges.restored(shared.value), pattern)
        for batch in slices(batches):
            made = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.array(made, pa.binary())], names=[*carried, "token_bytes"]
            )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("token_bytes", T.BinaryType())]))


def decode(encoded: DataFrame, merges: Merges) -> DataFrame:
    """Adds ``decoded``, the bytes that ``token_bytes`` spell; NULL for NULL. A column of that name is replaced."""
    rows = encoded.drop("decoded")
    carried, shared = rows.columns, _shared(encoded.sparkSession, merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value["tokens"]
        for whole in batches:
            for cut in range(0, len(whole), 500):
                batch = whole.slice(cut, 500)
                lists = batch.column("token_bytes").to_pylist()
                texts = [None if x is None else b"".join([names[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in lists]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*carried, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def edit(docs: DataFrame, merges: Merges, pattern: str) -> DataFrame:
    """Applies ``edits`` (an array of structs begin, end, text; offsets in characters) to ``text`` in turn, and encodes.

    Only what an edit can reach is worked out anew. ``text`` becomes the edited text (NULL counts as empty);
    ``token_bytes`` is added as by :func:`encode`, and ``reworked``, the prefixes that the edits had worked out anew.
    NULL edits are none; offsets beyond the text mean its end. Columns of these names are replaced.
    """
    rows = docs.drop("token_bytes", "reworked")
    carried, shared = rows.columns, _shared(docs.sparkSession, merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges.restored(shared.value), pattern)
        for batch in slices(batches):
            texts, packed, worked = [], [], []
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                held = encoder.prefixes(text or "")
                before = held.worked
                for e in edits or []:
                    size = len(held.text)
                    begin = min(max(e["begin"] or 0, 0), size)
                    held.edit(begin, min(max(size if e["end"] is None else e["end"], begin), size), e["text"] or "")
                texts.append(held.text)
                packed.append(np.array(held.tokens(), "<u4").tobytes())
                worked.append(held.worked - before)
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(packed, pa.binary()), pa.array(worked, pa.int64())], names=[*carried, "token_bytes", "reworked"]
            )

    extra = [T.StructField("token_bytes", T.BinaryType()), T.StructField("reworked", T.LongType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *extra]))


def _shared(spark: SparkSession, merges: Merges):
    """The tables, sent once to every executor: a few megabytes, whatever the corpus."""
    return spark.sparkContext.broadcast(vars(merges))
