"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is cut into chunks that no piece spans. In a chunk, candidate merges wait in an agenda by the score of
the piece they make, leftmost first; each is skipped with a given chance that depends only on a keyed hash of
the seed, the row, the chunk, its place in the text and the candidate's place, so that encoding is reproducible
anywhere and every occurrence of a chunk is drawn for itself. A skipped candidate changes something only where it is
the next to be merged, so an occurrence draws for these alone. What is remembered of a chunk is a tree: the merges in
turn, and from each the merges that follow when it is skipped, as far as an occurrence has come there. Only
occurrences that leave the tree are merged anew.
Characters without a piece become byte pieces; decoding gives the text back.

Short chunks are merged side by side as rows of a matrix, long ones one by one with a heap; both follow the
same agenda. A model needs BPE pieces, byte pieces and no normalization.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from factloom.llm.text import mixed, slices

SPACE = "▁"
#: Chunks up to so many characters are merged as matrix rows.
MATRIX_LENGTH = 40
#: Widths of the matrices; chunks that are merged at once.
WIDTHS, ROWS = (4, 6, 8, 10, 12, 16, 24, MATRIX_LENGTH), 20_000
#: Chunks that a task remembers beside those of a batch, and merges of all of them.
REMEMBERED, MERGES = 150_000, 1_500_000
#: How often in a batch the trees grow by what occurrences skip; what leaves them after that is not remembered.
GROWTHS = 2
#: Characters of texts that are encoded at once; occurrences that are drawn at once.
SLICE, DRAWN = 2 << 20, 100_000
NEVER = np.iinfo(np.int32).max
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def is_plain(loaded: sentencepiece.SentencePieceProcessor, i: int) -> bool:
    return not (loaded.is_byte(i) or loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i))


def spellings(loaded: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes that each piece stands for."""
    out = []
    for i in range(loaded.get_piece_size()):
        name = loaded.id_to_piece(i)
        written = name.replace(SPACE, " ").encode() if is_plain(loaded, i) else b""
        out.append(bytes([int(name[3:5], 16)]) if loaded.is_byte(i) else written)
    return out


def spelt(ids: np.ndarray | None, names: list[bytes]) -> str | None:
    """The text of these pieces; None for None."""
    if ids is None:
        return None
    return b"".join(map(names.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


class Numbers(dict):
    """Numbers of strings, in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


@dataclass
class Merged:
    """Pieces of chunks, how many each has, and the places of its merges in turn, with their number."""

    ids: np.ndarray
    counts: np.ndarray
    path: np.ndarray
    steps: np.ndarray


class Pieces:
    """Tables of a SentencePiece model."""

    def __init__(self, model: bytes, dropout: float = 0.0, seed: int = 0) -> None:
        loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.dropout, self.seed = dropout, seed
        self.bytes, ids, scores = {}, {}, {}
        for i in range(loaded.get_piece_size()):
            if loaded.is_byte(i):
                self.bytes[int(loaded.id_to_piece(i)[3:5], 16)] = i
            elif is_plain(loaded, i):
                name = loaded.id_to_piece(i)
                ids[name], scores[name] = i, loaded.get_score(i)
        self.names = spellings(loaded)
        if len(self.bytes) < 256 or len(self.names) > 1 << 16:
            raise ValueError("the model must have all byte pieces and at most 65,536 pieces")
        if any(SPACE in n.lstrip(SPACE) or "\n" in n for n in ids):
            raise ValueError("pieces must not span words or lines")
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        size = len(self.names)
        pairs = {}
        for name, i in ids.items():
            for k in range(1, len(name)):
                left, right = ids.get(name[:k]), ids.get(name[k:])
                if left is not None and right is not None:
                    pairs[left * size + right] = (order[scores[name]], i)
        self.pairs, self.size = pairs, size
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in sorted(pairs)], np.int32)
        self.made = np.array([pairs[k][1] for k in sorted(pairs)], np.int32)
        self._hash_pairs()
        self.of_char = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        self.limit = np.uint64(int(dropout * (2**64 - 1)))
        self.forget()

    def _hash_pairs(self) -> None:
        """The pairs in a table by hash; a taken place sends to the next one."""
        self.bits = max(19, (4 * len(self.keys)).bit_length())
        self.slots = np.full((1 << self.bits) + 64, -1, np.int64)
        self.slot_rank, self.slot_made = np.zeros(len(self.slots), np.int32), np.zeros(len(self.slots), np.int32)
        for key, first, rank, made in zip(self.keys.tolist(), self.place_of(self.keys).tolist(), self.ranks.tolist(), self.made.tolist(), strict=True):
            while self.slots[first] >= 0:
                first += 1
            self.slots[first], self.slot_rank[first], self.slot_made[first] = key, rank, made

    def place_of(self, pair: np.ndarray) -> np.ndarray:
        return (pair.astype(np.uint64) * GOLDEN >> np.uint64(64 - self.bits)).astype(np.int64)

    def forget(self) -> None:
        """Remembered chunks: number, keyed hash and first merge (-1: a long chunk).

        Merges of a chunk follow each other, and end with a place that stands for the pieces. Of each: hash and number
        of its place, merges done before it, the merge that was skipped to come here, the merge that follows if it is
        skipped (-1: not known), and the number of the pieces at the end (-1: a merge).
        """
        self.numbers = Numbers()
        self.hashes, self.root = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.drawn, self.spot, self.depth = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.uint8)
        self.above, self.other, self.leaf = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids, self.starts = np.empty(0, np.uint16), np.zeros(1, np.int64)

    def skipped(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the candidate that joins characters [start, middle) and [middle, end) is skipped."""
        return mixed(key ^ place_hash(start, middle, end)) < self.limit

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the merge of neighbours; NEVER where there is none."""
        pair = left.astype(np.int64) * self.size + right
        slot = self.place_of(pair)
        there = self.slots[slot]
        known = there == pair
        missed = np.nonzero(~known & (there >= 0))
        while len(missed[0]):
            slot[missed] += 1
            there = self.slots[slot[missed]]
            hit = there == pair[missed]
            known[tuple(x[hit] for x in missed)] = True
            missed = tuple(x[~hit & (there >= 0)] for x in missed)
        known &= (left >= 0) & (right >= 0)
        return np.where(known, self.slot_rank[slot], NEVER), self.slot_made[slot]

    def chunk_keys(self, chunks: list[str], occurrences: np.ndarray) -> np.ndarray:
        return mixed(self.chunk_hashes(chunks) + occurrences.astype(np.uint64) * GOLDEN)

    def chunk_hashes(self, chunks: list[str]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(c.encode("utf-8", "surrogatepass"), self.seed) for c in chunks], np.uint64)

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()]

    def merge_rows(self, chunks: list[str], lengths: np.ndarray, width: int, keys: np.ndarray | None, blocked: np.ndarray | None) -> Merged:
        """Merges chunks of at most ``width`` characters: without the candidates that ``keys`` skip, or those in the row of ``blocked``."""
        n = len(chunks)
        codes = np.array(chunks, dtype=f"<U{width}").view(np.uint32).reshape(n, width)
        inside = np.arange(width) < lengths[:, None]
        # A symbol stands at its first character; each cell has the next and the one before, and the merge with the next.
        ids = np.where(inside, self.of_char[codes], -1)
        ids = np.concatenate([ids, np.full((n, 2), -1, np.int32)], axis=1)
        wide = width + 2
        after = np.broadcast_to(np.minimum(np.arange(1, wide + 1), wide - 1).astype(np.int32), (n, wide)).copy().ravel()
        before = np.broadcast_to(np.arange(-1, wide - 1, dtype=np.int32), (n, wide)).copy().ravel()
        rank, made = np.full((n, wide), NEVER, np.int32), np.zeros((n, wide), np.int32)
        rank[:, : width - 1], made[:, : width - 1] = self.ranked(ids[:, : width - 1], ids[:, 1:width])
        r, c = np.nonzero(rank < NEVER)
        rank[r[x := self.left_out(r, c, c + 1, c + 2, keys, blocked)], c[x]] = NEVER
        ids, rank_, made = ids.ravel(), rank.ravel(), made.ravel()
        alive = inside.copy()
        path = np.empty((n, max(width - 1, 1)), np.int32)
        steps = np.zeros(n, np.int32)
        row, step = np.arange(n), 0
        while len(row) and width > 1:
            column = (rank if len(row) == n else rank[row]).argmin(axis=1)
            at = row * wide + column
            open_ = rank_[at] < NEVER
            if not open_.all():
                row, column, at = row[open_], column[open_], at[open_]
            if not len(row):
                break
            base = row * wide
            middle = after[at]
            gone = base + middle
            end = after[gone]
            path[row, step] = (column << 12) | (middle << 6) | end
            step += 1
            steps[row] = step
            ids[at], after[at], rank_[gone] = made[at], end, NEVER
            before[base + end] = column
            alive[row, middle] = False
            # The pairs with the neighbours on both sides are new; a cell past the end has no piece.
            start = before[at]
            some = np.flatnonzero(start >= 0)
            left = np.concatenate([base[some] + start[some], at])
            owner = np.concatenate([row[some], row])
            first = np.concatenate([start[some], column])
            second = np.concatenate([column[some], end])
            right = owner * wide + second
            new, new_made = self.ranked(ids[left], ids[right])
            rank_[left], made[left] = new, new_made
            hit = np.flatnonzero(new < NEVER)
            if len(hit) and (keys is not None or blocked is not None):
                out = self.left_out(owner[hit], first[hit], second[hit], after[right[hit]], keys, blocked)
                rank_[left[hit[out]]] = NEVER
        final = ids.reshape(n, wide)[:, :width]
        counts, values = alive.sum(axis=1), final[alive].astype("<u2")
        spelt = np.flatnonzero((alive & (final < 0)).any(axis=1))
        if len(spelt):
            cuts = np.split(values, np.cumsum(counts)[:-1])
            for i in spelt.tolist():
                cuts[i] = np.frombuffer(self.written(chunks[i], final[i][alive[i]], np.flatnonzero(alive[i])), "<u2")
                counts[i] = len(cuts[i])
            values = np.concatenate(cuts)
        return Merged(values, counts, path[np.arange(path.shape[1]) < steps[:, None]], steps)

    def left_out(self, row: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, keys: np.ndarray | None, blocked: np.ndarray | None) -> np.ndarray:
        """Which candidates of these rows may not be merged."""
        out = np.zeros(len(row), bool)
        if keys is not None and self.dropout > 0:
            out = self.skipped(keys[row], start, middle, end)
        if blocked is not None:
            spot = (start.astype(np.int32) << 12) | (middle.astype(np.int32) << 6) | end.astype(np.int32)
            for column in blocked.T:
                out |= column[row] == spot
        return out

    def written(self, chunk: str, ids: np.ndarray, place: np.ndarray) -> bytes:
        if (ids >= 0).all():
            return ids.astype("<u2").tobytes()
        found: list[int] = []
        for i, start in zip(ids.tolist(), place.tolist(), strict=False):
            found += [i] if i >= 0 else self.fallback(chunk[start])
        return np.array(found, "<u2").tobytes()

    def merge_long(self, chunk: str, key: np.uint64) -> bytes:
        """Pieces of one chunk: the agenda as a heap, the symbols as a linked list."""
        ids = self.of_char[np.array([ord(c) for c in chunk], np.int64)].tolist()
        n = len(ids)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and ids[i] >= 0 and ids[j] >= 0 and (hit := self.pairs.get(ids[i] * self.size + ids[j])):
                if self.dropout <= 0 or not self.skipped(key, np.int64(i), np.int64(j), np.int64(end[j])):
                    heapq.heappush(agenda, (hit[0], i, j, end[j], hit[1]))

        for i in range(n):
            offer(i)
        alive = [True] * n
        while agenda:
            _, i, j, stop, made = heapq.heappop(agenda)
            if not (alive[i] and alive[j]) or after[i] != j or end[j] != stop:
                continue
            ids[i], end[i], after[i], alive[j] = made, end[j], after[j], False
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        starts = [i for i in range(n) if alive[i]]
        return self.written(chunk, np.array([ids[i] for i in starts]), np.array(starts))

    def segment(self, chunks: list[str], occurrences: np.ndarray) -> list[bytes]:
        return self.merge(chunks, self.chunk_keys(chunks, occurrences))

    def merge(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """Pieces, as 16-bit numbers, of chunks of any length."""
        out: list[bytes] = [b""] * len(chunks)
        lengths = np.array([len(c) for c in chunks], np.int64)
        for i in np.flatnonzero(lengths > MATRIX_LENGTH).tolist():
            out[i] = self.merge_long(chunks[i], keys[i])
        short = np.flatnonzero(lengths <= MATRIX_LENGTH)
        done = self.merge_short([chunks[i] for i in short.tolist()], keys[short])
        for i, made in zip(short.tolist(), np.split(done.ids, np.cumsum(done.counts)[:-1]) if len(short) else [], strict=True):
            out[i] = made.tobytes()
        return out

    def merge_short(self, chunks: list[str], keys: np.ndarray | None = None, blocked: np.ndarray | None = None) -> Merged:
        """Merges chunks that are not long, in matrices of chunks of about the same length."""
        lengths = np.array([len(c) for c in chunks], np.int64)
        # Few chunks share one matrix.
        kind = np.searchsorted(WIDTHS, lengths) if len(chunks) > ROWS // 10 else np.full(len(chunks), len(WIDTHS) - 1)
        order, parts = [np.empty(0, np.int64)], []
        for k in np.unique(kind).tolist():
            rows = np.flatnonzero(kind == k)
            for cut in range(0, len(rows), ROWS):
                part = rows[cut : cut + ROWS]
                given = (None if x is None else x[part] for x in (keys, blocked))
                parts.append(self.merge_rows([chunks[i] for i in part.tolist()], lengths[part], WIDTHS[k], *given))
                order.append(part)
        back = np.argsort(np.concatenate(order), kind="stable")
        counts, steps = (np.concatenate([np.empty(0, np.int64), *x])[back] for x in ([p.counts for p in parts], [p.steps for p in parts]))
        ids, path = np.concatenate([np.empty(0, np.uint16), *[p.ids for p in parts]]), np.concatenate([np.empty(0, np.int32), *[p.path for p in parts]])
        return Merged(ids[spans(counts, back)], counts, path[spans(steps, back)], steps)

    def remember(self, chunks: list[str]) -> None:
        """Trees of chunks as they are merged if nothing is skipped; long chunks have none."""
        short = [c for c in chunks if len(c) <= MATRIX_LENGTH]
        none, root = np.zeros(len(short), np.int32), np.full(len(chunks), -1, np.int32)
        root[[len(c) <= MATRIX_LENGTH for c in chunks]] = self.grow(self.merge_short(short), none, none - 1)
        self.hashes, self.root = np.concatenate([self.hashes, self.chunk_hashes(chunks)]), np.concatenate([self.root, root])

    def grow(self, merged: Merged, depth: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Adds the merges from the one that comes after ``depth`` others, and the pieces; the first of each."""
        many = (merged.steps - depth + 1).astype(np.int64)  # with the end
        ends = np.cumsum(many)
        step = np.arange(many.sum()) - np.repeat(ends - many - depth, many)
        inner = step < np.repeat(merged.steps, many)
        spot = np.full(len(step), -1, np.int32)
        spot[inner] = merged.path[(np.repeat(np.cumsum(merged.steps) - merged.steps, many) + step)[inner]]
        leaf = np.full(len(step), -1, np.int32)
        leaf[~inner] = len(self.starts) - 1 + np.arange(len(many))
        first = len(self.spot) + ends - many
        self.drawn = np.concatenate([self.drawn, place_hash(spot >> 12, spot >> 6 & 63, spot & 63)])
        self.spot, self.leaf = np.concatenate([self.spot, spot]), np.concatenate([self.leaf, leaf])
        self.depth = np.concatenate([self.depth, step.astype(np.uint8)])
        self.above = np.concatenate([self.above, np.repeat(above, many).astype(np.int32)])
        self.other = np.concatenate([self.other, np.full(len(step), -1, np.int32)])
        self.ids = np.concatenate([self.ids, merged.ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(merged.counts)])
        return first.astype(np.int32)

    def blocked(self, merges: np.ndarray) -> np.ndarray:
        """The places of these merges and of all that were skipped on the way to them, a row for each."""
        columns = []
        while (merges >= 0).any():
            columns.append(np.where(merges >= 0, self.spot[merges], -1))
            merges = np.where(merges >= 0, self.above[merges], -1)
        return np.stack(columns, axis=1)

    def walk(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Goes on from merges as occurrences draw: the end that each reaches, or the merge that it skips where nothing is known, as -2 - merge."""
        out = np.empty(len(at), np.int64)
        for cut in range(0, len(at), DRAWN):
            where, here, key = np.arange(cut, min(cut + DRAWN, len(at))), at[cut : cut + DRAWN], keys[cut : cut + DRAWN]
            while len(where):
                end = self.leaf[here] >= 0
                out[where[end]] = here[end]
                where, here, key = where[~end], here[~end], key[~end]
                skip = mixed(key ^ self.drawn[here]) < self.limit
                to = np.where(skip, self.other[here], here + 1)
                lost = to < 0
                out[where[lost]] = -2 - here[lost].astype(np.int64)
                where, here, key = where[~lost], to[~lost], key[~lost]
        return out

    def encode_all(self, texts: list[str | None], salts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each text has; the draws depend on ``salts`` and the text."""
        chunks: list[str] = []
        starts, counts = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = chunks_of(text)
                chunks += found
                counts[i], starts[i] = len(found), text_hash(text)
        if not chunks:
            return np.empty(0, np.uint16), counts
        ends = np.cumsum(counts)
        order = numbered(mixed(salts ^ starts), counts)
        if len(self.numbers) > REMEMBERED or len(self.spot) > MERGES:
            self.forget()
        ids = np.array(list(map(self.numbers.__getitem__, chunks)), np.int64)
        if len(self.numbers) > len(self.root):
            self.remember(list(islice(self.numbers, len(self.root), None)))
        keys, reached = mixed(self.hashes[ids] + order * GOLDEN), self.root[ids].astype(np.int64)
        short = np.flatnonzero(reached >= 0)
        reached[short] = self.walk(reached[short], keys[short])
        for _ in range(GROWTHS):
            lost = np.flatnonzero(reached < -1)
            if not len(lost):
                break
            left, one = np.unique(-2 - reached[lost], return_index=True)
            merged = self.merge_short([chunks[i] for i in lost[one].tolist()], blocked=self.blocked(left))
            self.other[left] = self.grow(merged, self.depth[left].astype(np.int64), left)
            reached[lost] = self.walk(self.other[-2 - reached[lost]], keys[lost])
        ends_at = np.where(reached >= 0, self.leaf[reached], 0)
        first, many = self.starts[ends_at], self.starts[ends_at + 1] - self.starts[ends_at]
        rest, values = np.flatnonzero(reached < 0), self.ids
        if len(rest):
            made = self.merge([chunks[i] for i in rest.tolist()], keys[rest])
            sizes = np.array([len(x) // 2 for x in made], np.int64)
            first[rest], many[rest] = len(values) + np.cumsum(sizes) - sizes, sizes
            values = np.concatenate([values, np.frombuffer(b"".join(made), "<u2")])
        stops = np.concatenate([[0], np.cumsum(many)])
        return values[np.arange(stops[-1]) + np.repeat(first - stops[:-1], many)], stops[ends] - stops[ends - counts]

    def encode(self, texts: list[str | None], salts: np.ndarray) -> list[np.ndarray | None]:
        """Piece ids of each text. None stays None."""
        values, counts = self.encode_all(texts, salts)
        cuts = np.split(values.astype(np.int32), np.cumsum(counts)[:-1])
        return [None if text is None else x for text, x in zip(texts, cuts, strict=False)]

    def decode(self, ids: np.ndarray | None) -> str | None:
        return spelt(ids, self.names)


#: Stands for the space sign where a text holds it itself, so that it is spelt in bytes. It has no piece, and as half of
#: a surrogate pair it occurs in no text.
LITERAL = "\ud800"
#: A chunk ends before a space sign that follows another character, and around a line end.
CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def chunks_of(text: str) -> list[str]:
    return CHUNK.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE))


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def numbered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """So many numbers for each start."""
    ends = np.cumsum(counts)
    return mixed((np.arange(counts.sum()) - np.repeat(ends - counts, counts)).astype(np.uint64) + np.repeat(starts, counts))


def occurrences(salt: int, text: str, count: int) -> np.ndarray:
    """A number for each chunk of a text, by the place of the chunk, the text and the salt of its row."""
    return numbered(mixed(np.array([salt ^ text_hash(text)], np.uint64)), np.array([count]))


def spans(counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Where the elements of lists are that lie one after another, for the lists in ``order``, which have these counts."""
    given = np.empty(len(counts), np.int64)
    given[order] = counts
    starts = (np.cumsum(given) - given)[order]
    ends = np.cumsum(counts)
    return np.arange(counts.sum()) + np.repeat(starts - (ends - counts), counts)


def place_hash(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((start.astype(np.uint64) << np.uint64(42)) | (middle.astype(np.uint64) << np.uint64(21)) | end.astype(np.uint64))


class _Literal(Pieces):
    """Pieces that spell the stand-in as the sign it stands for."""

    def fallback(self, char: str) -> list[int]:
        return super().fallback(SPACE if char == LITERAL else char)


def load(model: bytes, dropout: float = 0.0, seed: int = 0) -> Pieces:
    return _Literal(model, dropout, seed)


@lru_cache(maxsize=1)
def kept(model: bytes, dropout: float = 0.0, seed: int = 0) -> Pieces:
    """The tables that a Python worker had last."""
    return load(model, dropout, seed)


@lru_cache(maxsize=1)
def kept_names(model: bytes) -> list[bytes]:
    """The spellings that a Python worker had last."""
    return spellings(sentencepiece.SentencePieceProcessor(model_proto=model))


def encode(docs: DataFrame, model: bytes, dropout: float = 0.1, seed: int = 1) -> DataFrame:
    """Adds ``pieces``, the ids of the text's pieces, to the columns of ``docs``.

    A row's segmentation depends on its doc_id, its text and the seed alone. NULL text has NULL pieces, an
    empty text none. A column named ``pieces`` is replaced. An empty table gives no rows.
    """
    rows = docs.drop("pieces")
    carried = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = kept(model, dropout, seed)
        for batch in slices(batches, most=SLICE):
            salts = mixed(batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy().view(np.uint64) + np.uint64(seed))
            text = batch.column("text")
            made, counts = tables.encode_all(text.to_pylist(), salts)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(made.astype(np.int32)), mask=text.is_null())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], lists], names=[*carried, "pieces"])
        tables.forget()  # the worker may do something else next

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """Adds ``decoded``, the text that ``pieces`` spell; NULL for NULL. A column of that name is replaced."""
    rows = encoded.drop("decoded")
    carried = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = kept_names(model)
        for whole in batches:
            for cut in range(0, len(whole), 500):
                batch = whole.slice(cut, 500)
                lists = batch.column("pieces")
                texts = [spelt(x.values.to_numpy() if x.is_valid else None, names) for x in lists]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*carried, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))
