"""Words of texts, and hashes of runs of words, for whole batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Words that are hashed together at most; longer lists are cut, with overlap.
CHUNK_WORDS = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers (a bijection), so that any of their bits can be used."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words of a text, cut at ASCII white space; none for None."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WindowHasher:
    """64-bit hashes of windows of consecutive words, equal for equal word sequences.

    The words are joined by single spaces; the hash of bytes [a, b) is a polynomial in an odd base, taken
    from prefix sums and an inverse power, then scrambled. All arithmetic wraps at 64 bits.
    """

    def __init__(self, seed: int = 1) -> None:
        byte = np.arange(256, dtype=U64) + U64(seed * 1_000_003)
        self.values = mixed(mixed(byte * U64(0x9E3779B97F4A7C15)))
        base = int(mixed(np.array([seed + 77], dtype=U64))[0]) | 1
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=U64)

    def _reach(self, length: int) -> None:
        if len(self.up) < length:
            length = 1 << (length - 1).bit_length()
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, U64), np.full(length - 1, x, U64)])) for x in (self.base, self.inverse)
            )

    def windows(self, words: list[bytes], size: int) -> np.ndarray:
        """The hash of ``words[i : i + size]`` for every i that has so many."""
        count = len(words) - size + 1
        if count <= 0:
            return np.empty(0, U64)
        if count > CHUNK_WORDS:
            cuts = range(0, count, CHUNK_WORDS)
            return np.concatenate([self.windows(words[i : i + CHUNK_WORDS + size - 1], size) for i in cuts])
        data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        self._reach(len(data) + 1)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        first, last = starts[:count], ends[size - 1 :]
        return mixed((sums[last] - sums[first]) * self.down[first])


def within(counts: np.ndarray, size: int) -> np.ndarray:
    """Which windows over the joined words of documents lie within one document; ``counts``: its words."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner[: len(owner) - size + 1] == owner[size - 1 :] if len(owner) >= size else np.empty(0, bool)


def per_document(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of a value for each word over the documents."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each has about ``most`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.utf8_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(sizes) // most
        for p in np.unique(piece):
            rows = np.flatnonzero(piece == p)
            yield batch.slice(int(rows[0]), len(rows))
