"""Words and word runs of whole texts as hashes, a batch at a time with numpy (no loop over words)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18  # bytes of text worked on at once, at 8 bytes and more in each of some ten arrays; a longer text makes a chunk of its own
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def salted(h: np.ndarray, salt: int) -> np.ndarray:
    return mix(h + np.uint64(salt * int(_BASE) % (1 << 64)))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `size` bytes."""
    buf, at = raw(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end, buf[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


class Words:
    """The words of a chunk of texts: `hash` of each, and `first`, the word number at which each text begins."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, lower: bool = True):
        solid = ~SPACE[buf]
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        cuts = at[:-1][at[:-1] < len(buf)]
        opens[cuts] = solid[cuts]  # a text's first byte begins a word whatever the text before it ends with
        self.start = np.flatnonzero(opens)
        self.first = np.searchsorted(self.start, at)
        self.buf, self.solid = (LOWER[buf] if lower else buf), solid
        self.length = np.add.reduceat(solid, self.start, dtype=np.int64) if len(self.start) else np.zeros(0, np.int64)
        self.hash = self.hashed(self.buf, solid)

    def hashed(self, codes: np.ndarray, use: np.ndarray) -> np.ndarray:
        """One hash a word over the codes where `use` holds."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        place = np.cumsum(use, dtype=np.int64) - use
        place -= np.repeat(np.append(0, place[self.start]), np.diff(np.concatenate(([0], self.start, [len(use)]))))
        power = powers(_BASE, int(place.max(initial=0)) + 1)
        terms = (codes.astype(np.uint64) + np.uint64(1)) * power[place]
        terms[~use] = 0
        return mix(np.add.reduceat(terms, self.start))

    def runs(self, hashes: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of n words within one text, and for each text the number of its first run."""
        count = np.diff(self.first)
        if len(hashes) < n:
            return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
        many = len(hashes) - n + 1
        h = np.zeros(many, np.uint64)
        for k in range(n):
            h = h * _BASE + hashes[k : k + many]
        text = np.repeat(np.arange(len(count)), count)
        inside = text[:many] == text[n - 1 :]
        return salted(h[inside], salt + n), np.concatenate(([0], np.cumsum(np.maximum(count - n + 1, 0))))


class WordHashes(dict):
    """BLAKE2 hashes of words by their bytes, of the recent ones: no two words are made to collide by their spelling.

    `most` bounds the bytes that a worker keeps; an executor may hold several idle workers, each with its own.
    """

    def __init__(self, most: int = 1 << 22):
        self.size, self.most = 0, most

    def __missing__(self, word: bytes) -> int:
        if self.size > self.most:
            self.clear()
            self.size = 0
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self.size += len(word) + 120
            self[word] = h
        return h


_HASHES = WordHashes()


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-word shingles of each text; the whole sequence as one when it has fewer words; none without."""
    for text in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]):
        for value in text:
            found = (value.as_py() or "").encode().lower().split()  # bytes: only A-Z changes, blanks are the ASCII ones
            if not found:
                yield np.zeros(0, np.uint64)
                continue
            hashes = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
            size = min(n, len(hashes))
            runs = np.zeros(len(hashes) - size + 1, np.uint64)
            for k in range(size):
                runs = mix(runs * _BASE + hashes[k : k + len(runs)])
            yield np.unique(salted(runs, size))
