"""Counting quotient filters of packed n-grams: lossless counters in little space, merged as sorted runs.

An n-gram of word ids is packed into two halves of equal width and permuted by a Feistel network, which is invertible and
spreads n-grams evenly. The leading bits of the permuted value are its quotient, the others its remainder, kept in full,
so no two n-grams are ever taken for one. A filter is sorted by that value; a block of it, all n-grams with one prefix,
stores run lengths by quotient, remainders in whole bytes, and counts in one byte each, larger ones apart.
"""

from __future__ import annotations

import numpy as np

from caseloom.llm.words import mix, salted

BLOCK = "prefix long, grp long, n int, slots int, wide int, runs binary, rest binary, counts binary, more binary"
_ROUNDS = 4


def _low(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


class Grams:
    """N-grams of `k` ids (2 or 3) of `bits` bits each, 32 at most, as permuted halves (hi, lo) of `half` bits."""

    def __init__(self, k: int, bits: int):
        self.k, self.bits, self.half = k, bits, -(-k * bits // 2)

    def _turned(self, x: np.ndarray, turn: int) -> np.ndarray:
        return salted(x, 7 + turn) & _low(self.half)

    def permuted(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, b, h = [i.astype(np.uint64) for i in ids], self.bits, self.half
        if self.k == 2:
            left, right = ids
        else:
            cut = h - b  # so many bits of the middle id go to the right
            left = (ids[0] << np.uint64(b - cut)) | (ids[1] >> np.uint64(cut))
            right = ((ids[1] & _low(cut)) << np.uint64(b)) | ids[2]
        for turn in range(_ROUNDS):
            left, right = right, left ^ self._turned(right, turn)
        return left, right

    def ids(self, hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
        left, right, b, h = hi, lo, self.bits, self.half
        for turn in reversed(range(_ROUNDS)):
            left, right = right ^ self._turned(left, turn), left
        if self.k == 2:
            return [left, right]
        cut = h - b
        return [left >> np.uint64(b - cut), ((left & _low(b - cut)) << np.uint64(cut)) | (right >> np.uint64(b)), right & _low(b)]

    def counted(self, hi: np.ndarray, lo: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted, equal values as one, their counts (1 each without n) added."""
        if not len(hi):
            return hi, lo, np.zeros(0, np.int64)
        if 2 * self.half <= 64:
            key = (hi << np.uint64(self.half)) | lo
            if n is None:
                key.sort()
                order = None
            else:
                order = np.argsort(key)
                key = key[order]
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            hi, lo = key[start] >> np.uint64(self.half), key[start] & _low(self.half)
        else:
            order = np.lexsort((lo, hi))
            hi, lo = hi[order], lo[order]
            start = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
            size, hi, lo = len(hi), hi[start], lo[start]
        counts = np.diff(np.append(start, len(key) if 2 * self.half <= 64 else size)) if n is None else np.add.reduceat(n[order], start)
        return hi, lo, counts.astype(np.int64)

    def blocks(self, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, prefix_bits: int, grp: int) -> list[tuple]:
        """The blocks of a sorted filter, one a prefix."""
        if not len(hi):
            return []
        prefix = (hi >> np.uint64(self.half - prefix_bits)).astype(np.int64)
        cut = np.concatenate(([0], np.flatnonzero(prefix[1:] != prefix[:-1]) + 1, [len(hi)])).tolist()
        return [self._block(int(prefix[a]), hi[a:b], lo[a:b], counts[a:b], prefix_bits, grp) for a, b in zip(cut, cut[1:], strict=False)]

    def _block(self, prefix: int, hi, lo, counts, prefix_bits: int, grp: int) -> tuple:
        slots = min(self.half - prefix_bits, max(0, len(hi).bit_length() - 1))
        left = self.half - prefix_bits - slots  # bits of the upper half that belong to the remainder
        slot = ((hi >> np.uint64(left)) & _low(slots)).astype(np.int64)
        runs = np.bincount(slot, minlength=1 << slots)
        wide = 1 if runs.max() < 256 else 4
        rest = _bytes_of(hi & _low(left), left) + _bytes_of(lo, self.half)
        big = counts >= 255
        return (prefix, grp, len(hi), slots, wide, runs.astype(f"<u{wide}").tobytes(), rest,
                np.where(big, 255, counts).astype(np.uint8).tobytes(), counts[big].astype("<i8").tobytes())

    def opened(self, row: dict, prefix_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hi, lo, counts) of a block."""
        n, slots = row["n"], row["slots"]
        left = self.half - prefix_bits - slots
        runs = np.frombuffer(row["runs"], f"<u{row['wide']}").astype(np.int64)
        slot = np.repeat(np.arange(1 << slots, dtype=np.uint64), runs)
        upper = -(-left // 8) * n
        hi = _of_bytes(row["rest"][:upper], left, n) | (slot << np.uint64(left)) | np.uint64(row["prefix"] << (self.half - prefix_bits))
        counts = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(row["more"], "<i8")
        return hi, _of_bytes(row["rest"][upper:], self.half, n), counts

    def merged(self, rows: list[dict], prefix_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sorted filter of all blocks."""
        opened = [self.opened(r, prefix_bits) for r in rows]
        return self.counted(*(np.concatenate(x) for x in zip(*opened, strict=True)))


def _bytes_of(x: np.ndarray, bits: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _of_bytes(raw: bytes, bits: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    wide = -(-bits // 8)
    out[:, :wide] = np.frombuffer(raw, np.uint8).reshape(n, wide)
    return out.view("<u8").reshape(n)


def marks(hi: np.ndarray, lo: np.ndarray, half: int, bits: int) -> np.ndarray:
    """Place of a value in a bitmap of 2^bits bits."""
    return (mix(hi ^ mix(lo + np.uint64(half))) & _low(bits)).astype(np.int64)
