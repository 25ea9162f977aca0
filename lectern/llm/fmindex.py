"""A compressed FM-index over word symbols: the Burrows-Wheeler transform in a wavelet tree of packed bits.

A symbol takes one bit a level, and half as much again for rank counts; the suffix order is not kept, only what its owner asks for.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols from each on (prefix doubling); patterns up to that length can be searched."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k, order = 1, np.argsort(rank)
    while k < depth:
        key = rank * (int(rank.max()) + 2)
        key[:-k] += rank[k:] + 1
        order = np.argsort(key)
        step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = step
        k *= 2
        if step[-1] == len(text) - 1:
            break
    return order


class Bits:
    """Packed bits; ones(i): how many are set before position i."""

    def __init__(self, bits: np.ndarray):
        words = len(bits) // 64 + 1
        packed = np.zeros(words * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view(np.uint64)
        self.before = np.zeros(words, np.uint32)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:], dtype=np.uint32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class WaveletTree:
    """Levels of bits from the highest on; each puts symbols with a 0 before those with a 1, order kept."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []  # shift, bits, number of zeros
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (seq >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            seq = np.concatenate([seq[~bit], seq[bit]])
        every = np.arange(top + 1)
        self.starts = self.down(every, np.zeros(top + 1, np.int64)).astype(np.uint32)

    def down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(i)
            i = np.where(c >> shift & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbols ``c`` before positions ``i``."""
        return self.down(c, i) - self.starts[c]

    def nbytes(self) -> int:
        return self.starts.nbytes + sum(b.words.nbytes + b.before.nbytes for _, b, _ in self.levels)


class FmIndex:
    def __init__(self, text: np.ndarray, depth: int, values: np.ndarray):
        """``text``: non-negative symbols, 0 between parts; ``values``: a number for each position, kept in suffix order."""
        order = suffix_order(text, depth)
        self.n, top = len(text), int(text.max())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletTree(text[order - 1], top)
        self.distinct, place = np.unique(values, return_inverse=True)
        self.values = place.astype(np.int32)[order]

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int, batch: int = 1 << 15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a streamed ``text``: for each of ``ends``, how many symbols up to and with it occur at more than one
        place of the index (``most`` at most), and the suffix interval [lo, hi) of that match. Symbol 0 matches nothing.

        Backward search, all positions of a batch at a time.
        """
        length = np.zeros(len(ends), np.int64)
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        for s in range(0, len(ends), batch):
            live = np.arange(s, min(len(ends), s + batch))
            for t in range(most):
                at = ends[live] - t
                c = text[np.maximum(at, 0)]
                on = (at >= 0) & (c > 0)
                live, c = live[on], c[on]
                both = self.first[np.concatenate([c, c])] + self.tree.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
                a, b = both[: len(c)], both[len(c) :]
                several = b - a > 1
                live = live[several]
                if not len(live):
                    break
                lo[live], hi[live], length[live] = a[several], b[several], t + 1
        return length, lo, hi

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least value of each suffix interval; none of them is empty."""
        a, first, back = np.unique(lo * (self.n + 1) + hi, return_index=True, return_inverse=True)
        del a
        cuts = np.stack([lo[first], hi[first]], axis=1).ravel()
        low = np.minimum.reduceat(np.append(self.values, np.iinfo(np.int32).max), cuts)[::2]
        return self.distinct[low[back]]
