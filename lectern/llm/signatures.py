"""Word-shingle sets of texts, their positional signatures and the comparison of a list's members.

A signature holds a byte at each of ``PLACES`` positions, taken from a min-hash of the set. Two sets share a position's min-hash
with the probability of their Jaccard similarity, so how many positional bytes they share tells what they can have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate
from math import comb

import numpy as np

from lectern.llm.words import mix, of_texts

LISTS, TAKEN = 16, 4
PLACES = LISTS * TAKEN
#: Share of the pairs at the least similarity that the count filter may lose.
LOST = 1e-6
_factors = np.random.default_rng(7).integers(0, 1 << 63, (PLACES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def fewest(least: float) -> int:
    """Positional bytes that two sets of similarity ``least`` share, but for ``LOST`` of such pairs."""
    below = accumulate(comb(PLACES, k) * least**k * (1 - least) ** (PLACES - k) for k in range(PLACES))
    return sum(p <= LOST for p in below)


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a text of fewer words is one shingle, as is one without words."""
    _, _, _, hashes, sizes = of_texts(texts, lower=True)
    at = 0
    for n in sizes.tolist():
        own, at = hashes[at : at + n], at + n
        k = min(n, words)
        h = np.full(max(1, n - k + 1), k, np.uint64)
        for i in range(k):
            h = mix(h * _STEP + own[i : i + len(h)])
        yield np.unique(h)


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def signature(own: np.ndarray) -> tuple[bytes, list[int]]:
    """(positional bytes, keys of the lists): a list's key is taken from ``TAKEN`` positions, their min-hashes whole, since four
    bytes alone would bring strangers together where texts are many."""
    least = np.full(PLACES, np.iinfo(np.uint64).max)
    for at in range(0, len(own), 2048):
        np.minimum(least, (own[at : at + 2048] * _factors).min(axis=1), out=least)
    key = np.arange(LISTS, dtype=np.uint64)
    for row in least.reshape(LISTS, TAKEN).T:
        key = mix(key * _STEP + row)
    return (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes(), key.view(np.int64).tolist()


def verified(own: np.ndarray, others: list[np.ndarray], least: float) -> np.ndarray:
    """Which of ``others`` have a Jaccard similarity to ``own`` of ``least`` or more."""
    size = np.array([len(s) for s in others])
    values = np.concatenate(others)
    hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(size)[:-1]]), dtype=np.int64)
    return both >= least * (size + len(own) - both) - 1e-9


def links_within(rep: list[int], signs: list[bytes], sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """A forest (rep, rep of its root) over a list's members that verified pairs connect.

    Shared positional bytes are tallied for each pair that comes up; only pairs with enough of them are verified.
    """
    marks = np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), PLACES)
    enough, left = fewest(least), np.arange(len(rep))
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        front = [root]
        while front and len(left):
            i = front.pop()
            close = np.flatnonzero((marks[left] == marks[i]).sum(axis=1) >= enough)
            if not len(close):
                continue
            on = close[verified(sets[i], [sets[j] for j in left[close]], least)]
            found, left = left[on].tolist(), np.delete(left, on)
            front += found
            for j in found:
                yield rep[j], rep[root]
