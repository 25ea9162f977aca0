"""Words of UTF-8 texts and their 64-bit hashes, a block at a time.

A word is a run of bytes other than space and 9 to 13. Its hash is XXH3 of its bytes.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text whose words are Python objects at a time.
CHUNK = 1 << 20
SPACES = bytes([9, 10, 11, 12, 13, 32])
#: bytes.translate table that turns every white-space byte into a space.
TO_SPACE = bytes(32 if b in SPACES else b for b in range(256))

_is_word = np.array([b not in SPACES for b in range(256)], np.int8)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in ``raw``."""
    from xxhash import xxh3_64_intdigest

    change = np.diff(_is_word[np.frombuffer(raw, np.uint8)], prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + CHUNK))
        out[i:j] = np.fromiter(map(xxh3_64_intdigest, raw[starts[i] : ends[j - 1]].split()), np.uint64, j - i)
        i = j
    return starts, ends, out


def of_texts(texts: list[str | None], lower: bool = False) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(raw, starts, ends, hashes, number of words of each text); ``raw`` is the texts' bytes, a line break after each.

    A null text has no words. ``lower`` turns A-Z, and no other letters, into a-z.
    """
    parts = [(t or "").encode() for t in texts]
    raw = b"\n".join([*parts, b""])
    if lower:
        raw = raw.lower()
    starts, ends, hashes = hashed(raw)
    borders = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)])
    return raw, starts, ends, hashes, np.diff(np.searchsorted(starts, borders))
