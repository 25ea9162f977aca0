"""Language-model scoring with a log-frequency Bloom filter.

Unigram counts are exact: they are tallied over all blocks of documents. So are the training counts of all pairs of words; a bucket
of pairs quantises them to powers of the square root of two, stores each as that many entries of its segments of the filter, and
answers a block's pairs by repeated probes until one fails. The segments grow with the distinct pairs of a bucket, the buckets with
the corpus; none is gathered or broadcast.

    P(w | u) = MIX * count(u, w) / count(u) + (1 - MIX) * P(w),   P(w) = (c + 0.1) / (N + 0.1 * (V + 1))

A word before w that training lacks leaves P(w). Quantised counts are lower bounds (but for the filter's false positives), so the
probabilities of a context add up to 1 at most.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.blocks import GROUP, per_pair, replied, tally, with_block
from lectern.llm.common import table
from lectern.llm.words import of_texts

MIX = 0.4
#: Blocks whose distinct words, and pairs of words, meet in one bucket, about.
WORD_BLOCKS, PAIR_BLOCKS = 16, 8
SEGMENT_BITS = 1 << 23
BITS_PER_ENTRY, PROBES = 10, 7
LEVELS_PER_DOUBLING = 2
#: The end token's key, and that of a text's beginning as the word before its first.
END, BEGIN = np.uint64(0x0E4D), np.uint64(0x0BE6)


def is_held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text, modulo 10, is 0; so it is for a null id, whose text is empty."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def tokenised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (sorted), token indices into them, and each text's number of tokens; a null text has its end only."""
    _, _, _, hashes, sizes = of_texts(texts, lower=True)
    sizes = sizes + 1
    ends = np.cumsum(sizes) - 1
    every = np.empty(int(sizes.sum()), np.uint64)
    word = np.ones(len(every), bool)
    word[ends] = False
    every[word], every[ends] = hashes, END
    keys, tokens = np.unique(every, return_inverse=True)
    return keys, tokens, sizes


def mixed(codes: np.ndarray, level: int) -> np.ndarray:
    x = codes.astype(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def places(codes: np.ndarray, level: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment, and bit positions (PROBES, n) in it, of each entry."""
    h = mixed(codes, level)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(20)) | np.uint64(1)
    bits = np.stack([(a + np.uint64(i) * b) % np.uint64(SEGMENT_BITS) for i in range(PROBES)])
    return ((h >> np.uint64(40)) % np.uint64(segments)).astype(np.int64), bits.astype(np.int64)


def levels(counts: np.ndarray, floor: float) -> np.ndarray:
    """Quantised counts: 1 at the floor, LEVELS_PER_DOUBLING more for each doubling; 0 below."""
    q = np.floor(LEVELS_PER_DOUBLING * np.log2(np.maximum(counts, 1e-9) / floor) + 1e-9).astype(np.int64) + 1
    return np.maximum(0, q)


def counted(level: np.ndarray, floor: float) -> np.ndarray:
    """The least count of each level."""
    return np.where(level > 0, floor * 2.0 ** ((level - 1.0) / LEVELS_PER_DOUBLING), 0.0)


class Filter:
    """A log-frequency Bloom filter: entry (code, j) for each level j up to a code's quantised count."""

    def __init__(self, bits: np.ndarray, floor: float):
        self.bits, self.floor, self.segments = bits, floor, len(bits)

    def level(self, codes: np.ndarray) -> np.ndarray:
        """Quantised counts; 0 where the first probe fails."""
        level, alive = np.zeros(len(codes), np.int64), np.arange(len(codes))
        j = 0
        while len(alive) and j < 128:
            j += 1
            segment, at = places(codes[alive], j, self.segments)
            ok = np.ones(len(alive), bool)
            for row in at:
                ok &= (self.bits[segment, row >> 3] >> (row & 7).astype(np.uint8)) & 1 == 1
            alive = alive[ok]
            level[alive] = j
        return level

    def count(self, codes: np.ndarray) -> np.ndarray:
        """Lower bounds of the counts; 0 where the first probe fails."""
        return counted(self.level(codes), self.floor)


def count_words(blocked: DataFrame, blocks: int, group: int = GROUP) -> tuple[DataFrame, int]:
    """Training counts over the whole corpus of each block's words (long), and the number of parts they come in; in block -1, per
    bucket, the number of tokens and of distinct words."""

    def ask(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, tokens, sizes = tokenised(rows["text"])
        train = np.repeat([not is_held_out(i) for i in rows["doc_id"]], sizes)
        return keys, np.bincount(tokens[train], minlength=len(keys))

    return tally(blocked, blocks, WORD_BLOCKS, ask, lambda keys, sums: sums, lambda keys, sums: np.array([sums.sum(), (sums > 0).sum()], np.int64), group)


def pair_keys(keys: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Key of (word before, word) for each token; a text's first token follows ``BEGIN``."""
    word = keys[tokens]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return mixed(before, 1) * np.uint64(3) ^ mixed(word, 2)


def filled(codes: np.ndarray, counts: np.ndarray) -> Filter:
    """A filter of all ``codes`` whose count is 1 or more."""
    q = levels(counts, 1.0)
    segments = max(1, math.ceil(int(q.sum()) * BITS_PER_ENTRY / SEGMENT_BITS))
    bits = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for j in range(1, int(q.max(initial=0)) + 1):
        segment, at = places(codes[q >= j], j, segments)
        for row in at:
            np.bitwise_or.at(bits, (segment, row >> 3), (1 << (row & 7)).astype(np.uint8))
    return Filter(bits, 1.0)


def count_pairs(blocked: DataFrame, blocks: int, group: int = GROUP) -> tuple[DataFrame, int]:
    """Quantised training counts over the whole corpus of each block's distinct pairs (a byte each), and the number of parts."""

    def ask(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, tokens, sizes = tokenised(rows["text"])
        pairs, place = np.unique(pair_keys(keys, tokens, sizes), return_inverse=True)
        train = np.repeat([not is_held_out(i) for i in rows["doc_id"]], sizes)
        return pairs, np.bincount(place[train], minlength=len(pairs))

    return tally(blocked, blocks, PAIR_BLOCKS, ask, lambda pairs, sums: filled(pairs, sums).level(pairs).astype(np.uint8), group=group)


def score(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    Null and empty texts have their end token only; long ones are scored whole. A null id counts as one that is held out. Other
    columns are not read; repeated rows count and score each on its own; an empty table gives no rows.
    """
    blocked, blocks = with_block(docs.select("doc_id", "text"))
    words, word_parts = count_words(blocked, blocks, group)
    totals = [np.frombuffer(r["values"], np.int64) for r in words.where("block = -1").select("values").toLocalIterator()]
    n, v = (int(sum(t[k] for t in totals)) for k in (0, 1))
    pairs, pair_parts = count_pairs(blocked, blocks, group)
    known = words.where("block >= 0").withColumn("pair", F.lit(False)).unionByName(pairs.withColumn("pair", F.lit(True)))

    def rate(left: dict, right: dict) -> Iterator[tuple]:
        if not left["doc_id"]:
            return
        keys, tokens, sizes = tokenised(left["text"])
        pair, place = np.unique(pair_keys(keys, tokens, sizes), return_inverse=True)
        told = list(zip(right["pair"], right["part"], right["values"], strict=True))
        c = replied(keys, word_parts, [p for x, p, _ in told if not x], [v for x, _, v in told if not x], np.int64)
        level = replied(pair, pair_parts, [p for x, p, _ in told if x], [v for x, _, v in told if x], np.uint8).astype(np.int64)
        unigram = (c + 0.1) / (n + 0.1 * (v + 1))
        p = unigram[tokens]
        seen = np.empty(len(tokens))
        seen[1:] = c[tokens[:-1]]
        seen[np.cumsum(sizes) - sizes] = c[np.searchsorted(keys, END)]  # each training text begins once and ends once
        share = np.minimum(1.0, counted(level, 1.0)[place] / np.maximum(seen, 1))
        mix = np.where(seen > 0, MIX, 0.0)
        base, probability = np.log10(p), mix * share + (1 - mix) * p
        cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        base, own = np.add.reduceat(base, cuts), np.add.reduceat(np.log10(probability), cuts)
        n_known = np.add.reduceat((c[tokens] > 0).astype(np.int64), cuts)
        for i, size, k, b, s in zip(left["doc_id"], sizes.tolist(), n_known.tolist(), base.tolist(), own.tolist(), strict=True):
            yield i, is_held_out(i), size, k, n, b, s

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return per_pair(blocked, known, "block", schema, rate)


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`score` of all documents."""
    return score(table(spark, sf_dir, "documents"))
