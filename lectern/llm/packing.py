"""Packing: order-preserving dynamic programming over window cuts, with monotone-queue transitions.

The documents of a task, in their order, are one token stream. Windows of at most ``WINDOW`` tokens are cut out of it at
document ends, sentence ends or, in sentences without one for long, at fixed steps. Among all such cuts the dynamic program
takes those with the least padding plus cut penalties:

    f(j) = penalty(j) + SEQUENCE + min over i of f(i) + padding(pos(j) - pos(i))

Padding is WINDOW - length, so the minimum over i is a sliding minimum of f(i) + pos(i), kept in a monotone queue; lengths
that are a power of two need none and are looked up by position. No row is shuffled. A task works on a chunk of tokens at a time and
gives out only what every cheapest way on has in common, so the cuts of a task are the cheapest of its whole stream.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from lectern.llm.bpe import byte_alphabet, vocabulary
from lectern.llm.common import map_stream, table

WINDOW = 1024
#: Penalties, in tokens of padding: a cut at a sentence end inside a document, a cut inside a sentence, and each sequence.
SENTENCE, INSIDE, SEQUENCE = 4, 40, 16
#: A sentence gets further cuts after so many tokens.
STEP = 64
#: New tokens that are packed at a time.
CHUNK = 1 << 18
CACHE = 250_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ByteTokens:
    """Ids of a byte-level vocabulary; words are cached, new ones are merged by the native library."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from public_tokenizers import PATTERN

        spec = json.load(open(path, encoding="utf-8"))
        back = {c: b for b, c in enumerate(byte_alphabet())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.pattern = regex.compile(PATTERN)
        # whatever it is given is one piece
        self.merged = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = {k: array("I", [v]).tobytes() for k, v in special.items()}
        self.specials = regex.compile("(" + "|".join(regex.escape(x) for x in special) + ")")
        self.sentence_end = np.zeros(1 + max([*ranks.values(), *special.values()]), bool)
        for token, i in ranks.items():
            self.sentence_end[i] = token.rstrip(b"\"')").endswith((b".", b"!", b"?", b"\n", "。".encode()))
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.parts: dict[str, bytes] = {}

    def piece(self, word: str) -> bytes:
        """Ids of one pre-token."""
        return array("I", self.merged(word)).tobytes()

    def part(self, word: str) -> bytes:
        """As :meth:`piece`, through a cache of the parts of words with marks or line ends in them."""
        found = self.parts.get(word)
        if found is None:
            found = self.piece(word)
            if len(word) < 64:
                if len(self.parts) >= CACHE // 2:
                    self.parts.clear()
                self.parts[word] = found
        return found

    def after_space(self, word: str) -> bytes | None:
        """Ids of a space and ``word``; None where the tokens depend on what stands around them."""
        if not word or word[0].isspace():
            return None
        if word[-1] in ".,!?;:" and word[:-1].isalpha():
            return (self.young.get(word[:-1]) or self.old.get(word[:-1]) or self.part(" " + word[:-1])) + self.part(word[-1])
        return b"".join([self.part(w) for w in self.pattern.findall(" " + word)])

    def miss(self, word: str) -> bytes | None:
        if word in self.old:
            found = self.old[word]
        elif word.isalpha():
            found = array("I", self.merged(" " + word)).tobytes()
        else:
            found = self.after_space(word)
        if len(word) < 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found

    def plain(self, text: str) -> bytes:
        words = text.split(" ")
        found = list(map(self.young.get, words))
        first = words[0]
        found[0] = b"".join([self.piece(w) for w in self.pattern.findall(first)]) if first else b""
        if None in found:
            miss = self.miss
            found = [miss(w) if f is None else f for w, f in zip(words, found, strict=True)]
            if None in found:  # runs of white space
                return b"".join([self.piece(w) for w in self.pattern.findall(text)])
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|" not in text:
            return self.plain(text)
        return b"".join([self.special.get(x) or (self.plain(x) if x else b"") for x in self.specials.split(text)])


_loaded: dict[str, ByteTokens] = {}


def tokens(path: str) -> ByteTokens:
    if path not in _loaded:
        _loaded[path] = ByteTokens(path)
    return _loaded[path]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Positions (0 and the end among them) where a window may begin or end, and their penalties."""
    penalty = {}
    marks = np.union1d(np.flatnonzero(sentence_end[ids]) + 1, doc_ends)
    marks = np.union1d(marks, [0, len(ids)])
    gaps = np.diff(marks)
    for k in np.flatnonzero(gaps > step):
        for p in range(int(marks[k]) + step, int(marks[k + 1]), step):
            penalty[p] = INSIDE
    pos = np.union1d(marks, np.fromiter(penalty, np.int64, len(penalty))).astype(np.int64)
    cost = np.full(len(pos), SENTENCE, np.int64)
    if penalty:
        cost[np.searchsorted(pos, np.fromiter(penalty, np.int64, len(penalty)))] = INSIDE
    cost[np.searchsorted(pos, doc_ends)] = 0
    return pos, cost


def cheapest(pos: np.ndarray, cost: np.ndarray, window: int = WINDOW) -> tuple[list[int], int]:
    """For each of ``pos``, the cut before it (an index) on the cheapest way there; and the cost of the way to the last. Neighbours in
    ``pos`` lie ``window`` apart at most."""
    m = len(pos)
    where = np.full(int(pos[-1]) + 1, -1, np.int64)
    where[pos] = np.arange(m)
    ends, begins = [], []  # cuts that lie a power of two apart
    n = 1
    while n < window:
        j = np.flatnonzero(pos >= n)
        i = where[pos[j] - n]
        ends.append(j[i >= 0])
        begins.append(i[i >= 0])
        n *= 2
    ends, begins = np.concatenate(ends), np.concatenate(begins)
    order = np.argsort(ends, kind="stable")
    begins, upto = begins[order].tolist(), np.cumsum(np.bincount(ends, minlength=m)).tolist()
    at, pen = pos.tolist(), cost.tolist()
    f, origin = [0] * m, [0] * m
    queue, keys, head, taken = [0], [at[0]], 0, 0
    for j in range(1, m):
        p = at[j]
        while p - at[queue[head]] > window:
            head += 1
        i = queue[head]
        best = keys[head] + window - p
        while taken < upto[j]:
            e = begins[taken]
            taken += 1
            if f[e] < best:
                best, i = f[e], e
        f[j] = total = best + pen[j] + SEQUENCE
        origin[j] = i
        key = total + p
        while len(queue) > head and keys[-1] >= key:
            queue.pop()
            keys.pop()
        queue.append(j)
        keys.append(key)
        if head > 4096:
            del queue[:head], keys[:head]
            head = 0
    return origin, f[-1]


def way(origin: list[int], j: int) -> list[int]:
    """The cuts from the first to the j-th, both included."""
    cuts = [j]
    while j:
        j = origin[j]
        cuts.append(j)
    return cuts[::-1]


def common(origin: list[int], pos: np.ndarray, window: int = WINDOW) -> int:
    """The last cut that is on the way to each of those from which a window can reach beyond the end."""
    m = len(pos)
    first = int(np.searchsorted(pos, pos[-1] - window, side="right"))
    on, n = [False] * first + [True] * (m - first), m - first
    j = m - 1
    while n > 1:
        if on[j]:
            if on[origin[j]]:
                n -= 1
            else:
                on[origin[j]] = True
            on[j] = False
        j -= 1
    return on.index(True)


def pack_stream(docs: Iterator[tuple], sentence_end: np.ndarray, base: int, chunk: int = CHUNK) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, ids bytes, doc_tokens, sequence_id, offset) of ``docs`` (doc_id, ids bytes).

    However the next documents go on, their cheapest cuts begin with those up to :func:`common`. They are given out and forgotten;
    the rest is packed again with what comes, so ``chunk`` does not change how dear the cuts are.
    """
    held: list[tuple] = []  # (doc_id, ids from start on, start, doc_tokens)
    size, due, sequence = 0, chunk, base

    def cut(last: bool) -> Iterator[tuple]:
        nonlocal held, size, due, sequence
        raw = b"".join([d[1] for d in held])
        ends = np.cumsum([len(d[1]) // 4 for d in held])
        pos, cost = cut_points(np.frombuffer(raw, np.uint32), ends, sentence_end)
        origin, _ = cheapest(pos, cost)
        bounds = pos[way(origin, len(pos) - 1 if last else common(origin, pos))].tolist()
        k, begin = 0, 0  # document, and where it begins in the stream
        for a, b in zip(bounds, bounds[1:], strict=False):
            at = a
            while at < b:
                while ends[k] <= at:
                    begin = int(ends[k])
                    k += 1
                i, ids, start, total = held[k]
                upto = min(b, int(ends[k]))
                yield i, start + at - begin, upto - at, ids[4 * (at - begin) : 4 * (upto - begin)], total, sequence, at - a
                at = upto
            sequence += 1
        rest, left = bounds[-1], []
        for (i, ids, start, total), end in zip(held, ends.tolist(), strict=True):
            if end > rest:
                skip = max(0, rest - (end - len(ids) // 4))
                left.append((i, ids[4 * skip :], start + skip, total))
        held, size = left, sum(len(d[1]) // 4 for d in left)
        due = size + chunk

    for i, ids in docs:
        held.append((i, ids, 0, len(ids) // 4))
        size += len(ids) // 4
        if size >= due:
            yield from cut(False)
    if held:
        yield from cut(True)


def pieces(batches: Iterator[list[list]], path: str) -> Iterator[tuple]:
    vocab = tokens(path)
    end = array("I", [0]).tobytes()
    docs = ((i, vocab.encode(text or "") + end) for cols in batches for i, text in zip(*cols, strict=True))
    return pack_stream(docs, vocab.sentence_end, TaskContext.get().partitionId() << 40)


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text; other columns are not read) with their ids.

    A document is its text's ids and a closing 0; a null text counts as empty. Rows with equal or null ids are packed one by one; a
    long text takes several sequences. No documents, no pieces. Order within an input partition is kept; sequences don't span partitions.
    """
    path = path or vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for i, start, length, ids, *rest in pieces(batches, path):
            yield i, start, length, zlib.crc32(ids), *rest, array("I", ids).tolist()

    return map_stream(docs.select("doc_id", "text"), f"{SCHEMA}, ids array<int>", run)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`pack` of all documents: their pieces, each with its ids' checksum."""
    path = vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for i, start, length, ids, *rest in pieces(batches, path):
            yield i, start, length, zlib.crc32(ids), *rest

    return map_stream(table(spark, sf_dir, "documents").select("doc_id", "text"), SCHEMA, run)
