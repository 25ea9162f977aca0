"""Repeated word windows across documents, by compressed FM-indexes over content shards.

A window is ``WINDOW`` consecutive words of one document. Its anchor is the least hash among its ``GRAM``-grams, so equal windows
have equal anchors wherever they stand.

1. The documents that have an anchor are tallied over all blocks; anchors of one document only are done with.
2. Windows with a shared anchor go, in runs under the same anchor position, to the shard of that anchor: each distinct run once per
   block, with the least and the greatest document that has it there, however many do. Runs under an anchor of over ``HOT``
   documents are cut into single windows, dealt by the window's own hash, so that no shard holds a third of the corpus.
3. A shard numbers the words of its runs by their bytes, puts the runs in an FM-index and streams them against it: backward search
   over the wavelet tree gives their matching statistics. An interval of ``WINDOW`` words or more occurs elsewhere too; the least
   document in its suffix interval is where it starts first.
4. Blocks cut their runs again, and take out the words of windows that start first in a document before their own.

Hashes choose candidates and shards; what is equal is decided on the words themselves.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.blocks import GROUP, joined, per_group, per_pair, replied, tally, with_block
from lectern.llm.common import importable, materialize, table
from lectern.llm.fmindex import FmIndex
from lectern.llm.words import TO_SPACE, of_texts

WINDOW, GRAM = 13, 5
HOT = 4096
#: Blocks whose distinct anchors meet in one bucket, about.
ANCHOR_BLOCKS = 16
#: A shard gets the shared runs of as much text as this many blocks have, about.
BLOCKS_PER_SHARD = 4
#: Rows without an id come after all others.
LAST = (1 << 63) - 1


def grams(h: np.ndarray, k: int) -> np.ndarray:
    x = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        x *= np.uint64(0x9E3779B97F4A7C15)
        x += h[j : len(h) - k + 1 + j]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def anchors(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, anchor position) of each window that lies in one text, and the hash of the gram at each position."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(h, GRAM)
    least, place = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, WINDOW - GRAM + 1):
        now = g[j : n + j]
        lower = now < least
        least[lower], place[lower] = now[lower], j
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    return starts, starts + place[starts], g


def own_anchors(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`anchors`, then the distinct anchor positions and how many windows each has; positions never fall from one window to
    the next, so those of one anchor follow each other."""
    start, place, g = anchors(h, sizes)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return start, place, g, place[first], np.diff(np.append(first, len(place)))


#: What is known of an anchor: only one document has it, several do, or too many for one shard.
ALONE, SHARED, OFTEN = 0, 1, 2


def count_anchors(blocked: DataFrame, blocks: int, hot: int, group: int) -> tuple[DataFrame, int]:
    """What is known of each block's anchors (a byte each), and the number of parts it comes in."""

    def ask(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        _, _, _, h, sizes = of_texts(rows["text"])
        _, _, g, position, _ = own_anchors(h, sizes)
        owner, key = np.searchsorted(np.cumsum(sizes), position, side="right"), g[position]
        order = np.argsort(key, kind="stable")  # owners stay in order within a key
        key, owner = key[order], owner[order]
        other = np.diff(key, prepend=key[:1] ^ np.uint64(1)) != 0
        first = np.flatnonzero(other)
        return key[first], np.add.reduceat(other | (np.diff(owner, prepend=-1) != 0), first, dtype=np.int64) if len(first) else first

    return tally(blocked, blocks, ANCHOR_BLOCKS, ask, lambda keys, sums: np.where(sums > hot, OFTEN, np.where(sums > 1, SHARED, ALONE)).astype(np.uint8), group=group)


@dataclass
class Runs:
    """A block's runs: for each shard that gets some, the places of its runs, and which of its distinct runs stands there."""

    begin: np.ndarray  # first word of each place, counted over the block
    windows: np.ndarray  # windows of each place
    doc: np.ndarray  # its document
    by_shard: dict[int, tuple[np.ndarray, np.ndarray, list[bytes]]]  # places, run of each, runs


def cut(ids: list, texts: list, told: tuple[list[int], list[bytes]], parts: int, shards: int) -> Runs | None:
    """The runs of a block, of whose anchors ``told`` (see :func:`lectern.llm.blocks.replied`) is known. Distinct runs are sorted: a
    block's rows may come in another order when they are read again."""
    raw, first_byte, end_byte, h, sizes = of_texts(texts)
    start, place, g, position, windows = own_anchors(h, sizes)
    keys, which = np.unique(g[position], return_inverse=True)
    known = replied(keys, parts, *told, np.uint8)
    if not known.any():
        return None
    raw = raw.translate(TO_SPACE)
    of_window = np.repeat(known[which], windows)
    on = of_window > ALONE
    start, place, often = start[on], place[on], of_window[on] == OFTEN
    own = g[place]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | often[1:]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin, end = start[first], start[last] + WINDOW
    key = own[first]
    single = often[first]
    if single.any():
        key[single] = grams(h, WINDOW)[begin[single]]
    owner = np.searchsorted(np.cumsum(sizes), begin, side="right")
    doc = np.array([LAST if i is None else i for i in ids], np.int64)[owner]
    shard = (key % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(order)]
    low, high = first_byte[begin].tolist(), end_byte[end - 1].tolist()
    by_shard = {}
    for s, e in zip(cuts, cuts[1:], strict=False):
        some = order[s:e]
        here = [single_spaced(raw[low[i] : high[i]]) for i in some.tolist()]
        found = sorted(set(here))
        number = dict(zip(found, range(len(found)), strict=True))
        by_shard[int(shard[some[0]])] = some, np.array([number[r] for r in here], np.int32), found
    return Runs(begin, end - begin - WINDOW + 1, doc, by_shard)


def single_spaced(raw: bytes) -> bytes:
    return b" ".join(raw.split()) if b"  " in raw else raw


def sent(blocked: DataFrame, known: DataFrame, parts: int, shards: int) -> DataFrame:
    """(shard, block, words, low, high): each block's distinct runs, packed, with the least and the greatest document of each."""

    def pack(left: dict, right: dict) -> Iterator[tuple]:
        runs = cut(left["doc_id"], left["text"], (right["part"], right["values"]), parts, shards) if left["doc_id"] else None
        if runs is None:
            return
        for shard, (places, which, found) in runs.by_shard.items():
            low, high = np.full(len(found), LAST, np.int64), np.full(len(found), -LAST - 1, np.int64)
            np.minimum.at(low, which, runs.doc[places])
            np.maximum.at(high, which, runs.doc[places])
            yield shard, left["block"][0], zlib.compress(b"\n".join(found), 1), low.tobytes(), high.tobytes()

    return per_pair(blocked, known, "block", "shard int, block int, words binary, low binary, high binary", pack)


def first_documents(found: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each run (words, single-spaced), the least document that has it; and where each run's windows begin in
    that list.

    ``docs``: the least document of each run.
    """
    sizes = np.array([r.count(b" ") + 1 for r in found])
    windows = sizes - WINDOW + 1
    begin = np.concatenate([[0], np.cumsum(windows)])
    words = b" ".join(found).split(b" ")
    distinct = dict.fromkeys(words)
    number = dict(zip(distinct, range(len(distinct)), strict=True))
    word = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    del words, distinct, number
    # symbol 0 parts runs and stands for words that occur once: no window with one of them is elsewhere too
    often = np.bincount(word) > 1
    symbol = np.where(often, np.cumsum(often), 0)[word]
    run_of = np.repeat(np.arange(len(found)), sizes)
    text = np.zeros(len(symbol) + len(found), np.int64)
    text[np.arange(len(symbol)) + run_of] = symbol
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    own = np.repeat(np.arange(len(found)), windows)
    last = starts[own] + np.arange(len(own)) - begin[own] + WINDOW - 1  # of each window
    least = docs[own]
    breaks = np.concatenate([[0], np.cumsum(text == 0)])
    asked = np.flatnonzero(breaks[last + 1] == breaks[last + 1 - WINDOW])  # others can't reach the threshold
    if len(asked):
        index = FmIndex(text, WINDOW, np.repeat(docs, sizes + 1))
        length, lo, hi = index.matching(text, last[asked], WINDOW)
        above = length >= WINDOW
        if above.any():
            least[asked[above]] = index.least(lo[above], hi[above])
    return least, begin


def report(runs: DataFrame) -> DataFrame:
    """(block, shard, runs, least): per block, the runs with a window to remove, and the first document of each of their windows.
    Written to the shared folder."""

    def search(group: dict) -> Iterator[tuple]:
        number: dict[bytes, int] = {}
        which = []
        for words in group["words"]:
            which.append(np.array([number.setdefault(r, len(number)) for r in zlib.decompress(words).split(b"\n")], np.int64))
        docs = np.full(len(number), LAST, np.int64)
        np.minimum.at(docs, np.concatenate(which), joined(group["low"], np.int64))
        least, begin = first_documents(list(number), docs)
        low = np.minimum.reduceat(least, begin[:-1])
        for block, ids, high in zip(group["block"], which, group["high"], strict=True):
            on = np.flatnonzero(low[ids] < np.frombuffer(high, np.int64)).astype(np.int32)
            if len(on):
                parts = [least[begin[r] : begin[r + 1]] for r in ids[on].tolist()]
                yield block, group["shard"][0], on.tobytes(), zlib.compress(np.concatenate(parts).tobytes(), 1)

    return materialize(per_group(runs, ["shard"], "block int, shard int, runs binary, least binary", search), runs)


@dataclass(frozen=True)
class Plan:
    """Into how many parts what is known of anchors comes, and among how many shards runs are dealt."""

    parts: int
    shards: int


def removed(ids: list, texts: list, right: dict, plan: Plan) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, which are removed) of each row of a block; ``right``: what is known of its anchors (shard null) and its shards' reports."""
    anchors_of = [(p, v) for p, v, s in zip(right["part"], right["values"], right["shard"], strict=True) if s is None]
    reports = [(s, r, x) for s, r, x in zip(right["shard"], right["runs"], right["least"], strict=True) if s is not None]
    words = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    change = np.zeros(int(sizes.sum()) + 1, np.int32)
    runs = cut(ids, texts, ([p for p, _ in anchors_of], [v for _, v in anchors_of]), plan.parts, plan.shards) if reports else None
    for shard, told, least in reports:
        places, which, found = runs.by_shard[shard]
        told, least = np.frombuffer(told, np.int32), np.frombuffer(zlib.decompress(least), np.int64)
        row = np.full(len(found), -1, np.int64)
        row[told] = np.arange(len(told))
        on = row[which] >= 0
        places, row = places[on], row[which[on]]
        n = np.zeros(len(told), np.int64)
        n[row] = runs.windows[places]  # places of a run have equal numbers of windows
        offset = np.cumsum(n) - n
        many = runs.windows[places]
        inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        earlier = least[np.repeat(offset[row], many) + inside] < np.repeat(runs.doc[places], many)
        at = (np.repeat(runs.begin[places], many) + inside)[earlier]
        np.add.at(change, at, 1)
        np.add.at(change, at + WINDOW, -1)
    gone = np.cumsum(change[:-1]) > 0
    at = 0
    for w in words:
        yield w, gone[at : at + len(w)]
        at += len(w)


def reported(blocked: DataFrame, blocks: int, hot: int = HOT, group: int = GROUP) -> tuple[DataFrame, Plan]:
    """What each block needs to remove its words (see :func:`removed`)."""
    known, parts = count_anchors(blocked, blocks, hot, group)
    plan = Plan(parts, max(1, blocks // BLOCKS_PER_SHARD))
    found = report(sent(blocked, known, parts, plan.shards))
    none = F.lit(None).cast("binary")
    left = known.select("block", "part", "values", F.lit(None).cast("int").alias("shard"), none.alias("runs"), none.alias("least"))
    return left.unionByName(found.select("block", F.lit(None).cast("int").alias("part"), none.alias("values"), "shard", "runs", "least")), plan


def kept_words(words: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)


def remove_repeats(docs: DataFrame, hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row of ``docs`` (doc_id, text) with the words kept, joined by one space.

    A word goes if a window over it starts in a document with a smaller id as well; windows are judged on the input. Null texts
    have no words; rows with a null id come after all others; repeated rows (same id) don't count as earlier ones. Long texts are
    handled whole. Other columns are not read; an empty table gives no rows.
    """
    blocked, blocks = with_block(docs.select("doc_id", "text"))
    found, plan = reported(blocked, blocks, hot, group)

    def keep(left: dict, right: dict) -> Iterator[tuple]:
        for i, (words, gone) in zip(left["doc_id"], removed(left["doc_id"], left["text"], right, plan), strict=True):
            yield i, len(words), int(gone.sum()), kept_words(words, gone).decode()

    return per_pair(blocked, found, "block", "doc_id long, n_words long, n_removed long, kept string", keep)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words that :func:`remove_repeats` takes out of ``text`` gone, and ``n_chars``, if there, recounted where it
    lost some. A text that loses nothing stays as it is, white space and nulls included; all rows and columns stay."""
    names = docs.columns
    plain = docs.toDF(*("doc_id" if n == "doc_id" else "text" if n == "text" else f"c{k}" for k, n in enumerate(names)))
    inner = plain.columns
    blocked, blocks = with_block(plain, *(c for c in inner if c not in ("doc_id", "text")))
    found, plan = reported(blocked.select("doc_id", "text", "block"), blocks)
    schema = T.StructType([T.StructField(n, docs.schema[n].dataType, True) for n in names])
    chars = names.index("n_chars") if "n_chars" in names else None

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        if not left.num_rows:
            return arrow.empty_table()
        ids, texts = left["doc_id"].to_pylist(), left["text"].to_pylist()
        columns = {c: left[c] for c in inner}
        out, sizes = list(texts), columns[inner[chars]].to_pylist() if chars is not None else None
        for k, (words, gone) in enumerate(removed(ids, texts, right.to_pydict(), plan)):
            if gone.any():
                out[k] = kept_words(words, gone).decode()
                if sizes is not None:
                    sizes[k] = len(out[k])
        columns["text"] = out
        if sizes is not None:
            columns[inner[chars]] = sizes
        cast = [pa.chunked_array([pa.array(c, f.type)]) if isinstance(c, list) else c.cast(f.type) for c, f in zip((columns[c] for c in inner), arrow, strict=True)]
        return pa.Table.from_arrays(cast, schema=arrow)

    return importable(blocked).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(rewrite, schema)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of :func:`remove_repeats` for every document: numbers of words and of words removed, and the hash of those kept."""
    blocked, blocks = with_block(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found, plan = reported(blocked, blocks)

    def digest(left: dict, right: dict) -> Iterator[tuple]:
        for i, (words, gone) in zip(left["doc_id"], removed(left["doc_id"], left["text"], right, plan), strict=True):
            yield i, len(words), int(gone.sum()), hashlib.sha256(kept_words(words, gone)).hexdigest()

    return per_pair(blocked, found, "block", "doc_id long, n_words long, n_removed long, kept_sha256 string", digest)
