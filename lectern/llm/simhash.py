"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has 8 positional bytes. Two that differ in at most 3 bits differ in at most 3 bytes, so they share at least
``SHARED`` = 5; of those at least 3 lie in one half of the positions. The index therefore lists fingerprints under every 3
positional bytes of each half (8 lists each). Within a list, the shared positional bytes of a pair are tallied, pairs below 5
are dropped, and the rest are verified bit by bit. Copies are folded first: the index holds each fingerprint once. Lists over
``TILE`` are dealt to several tasks as pairs of tiles. What leaves a list is a forest over its linked members, not its pairs.

:func:`similar_documents` does the same for word shingles and a Jaccard similarity. There 64 bits tell too little (at 0.8 some 10 of
them differ), so the positional bytes are 64 and come from min-hashes: lists under 16 groups of four positions, a tally of shared
bytes per pair with the minimum that similar pairs reach, and whole shingle sets to verify. A pair at 0.8 is in none of the lists
with a probability of 0.0002, and below the minimum with one of 0.000001.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import connected_components, dealt_in_tiles, map_rows, map_stream, materialize, table
from lectern.llm.itq import grouped
from lectern.llm.signatures import digest, shingle_sets, signature
from lectern.llm.signatures import links_within as similar_within

WORDS, SEED, MOST_BITS = 3, 42, 3
SHARED = 8 - MOST_BITS
TILE = 1024
#: Three byte positions of one half.
POSITIONS = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bits set in over half of the shingles' XXH64 values, repeats included; 0 without words."""
    import xxhash

    w = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        part = np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``; the long has the fingerprint's bits."""

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                f = fingerprint(text)
                yield i, f - (1 << 64) if f >> 63 else f

        return rows

    return map_rows(docs.select("doc_id", "text"), "doc_id long, fp long", make)


def links_within(fp: np.ndarray, rep: np.ndarray) -> Iterator[tuple[int, int]]:
    """A forest (rep, rep of its root) over the members that verified pairs connect."""
    left = np.arange(len(fp))
    octets = fp.view(np.uint8).reshape(-1, 8)
    while len(left) > 1:
        root, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            tally = (octets[left] == octets[i]).sum(axis=1)
            near = tally >= SHARED
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[i]) <= MOST_BITS
            found = left[near]
            if len(found):
                left = left[~near]
                front += found.tolist()
                for j in found.tolist():
                    yield int(rep[j]), int(rep[root])


def link(batches: Iterator[list[list]]) -> Iterator[tuple]:
    """Edges from rows (list, a, b, fp, rep) sorted by the first three."""
    held: list[np.ndarray] | None = None

    def flush(cols: list[np.ndarray]) -> Iterator[tuple]:
        key = np.stack(cols[:3])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), key.shape[1]]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if e - s > 1:
                fp, first = np.unique(cols[3][s:e], return_index=True)
                yield from links_within(fp.view(np.uint64), cols[4][s:e][first])

    for batch in batches:
        now = [np.array(c, np.int64) for c in batch]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        last = np.flatnonzero((np.stack([c != c[-1] for c in now[:3]])).any(axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from flush([c[:cut] for c in now])
        held = [c[cut:] for c in now]
    if held is not None and len(held[0]):
        yield from flush(held)


def edges(unique: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (u, v) between the representatives of distinct fingerprints (fp, rep): a forest per index list."""
    byte = [F.shiftrightunsigned("fp", 8 * k).bitwiseAND(255) for k in range(8)]
    key = lambda n, at: F.lit(n << 24) + sum((byte[p] * (1 << 8 * i) for i, p in enumerate(at)), F.lit(0).cast("long"))
    listed = unique.select("fp", "rep", F.explode(F.array(*(key(n, at) for n, at in enumerate(POSITIONS)))).alias("list"))
    dealt = dealt_in_tiles(listed, ["list"], "fp", tile).select("list", "a", "b", "fp", "rep")
    return map_stream(dealt, "u long, v long", link)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text); other columns are not read.

    component_id is the smallest doc_id that links reach, the row's own included. Null, empty and blank texts have fingerprint 0
    and link like any other. Repeated rows give repeated rows. Rows with a null id get their component all the same, null
    where nothing else is linked. An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs))
    unique = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    nodes = unique.where("rep is not null")
    parts = connected_components(edges(nodes))
    named = unique.join(parts, unique.rep == parts.id, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def similar_documents(docs: DataFrame, words: int = 5, least: float = 0.8, tile: int = 4096) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` (doc_id, text); other columns are not read.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity of ``least`` or more are linked; component_id is the
    smallest doc_id that links reach, the row's own included. Words are split and lowered as bytes (ASCII). Null, empty and blank
    texts equal each other. Repeated rows give repeated rows. Rows with a null id get their component all the same, null where
    nothing else is linked. An empty table gives no rows.
    """

    def printed():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, own in zip(cols[0], shingle_sets(cols[1], words), strict=True):
                yield i, digest(own), *signature(own)

        return rows

    def whole():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for own in shingle_sets(cols[0], words):
                yield digest(own), own.tobytes()

        return rows

    def link(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for _, group in grouped(batches, 3):
            if len(group) > 1:
                reps, signs, blobs = zip(*group, strict=True)
                yield from similar_within(list(reps), list(signs), [np.frombuffer(b, np.uint64) for b in blobs], least)

    prints = materialize(map_rows(docs.select("doc_id", "text"), "doc_id long, digest binary, sign binary, lists array<long>", printed))
    unique = materialize(prints.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("sign").alias("sign"), F.first("lists").alias("lists")))
    listed = unique.where("rep is not null").select("digest", "rep", "sign", F.explode("lists").alias("list"))
    # of lists with the same members one is enough
    sums = listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("sum"))
    lists = sums.where("n > 1").groupBy("n", "low", "high", "sum").agg(F.min("list").alias("list")).select("list")
    shared = materialize(listed.join(lists, "list"))
    # a rep's id may belong to rows of other texts too, so sets are found again by their digest
    again = docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    sets = map_rows(again, "digest binary, shingles binary", whole).dropDuplicates(["digest"])
    members = shared.join(sets, "digest").select("list", "rep", "sign", "shingles")
    dealt = dealt_in_tiles(members, ["list"], "rep", tile).select("list", "a", "b", "rep", "sign", "shingles")
    parts = connected_components(map_stream(dealt, "u long, v long", link))
    named = unique.join(parts, unique.rep == parts.id, "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    return prints.select("doc_id", "digest").join(named, "digest").select("doc_id", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`near_duplicates` of all documents, fingerprints in hexadecimal."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
