"""Blocks of documents and a tally of 64-bit keys over all blocks.

A block is a few MB of whole texts that one task handles at a time. Counting then runs on a block's distinct keys, packed as binary
columns, in place of one row per key: far fewer rows are shuffled, and hot keys come once per block at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import importable, materialize

BLOCK_BYTES = 2 << 20
#: Blocks whose keys are merged before they meet those of others, and parts that a block's keys are dealt in then.
GROUP, RANGES = 1024, 64


def with_block(docs: DataFrame, *more: str) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text and ``more``) with a ``block`` column, and the number of blocks. Rows go to blocks by id and text, so
    that only rows which repeat both meet in one block for sure."""
    n_bytes, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil((n_bytes + 64 * rows) / BLOCK_BYTES))
    return docs.select("doc_id", "text", *more, F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")), blocks


def record(schema: T.StructType, rows: list[tuple]) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)


def per_group(df: DataFrame, keys: list[str], schema: str, rows_of: Callable[[dict[str, list]], Iterator[tuple]]) -> DataFrame:
    """Rows that ``rows_of`` makes of each group's columns (lists by name)."""
    out = T.StructType.fromDDL(schema)

    def run(group: pa.Table) -> pa.Table:
        return record(out, list(rows_of(group.to_pydict())))

    return importable(df).groupBy(*keys).applyInArrow(run, out)


def per_pair(left: DataFrame, right: DataFrame, keys: str | list[str], schema: str, rows_of: Callable[[dict, dict], Iterator[tuple]]) -> DataFrame:
    """As :func:`per_group`, for the groups of two frames that have the same keys."""
    out = T.StructType.fromDDL(schema)
    by = [keys] if isinstance(keys, str) else keys

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return record(out, list(rows_of(a.to_pydict(), b.to_pydict())))

    return importable(left).groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, out)


def dealt(keys: np.ndarray, values: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, keys, values) of sorted uint64 ``keys``, by key modulo ``parts``; keys stay sorted."""
    if not len(keys):
        return
    where = (keys % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)  # short numbers sort by radix
    order = np.argsort(where, kind="stable")
    where, keys, values = where[order], keys[order], values[order]
    cuts = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(where)]
    for s, e in zip(cuts, cuts[1:], strict=False):
        yield int(where[s]), keys[s:e].tobytes(), values[s:e].tobytes()


def summed(keys: list[bytes], values: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their sums, and the place of each of all keys among them."""
    distinct, place = np.unique(joined(keys), return_inverse=True)
    return distinct, np.bincount(place, weights=joined(values, kind), minlength=len(distinct)).astype(np.int64), place


def split(values: np.ndarray, keys: list[bytes]) -> Iterator[bytes]:
    """``values``, one for each key, as they belong to the blobs of ``keys``."""
    at = 0
    for blob in keys:
        yield values[at : at + len(blob) // 8].tobytes()
        at += len(blob) // 8


Ask = Callable[[dict], tuple[np.ndarray, np.ndarray]]
Reply = Callable[[np.ndarray, np.ndarray], np.ndarray]


def tally(blocked: DataFrame, blocks: int, per_bucket: int, ask: Ask, reply: Reply, summary: Reply | None = None, group: int = GROUP) -> tuple[DataFrame, int]:
    """(block, part, values) and the number of parts: for each block, and each part (key modulo parts) of its keys, what ``reply`` says
    of them, in the order of the keys. Written to the shared folder.

    ``ask`` gives a block's distinct keys, sorted, with a number each (int32); numbers are summed over all blocks. ``reply`` gets a
    bucket's keys and sums. Its ``summary``, if asked for, comes as the values of block -1. A bucket has the keys of about
    ``per_bucket`` blocks.

    Up to ``group`` blocks, blocks send their keys straight to the buckets. Of more, the keys of every ``group`` blocks are merged
    first, in ranges, so that rows grow with groups times buckets and not with blocks times buckets; replies go back the same way.
    The route doesn't change what is replied.
    """
    buckets = max(1, math.ceil(blocks / per_bucket))
    small = blocks <= group
    parts = buckets if small else RANGES
    buckets = buckets if small else RANGES * math.ceil(buckets / RANGES)

    def out(rows: dict) -> Iterator[tuple]:
        keys, values = ask(rows)
        for part, k, v in dealt(keys, values.astype(np.int32), parts):
            yield rows["block"][0], rows["block"][0] // group, part, k, v

    asked = per_group(blocked, ["block"], "block int, grp int, part int, keys binary, values binary", out)
    if small:

        def answer(rows: dict) -> Iterator[tuple]:
            distinct, sums, place = summed(rows["keys"], rows["values"], np.int32)
            for block, values in zip(rows["block"], split(reply(distinct, sums)[place], rows["keys"]), strict=True):
                yield block, rows["part"][0], values
            if summary:
                yield -1, rows["part"][0], summary(distinct, sums).tobytes()

        return materialize(per_group(asked, ["part"], "block int, part int, values binary", answer)), parts

    asked = materialize(asked)

    def merge(rows: dict) -> Iterator[tuple]:
        distinct, sums, _ = summed(rows["keys"], rows["values"], np.int32)
        for bucket, k, v in dealt(distinct, sums, buckets):
            yield rows["grp"][0], rows["part"][0], bucket, k, v

    def settle(rows: dict) -> Iterator[tuple]:
        distinct, sums, place = summed(rows["keys"], rows["values"], np.int64)
        for g, values in zip(rows["grp"], split(reply(distinct, sums)[place], rows["keys"]), strict=True):
            yield g, rows["part"][0], rows["bucket"][0], values
        if summary:
            yield -1, rows["part"][0], rows["bucket"][0], summary(distinct, sums).tobytes()

    def back(left: dict, right: dict) -> Iterator[tuple]:
        if not left["keys"]:  # summaries
            for values in right["values"]:
                yield -1, right["part"][0], values
            return
        distinct, place = np.unique(joined(left["keys"]), return_inverse=True)
        where = distinct % np.uint64(buckets)
        kind = reply(np.zeros(0, np.uint64), np.zeros(0, np.int64)).dtype
        values = np.zeros(len(distinct), kind)
        for bucket, own in zip(right["bucket"], right["values"], strict=True):
            values[where == np.uint64(bucket)] = np.frombuffer(own, kind)
        for block, own in zip(left["block"], split(values[place], left["keys"]), strict=True):
            yield block, left["part"][0], own

    merged = per_group(asked, ["grp", "part"], "grp int, part int, bucket int, keys binary, values binary", merge)
    settled = per_group(merged, ["bucket"], "grp int, part int, bucket int, values binary", settle)
    replies = per_pair(asked.select("block", "grp", "part", "keys"), settled, ["grp", "part"], "block int, part int, values binary", back)
    return materialize(replies, asked), parts


def replied(keys: np.ndarray, parts: int, told: list[int], values: list[bytes], kind: type) -> np.ndarray:
    """What :func:`tally` replied for a block's ``keys``: ``told`` are the parts of the ``values``."""
    where, out = keys % np.uint64(parts), np.zeros(len(keys), kind)
    for part, own in zip(told, values, strict=True):
        out[where == np.uint64(part)] = np.frombuffer(own, kind)
    return out


def joined(blobs: list[bytes], kind=np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)
