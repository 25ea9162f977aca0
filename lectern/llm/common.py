"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.shared import materialize

__all__ = ["connected_components", "dealt_in_tiles", "importable", "map_rows", "map_stream", "materialize", "split_batch", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(df: DataFrame) -> DataFrame:
    """Let Python workers find this package where it isn't installed (on a cluster, ship it with --py-files), and give freed arrays
    back to the system instead of keeping them for the next stage."""
    env, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    env.setdefault("MALLOC_MMAP_THRESHOLD_", "4194304")
    env.setdefault("MALLOC_TRIM_THRESHOLD_", "8388608")
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    return df


def map_rows(df: DataFrame, schema: str | T.StructType, make: Callable[[], Callable[[list[list]], Iterable[tuple]]]) -> DataFrame:
    """Map each Arrow batch of ``df`` to rows.

    ``make`` runs once per task and returns a function from the batch's columns (lists) to row tuples.
    """
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        per_batch = make()
        for batch in batches:
            for part in split_batch(batch):
                rows = list(per_batch([c.to_pylist() for c in part.columns]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return importable(df).mapInArrow(run, out)


def split_batch(batch: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, so that long texts don't add up in a worker."""
    if not batch.num_rows:
        return
    step = max(1, batch.num_rows * most // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id for each id of undirected ``edges`` (u long, v long): (id, component).

    Alternates large-star and small-star steps (each a grouped minimum and an equi-join) until the sum of labels and the
    number of edges stay the same, which takes some log(ids) ** 2 rounds at most; every step is written to the shared folder in
    place of the one before. Edges never reach the driver.
    Ids without an edge are absent; empty edges give an empty result.
    """
    e = materialize(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
        e = materialize(small.where("u <> v").distinct(), e)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()).groupBy("id").agg(F.min("component").alias("component"))


def map_stream(df: DataFrame, schema: str | T.StructType, run_rows: Callable[[Iterator[list[list]]], Iterator[tuple]], rows_per_batch: int = 4096) -> DataFrame:
    """As :func:`map_rows`, but ``run_rows`` gets a whole task's batches as an iterator and may carry state from one to the next."""
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import batched

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        parts = ([c.to_pylist() for c in part.columns] for batch in batches for part in split_batch(batch))
        for rows in batched(run_rows(parts), rows_per_batch):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return importable(df).mapInArrow(run, out)


def dealt_in_tiles(listed: DataFrame, keys: list[str], salt: str, tile: int) -> DataFrame:
    """``listed`` without lists (rows of equal ``keys``) of one row, and with columns s, a, b: a list over ``tile`` rows is dealt by
    ``salt`` into tiles, and each row goes to all pairs (a, b) of tiles that its own tile s is in, so that every two rows meet.

    Rows are hashed by list and pair and sorted so within partitions. Rows of a list that fits come once, with s = a = b = 0.
    """
    sizes = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(*keys, F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    own = listed.join(sizes, keys).withColumn("s", F.pmod(F.xxhash64(salt), F.col("tiles")).cast("int"))
    pairs = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(*listed.columns, "s", F.least("s", "o").alias("a"), F.greatest("s", "o").alias("b"))
    n = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, *keys, "a", "b").sortWithinPartitions(*keys, "a", "b")
