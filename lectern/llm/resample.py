"""Quality classifier by importance resampling.

Two bags of hashed 1- and 2-grams are fitted: one to target text (labelled rows of good quality that aren't toxic), one to all
raw text. A document's log weight is the log ratio of its probabilities under both. Gumbel noise and a top-k draw then sample k
documents without replacement in proportion to their weights; k is the number of documents above the weight that separates
held-out labelled rows best.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import map_rows, map_stream, materialize, table

#: Hash buckets of a model: 2 ** 18 counts, 1 MB as floats when broadcast.
BUCKETS = 1 << 18
#: At most so many labelled rows, lowest hash of the id first, fit the target and the threshold.
LABELLED = 20_000
#: Added to both counts, on the target's scale.
SMOOTHING = 20.0
SEED = 17
#: Words of a generation.
CACHE = 100_000
TOKEN = re.compile(r"\w+|[^\w\s]+")

class Words:
    """Hashes of the tokens of words. A task keeps two generations of words that it met lately."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def miss(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            if word.isalnum():  # all word characters but the underscore
                found = zlib.crc32(word.encode()).to_bytes(4, "little")
            else:
                found = np.array([zlib.crc32(t.encode()) for t in TOKEN.findall(word)], "<u4").tobytes()
        if len(word) < 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        """Buckets of a text's tokens (runs of word characters or of others) and of neighbouring pairs, repeats included."""
        if not text:
            return np.zeros(0, np.int64)
        words = text.split()
        found = list(map(self.young.get, words))
        if None in found:
            found = [self.miss(w) if f is None else f for w, f in zip(words, found, strict=True)]
        t = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
        pairs = (t[:-1] * 0x9E3779B1 + t[1:] * 0x85EBCA77) >> 7
        return np.concatenate([t, pairs]) & (BUCKETS - 1)


def labelled(labels: DataFrame, most: int = LABELLED) -> tuple[dict[int, bool], dict[int, bool]]:
    """Bounded (fit, held out): doc_id -> good, which is of good quality and not toxic. Rows with a null are left out; a repeated id
    counts once, with the worst of its labels."""
    rows = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    picked = rows.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(most).collect()
    fit: dict[int, bool] = {}
    held: dict[int, bool] = {}
    for r in picked:
        good = r["quality"] > 0 and not r["toxic"]
        if zlib.crc32(str(r["doc_id"]).encode()) % 4:
            if good:
                fit[r["doc_id"]] = True
        else:
            held[r["doc_id"]] = good
    return fit, held


def fit_ratio(docs: DataFrame, fit: dict[int, bool], smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of each bucket: target over raw. Counts are summed per task, then by bucket; ``BUCKETS`` rows reach the driver."""
    chosen = docs.sparkSession.sparkContext.broadcast(frozenset(fit))

    def run(batches: Iterator[list[list]]) -> Iterator[tuple]:
        raw, target, words = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), Words()
        for ids, texts in batches:
            found = [words.features(t) for t in texts]
            raw += np.bincount(np.concatenate(found), minlength=BUCKETS)
            good = [f for i, f in zip(ids, found, strict=True) if i in chosen.value]
            if good:
                target += np.bincount(np.concatenate(good), minlength=BUCKETS)
        on = np.flatnonzero(raw)
        yield from zip(on.tolist(), raw[on].tolist(), target[on].tolist(), strict=True)

    counted = map_stream(docs.select("doc_id", "text"), "bucket int, raw long, target long", run, 65_536)
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    scale = target.sum() / max(1.0, raw.sum())
    return np.log((target + smoothing) / (raw * scale + smoothing)).astype(np.float32)


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, log_weight); a null or empty text weighs 0."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        r, words = shared.value, Words()

        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                yield i, float(r[words.features(text)].sum(dtype=np.float64))

        return rows

    return map_rows(docs.select("doc_id", "text"), "doc_id long, log_weight double", make)


def threshold(scores: list[tuple[float, bool]]) -> float:
    """The weight that separates good from bad rows best (mean of both shares told right); minus infinity without both kinds."""
    good = np.sort([s for s, g in scores if g])
    bad = np.sort([s for s, g in scores if not g])
    if not len(good) or not len(bad):
        return float("-inf")
    cuts = np.unique(np.concatenate([good, bad]))
    told = (len(good) - np.searchsorted(good, cuts)) / len(good) + np.searchsorted(bad, cuts) / len(bad)
    best = int(told.argmax())
    below = cuts[best - 1] if best else cuts[best] - 1
    return float((cuts[best] + below) / 2)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise, a function of the key and the seed."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest long, by counting in ever narrower bins: at most 4,096 counts reach the driver at a time."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return None
    while low < high:
        width = (high - low) // 4096 + 1
        inside = values.where(F.col(column).between(low, high))
        counts = {r["b"]: r["n"] for r in inside.groupBy(F.expr(f"({column} - {low}L) div {width}L").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for b in sorted(counts, reverse=True):
            if counts[b] >= k:
                low, high = low + b * width, min(high, low + b * width + width - 1)
                break
            k -= counts[b]
        else:
            return low
    return low


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """(doc_id, log_weight, kept) for every row of ``docs`` (doc_id, text); other columns are not read.

    ``k``: how many to keep; by default, as many as weigh more than :func:`threshold`. Rows that tie at the k-th key, such as
    repeated rows, are all kept. Without labels of both kinds, all are. Null and empty texts weigh 0, long ones are read whole. Rows
    with a null id share one noise value. An empty table gives no rows.
    """
    fit, held = labelled(labels)
    scored = materialize(log_weights(docs, fit_ratio(docs, fit)))
    known = {}
    if held:  # LABELLED ids at most, each once
        few = docs.sparkSession.createDataFrame([(i,) for i in held], "doc_id long")
        known = {r["doc_id"]: r["log_weight"] for r in scored.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("log_weight").alias("log_weight")).collect()}
    if k is None:
        bar = threshold([(known[i], g) for i, g in held.items() if i in known])
        k = scored.where(F.col("log_weight") >= F.lit(bar)).count()
    # keys as fixed-point longs, so that the k-th is found exactly
    keyed = scored.withColumn("key", F.floor((F.col("log_weight") + gumbel(F.col("doc_id"))) * F.lit(float(1 << 20))).cast("long"))
    bar_key = kth_largest(keyed, "key", k)
    return keyed.select("doc_id", "log_weight", (F.col("key") >= F.lit(bar_key)).alias("kept") if bar_key is not None else F.lit(False).alias("kept"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their log weights."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("kept").select("doc_id", "log_weight")
