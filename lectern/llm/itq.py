"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking with the original vectors.

A rotation of the principal components is learnt so that signs make balanced binary codes. The code is cut into substrings; each
is the key of one table. Tables hold codes only. Two vectors of a list whose whole codes differ in no more bits than pairs of the
least similarity do are candidates; members without one leave, and only the rest fetch their vectors and are compared by cosine in
double precision. The substrings grow with the logarithm of the largest label, and there are as many tables as pairs of the least
similarity need at the angles that centring leaves between them, so lists stay short at any size. Equal vectors are folded first;
lists over ``TILE`` are dealt to several tasks; a list yields counts and a forest, not its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import connected_components, dealt_in_tiles, map_rows, map_stream, materialize, table

LEAST = 0.93
#: The rotations are fitted on at most so many distinct vectors, lowest hash of the id first.
SAMPLE = 8192
ROUNDS = 30
#: Vectors of a label per list, were codes even; and the share of pairs at LEAST that may share no table.
PER_LIST, MISSED = 64, 0.03
#: The share of pairs at LEAST whose codes may differ in more bits than candidates do.
BEYOND = 0.005
TILE = 512
#: Members of a list that are compared with all others at a time.
STRIP = 512
#: A sample of fewer vectors has no mean to speak of: it isn't centred.
FEW = 32
SEED = 11


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, h, dim, vec): h is null for rows that link with nothing; else equal vectors have equal h."""
    kind = "f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "f8"

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, x, label in zip(*cols, strict=True):
                if i is None or label is None or not x or None in x:
                    yield i, label, None, None, None
                    continue
                v = np.array(x, kind) + 0  # no negative zero
                if not np.isfinite(v).all() or not v.any():
                    yield i, label, None, None, None
                else:
                    raw = v.tobytes()
                    yield i, label, hashlib.blake2b(raw, digest_size=16).digest(), len(v), raw

        return rows

    source = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    return map_rows(source, "vec_id long, label long, h binary, dim int, vec binary", make)


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    kind = "f4" if len(raw[0]) == 4 * dim else "f8"
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), dim).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn(x: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dim, bits) of the sample ``x``: rotations of its principal components, several if bits exceed the dimension."""
    dim = x.shape[1]
    mean = x.mean(axis=0) if len(x) >= FEW else np.zeros(dim)
    _, vectors = np.linalg.eigh(np.cov(x - mean, rowvar=False).reshape(dim, dim) + 1e-9 * np.eye(dim))
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        k = min(dim, bits - sum(p.shape[1] for p in parts))
        axes = vectors[:, ::-1][:, :k]
        low = (x - mean) @ axes
        r, _ = np.linalg.qr(rng.standard_normal((k, k)))
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(low @ r >= 0, 1.0, -1.0).T @ low)
            r = (u @ w).T
        parts.append(axes @ r)
    return mean, np.concatenate(parts, axis=1)


def partners(x: np.ndarray, least: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the sample ``x`` and others at cosine ``least`` to them: moved towards other vectors, away from them, and in
    random directions."""
    other = np.concatenate([x[rng.permutation(len(x))], rng.standard_normal(x.shape)])
    twice = np.concatenate([x, x])
    side = other - (other * twice).sum(axis=1, keepdims=True) * twice
    norm = np.linalg.norm(side, axis=1)
    twice, side = twice[norm > 1e-6], side[norm > 1e-6] / norm[norm > 1e-6, None]
    return np.concatenate([twice, twice]), np.concatenate([least * twice + sign * math.sqrt(1 - least**2) * side for sign in (1, -1)])


def centred_angles(x: np.ndarray, mean: np.ndarray, least: float, rng: np.random.Generator) -> np.ndarray:
    """Angles around ``mean`` between vectors of the sample ``x`` and partners at cosine ``least``."""
    a, b = (v - mean for v in partners(x, least, rng))
    size = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    return np.arccos(np.clip((a * b).sum(axis=1) / np.maximum(size, 1e-300), -1, 1)) if len(a) else np.array([math.acos(least)])


def most_bits(x: np.ndarray, mean: np.ndarray, projection: np.ndarray, least: float, rng: np.random.Generator) -> int:
    """In how many bits codes of partners at cosine ``least`` differ, but for a share of ``BEYOND``."""
    a, b = partners(x, least, rng)
    if not len(a):
        return projection.shape[1]
    apart = (((a - mean) @ projection >= 0) != ((b - mean) @ projection >= 0)).sum(axis=1)
    return int(np.quantile(apart, 1 - BEYOND, method="higher"))


def shape(largest: int, least: float = LEAST, angles: np.ndarray | None = None) -> tuple[int, int]:
    """(bits of a substring, tables) for the largest label's number of vectors and the angles of pairs at ``least``."""
    bits = min(24, max(8, math.ceil(math.log2(max(1, largest) / PER_LIST))))
    same = (1 - (np.array([math.acos(least)]) if angles is None else angles) / math.pi) ** bits
    low, high = 0, 1
    while ((1 - same) ** high).mean() > MISSED:
        low, high = high, 2 * high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if ((1 - same) ** mid).mean() > MISSED else (low, mid)
    return bits, high


def substrings(x: np.ndarray, mean: np.ndarray, projection: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, tables) keys of unit vectors, and their whole codes (n, bytes)."""
    code = (x - mean) @ projection >= 0
    return (code.reshape(len(x), tables, bits) * (1 << np.arange(bits))).sum(axis=2).astype(np.int32), np.packbits(code, axis=1)


def words_of(code: list[bytes]) -> np.ndarray:
    """Whole codes as (n, words) of 64 bits."""
    size = len(code[0])
    return np.frombuffer(b"".join(c + bytes(-size % 8) for c in code), np.uint64).reshape(len(code), -1)


def close(code: np.ndarray, a: int, most: int) -> np.ndarray:
    """Which members differ from ``code[a : a + STRIP]`` in ``most`` bits or fewer."""
    apart = np.zeros((len(code[a : a + STRIP]), len(code)), np.int32)
    for k in range(code.shape[1]):
        apart += np.bitwise_count(code[a : a + STRIP, k][:, None] ^ code[:, k])
    return apart <= most


def with_candidate(code: np.ndarray, s: np.ndarray, cross: bool, most: int) -> np.ndarray:
    """Which members of a list have another within ``most`` bits, in another tile if ``cross``."""
    out = np.zeros(len(code), bool)
    for a in range(0, len(code), STRIP):
        near = close(code, a, most)
        near[np.arange(len(near)), np.arange(a, a + len(near))] = False
        if cross:
            near &= s[a : a + STRIP][:, None] != s
        out |= near.any(axis=0)
        out[a : a + STRIP] |= near.any(axis=1)
    return out


def compare(code: np.ndarray, sub: np.ndarray, tab: int, x: np.ndarray, n: np.ndarray, s: np.ndarray, cross: bool, least: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked others of each member, copies counted, and the least member reached, over candidate pairs that no earlier table shares."""
    g = len(x)
    links, root = np.zeros(g, np.int64), np.arange(g)
    left, right = [], []
    for a in range(0, g, STRIP):
        i, j = np.nonzero(close(code, a, most) & (x[a : a + STRIP] @ x.T >= least))
        i += a
        on = i < j
        if cross:
            on &= s[i] != s[j]
        i, j = i[on], j[on]
        if tab and len(i):
            fresh = np.ones(len(i), bool)
            for k in range(tab):
                fresh &= sub[i, k] != sub[j, k]
            i, j = i[fresh], j[fresh]
        left.append(i)
        right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    np.add.at(links, i, n[j])
    np.add.at(links, j, n[i])
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return links, root


def found_links(reps: DataFrame, least: float = LEAST) -> DataFrame:
    """(rep, add, root) of the distinct vectors ``reps`` (label, dim, h, rep, n, vec): rows to be summed and joined up by rep."""
    spark = reps.sparkSession
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    sample = reps.orderBy(F.xxhash64("rep", F.lit(SEED)), "rep").select("dim", "vec").limit(SAMPLE).collect()
    dims = {}
    for r in sample:
        dims.setdefault(r["dim"], []).append(bytes(r["vec"]))
    rng = np.random.default_rng(SEED)
    samples = {d: unit(v, d) for d, v in sorted(dims.items()) if len(v) > 1}
    shapes = [shape(largest, least), *(shape(largest, least, centred_angles(x, x.mean(axis=0), least, rng)) for x in samples.values() if len(x) >= FEW)]
    bits, tables = max(shapes)
    models = {}
    for d, x in samples.items():
        mean, projection = learn(x, bits * tables, rng)
        # few vectors tell nothing about the rest: all pairs of a list are candidates
        models[d] = mean, projection, most_bits(x, mean, projection, least, rng) if len(x) >= FEW else bits * tables
    shared = spark.sparkContext.broadcast(models)

    def model(d: int) -> tuple[np.ndarray, np.ndarray, int]:
        if d in shared.value:
            return shared.value[d]
        return np.zeros(d), np.random.default_rng(d).standard_normal((d, bits * tables)), bits * tables  # a length that the sample lacks

    def coded(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for label, dim, rep, h, vec in batches:
            d = np.array(dim)
            for one in np.unique(d).tolist():
                at = np.flatnonzero(d == one).tolist()
                mean, projection, _ = model(one)
                keys, codes = substrings(unit([vec[i] for i in at], one), mean, projection, bits, tables)
                for i, own, code in zip(at, keys, codes, strict=True):
                    raw = code.tobytes()
                    for t, key in enumerate(own.tolist()):
                        yield label[i], one, t, key, rep[i], h[i], raw

    def screen(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for key, group in grouped(batches, 6):
            if len(group) > 1:
                s, rep, h, code = zip(*group, strict=True)
                on = np.flatnonzero(with_candidate(words_of(list(code)), np.array(s), key[4] != key[5], model(key[1])[2]))
                for i in on.tolist():
                    yield *key, s[i], rep[i], h[i], code[i]

    def verify(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for key, group in grouped(batches, 6):
            if len(group) > 1:
                s, rep, code, n, vec = (list(c) for c in zip(*group, strict=True))
                flat = np.unpackbits(np.frombuffer(b"".join(code), np.uint8).reshape(len(code), -1), axis=1, count=bits * tables)
                sub = (flat.reshape(len(code), tables, bits) * (1 << np.arange(bits))).sum(axis=2)
                links, root = compare(words_of(code), sub, key[2], unit(vec, key[1]), np.array(n), np.array(s), key[4] != key[5], least, model(key[1])[2])
                for i in np.flatnonzero(links > 0).tolist():
                    yield rep[i], int(links[i]), rep[int(root[i])]

    keys = ["label", "dim", "tab", "sub", "a", "b"]
    typed = "label long, dim int, tab int, sub int"
    rows = map_stream(reps.select("label", "dim", "rep", "h", "vec"), f"{typed}, rep long, h binary, code binary", coded)
    pairs = dealt_in_tiles(rows, keys[:4], "h", TILE).select(*keys, "s", "rep", "h", "code")
    kept = materialize(map_stream(pairs, f"{typed}, a int, b int, s int, rep long, h binary, code binary", screen))
    whole = kept.join(reps.select("label", "h", "n", "vec"), ["label", "h"])  # an id may have several vectors
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = whole.repartition(n, *keys).sortWithinPartitions(*keys).select(*keys, "s", "rep", "code", "n", "vec")
    return map_stream(met, "rep long, add long, root long", verify)


def grouped(batches: Iterator[list[list]], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of rows that follow each other with equal first ``keys`` columns, over batch borders."""
    key, rows = None, []
    for cols in batches:
        for row in zip(*cols, strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def near_vectors(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label); other columns are not read.

    Null, zero and non-finite vectors and those with a null component, label or id link with nothing; they are kept, but for a null
    id, which is no id to be kept under. Repeated rows count as vectors of their own. An empty table gives no rows.
    """
    every = materialize(clean(vectors))
    reps = materialize(every.where("h is not null").groupBy("label", "dim", "h").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")))
    found = materialize(found_links(reps, least))
    added = found.groupBy("rep").agg(F.sum("add").alias("add"))
    parts = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    named = reps.select("label", "h", "rep", "n").join(added, "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select(F.col("label").alias("l"), "h", (F.col("n") - 1 + F.coalesce("add", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    joined = every.select("vec_id", "label", "h").join(named, (F.col("label") == F.col("l")) & (every.h == named.h), "left")
    out = joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`near_vectors` of the whole table."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
