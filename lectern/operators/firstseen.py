"""First-seen classification: duplicates and key conflicts, without sequential state.

A key's first row is found by a grouped minimum, which combines on the map side, and joined back; a key with a third of all rows
costs one row per task in the first step and is split as a skewed join in the second. ``seq`` must tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import sorted_pair


def with_first(df: DataFrame, key: list[str | Column], seq: str, fields: dict[str, str | Column], flag: str) -> DataFrame:
    """``df`` with the fields of each key's first row in ``seq`` order, and whether a row is that first one."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.withColumns({n: column(k) for n, k in zip(names, key, strict=True)})
    first = keyed.groupBy(*names).agg(F.min(F.struct(F.col(seq).alias("_at"), *(column(c).alias(n) for n, c in fields.items()))).alias("_f"))
    first = first.select(*(F.col(n).alias(f"{n}f") for n in names), F.col("_f._at").alias("_at"), *(F.col(f"_f.{n}").alias(n) for n in fields))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}f"))
    return keyed.join(first, same).withColumn(flag, F.col(seq) == F.col("_at")).drop("_at", *names, *(f"{n}f" for n in names))


def dedupe(df: DataFrame, key: list[str | Column], seq: str, origin: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(first rows, later rows with ``origin`` fields of the first)."""
    seen = with_first(df, key, seq, origin, "_first")
    return seen.where("_first").drop("_first", *origin), seen.where("not _first").drop("_first")


def conflicts(df: DataFrame, key: str, content: str, seq: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose content equals their key's first row's, the others with ``fields`` of the first)."""
    seen = with_first(df, [key], seq, {"_content": content, **fields}, "_first")
    same = F.col("_content") == F.col(content)
    return seen.where(same).drop("_content", "_first", *fields), seen.where(~same).drop("_content", "_first")


def once_per_pair(df: DataFrame, a: str, b: str, seq: str, more: list[str] | None = None) -> DataFrame:
    """The first row of each unordered pair of tags (and further columns)."""
    names = df.columns
    pair = sorted_pair(F.col(a), F.col(b)).alias("_pair")
    first = df.groupBy(pair, *(F.col(c).alias(f"_{c}") for c in more or [])).agg(F.min_by(F.struct(*names), F.col(seq)).alias("_x"))
    return first.select("_x.*")


def both_ways(df: DataFrame, forward: dict[str, Column], backward: dict[str, Column]) -> DataFrame:
    """Two rows for each: one as ``forward``, one as ``backward`` (equal field names)."""
    rows = [F.struct(*(c.cast("string").alias(n) for n, c in side.items())) for side in (forward, backward)]
    return df.select(F.posexplode(F.array(*rows)).alias("side", "x"), "*").select("side", "x.*", *(["seq"] if "seq" in df.columns else []))
