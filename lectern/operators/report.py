"""Sampling benchmark: time and duplicate rate over repeated draws."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import rounded

#: Fixed value of the report's AvgIteration column: 5 nodes of 10 questions.
ITERATIONS = 50
HEADER = "Weight constraint (level),Number of runs,Success,AvgTime(ms),AvgIteration,AvgDuplicate(%),StdDev"


def measure(spark: SparkSession, sample: Callable[[int, str], DataFrame], levels: list[int], runs: int) -> DataFrame:
    """(level, runs, ok, ms, duplicate) per call of ``sample(level, seed)``, whose frame has the one column duplicate_rate."""
    rows = []
    for level in levels:
        for i in range(runs):
            start = time.perf_counter()
            try:
                rate = sample(level, f"run{i}").first()[0]
                rows.append((level, runs, True, 1000 * (time.perf_counter() - start), float(rate)))
            except Exception:  # a failed call counts as one without success
                rows.append((level, runs, False, None, None))
    return spark.createDataFrame(rows, "level int, runs int, ok boolean, ms double, duplicate double")


def summarize(measured: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return measured.groupBy("runs", "level").agg(
        F.count_if("ok").alias("success"),
        rounded(zero(F.avg("ms")), 2).alias("avg_time"),
        F.lit(ITERATIONS).alias("avg_iteration"),
        rounded(zero(F.avg("duplicate")) * 100, 2).alias("avg_duplicate"),
        rounded(zero(F.stddev_pop("ms")), 4).alias("std_dev"),
    ).orderBy("runs", "level")


def lines(summary: DataFrame) -> DataFrame:
    return summary.select(F.format_string("%d,%d,%d,%.2f,%d,%.2f,%.4f", "level", "runs", "success", "avg_time", "avg_iteration", "avg_duplicate", "std_dev").alias("line"), F.struct("runs", "level").alias("seq"))
