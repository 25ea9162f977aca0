"""Even assignment of questions to trees, and node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.enums import node_id, question_type
from lectern.shared import materialize


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in ``order`` within each group, without a group ever being one task's.

    Rows are range-partitioned and sorted by group and order, given their place and written once, so that the counts per partition
    and group are those of the very partitions that are numbered. A group of any size spreads over as many partitions as it fills.
    Rows that tie in ``order`` are numbered in any order.
    """
    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    rows = materialize(placed)
    part = F.shiftright("_at", 33)  # the partition's number; the place in it is in the lower bits
    runs = rows.groupBy(part.alias("_p"), F.col(group).alias("_g")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = runs.select("_p", "_g", (F.sum("_n").over(W.partitionBy("_g").orderBy("_p")) - F.col("_n") - F.col("_first")).alias("_shift"))
    joined = rows.join(before, (part == before["_p"]) & rows[group].eqNullSafe(before["_g"]))
    return joined.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def round_robin(questions: DataFrame, trees: DataFrame, order: list[str]) -> DataFrame:
    """``questions`` (level_id) with a tree_id: the i-th of a level goes to tree i modulo the level's number of trees (by id).

    A level without trees drops its questions.
    """
    ranked = trees.select("level_id", F.col("id").alias("tree_id"), (F.row_number().over(W.partitionBy("level_id").orderBy("id")) - 1).alias("tree_rank"), F.count(F.lit(1)).over(W.partitionBy("level_id")).alias("trees"))
    counts = ranked.select("level_id", "trees").distinct()
    placed = numbered(questions, "level_id", order, "_i").join(counts, "level_id")
    placed = placed.withColumn("tree_rank", F.pmod("_i", "trees"))
    return placed.join(ranked.drop("trees"), ["level_id", "tree_rank"]).drop("_i", "trees")


def node_map(nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """(tree_id, node_type, mapped_id): the node of each tree and upper-case type; of several the one with the highest id."""
    joined = nodes.join(trees.select(F.col("id").alias("tree_id")), nodes["skill_tree_id"] == F.col("tree_id"))
    return joined.groupBy("tree_id", F.upper("node_type").alias("node_type")).agg(F.max(nodes["id"]).alias("mapped_id"))


def with_node(questions: DataFrame, mapping: DataFrame) -> DataFrame:
    """``questions`` (tree_id, question_type) with a node_id: the mapped one, else by formula."""
    kind = question_type(F.col("question_type"), trimmed=True)
    joined = questions.withColumn("_kind", kind).join(mapping.withColumnRenamed("node_type", "_kind"), ["tree_id", "_kind"], "left")
    return joined.withColumn("node_id", F.coalesce(F.nullif("mapped_id", F.lit(0)), node_id(F.col("tree_id"), F.col("_kind")))).drop("_kind", "mapped_id")
