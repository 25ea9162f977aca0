"""Count reports and balance statistics over questions, skill nodes and skill trees.

questions(id, node_id, level_id, question_type) · nodes(id, skill_tree_id, title, node_type, order_index) · trees(id, level_id, order_index)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import percent, rounded

EXCLUDED = ("REVIEW",)
LOWER, UPPER = 100, 1000


def total() -> Column:
    return F.count(F.lit(1)).alias("total")


def count_total(q: DataFrame) -> DataFrame:
    return q.agg(total())


def count_by(q: DataFrame, *keys: str) -> DataFrame:
    return q.groupBy(*keys).agg(total()).orderBy(*keys)


def on_nodes(q: DataFrame, nodes: DataFrame) -> DataFrame:
    return q.join(nodes.select(F.col("id").alias("node_id"), "skill_tree_id", "title", "node_type", "order_index"), "node_id")


def count_by_node_type(q: DataFrame, nodes: DataFrame) -> DataFrame:
    return on_nodes(q, nodes).groupBy("node_type").agg(total()).orderBy(F.desc("total"), "node_type")


def count_node_type_by_level(q: DataFrame, nodes: DataFrame) -> DataFrame:
    return on_nodes(q, nodes).groupBy("level_id", "node_type").agg(total()).orderBy("level_id", "node_type")


def nodes_with_level(nodes: DataFrame, trees: DataFrame) -> DataFrame:
    return nodes.join(trees.select(F.col("id").alias("skill_tree_id"), "level_id"), "skill_tree_id")


def questions_per_node(q: DataFrame) -> DataFrame:
    """Counted before any join, so that the join moves a row per node and not one per question."""
    return q.groupBy("node_id").agg(total())


def skill_by_level(q: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """Questions per tree level and skill; nodes without a question count 0."""
    joined = nodes_with_level(nodes, trees).join(questions_per_node(q).withColumnRenamed("node_id", "id"), "id", "left")
    return joined.groupBy("level_id", F.col("node_type").alias("skill")).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total")).orderBy("level_id", "skill")


def node_by_level_with_skill(q: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    joined = nodes_with_level(nodes, trees).join(questions_per_node(q).withColumnRenamed("node_id", "id"), "id", "left")
    rows = joined.select("level_id", F.col("id").alias("node_id"), "title", F.col("node_type").alias("skill"), "order_index", F.coalesce("total", F.lit(0)).alias("total"))
    return rows.orderBy("level_id", "order_index", "node_id")


def skill_question_type(q: DataFrame, nodes: DataFrame) -> DataFrame:
    return on_nodes(q, nodes).groupBy(F.col("node_type").alias("skill"), "question_type").agg(total()).orderBy("skill", "question_type")


def top_nodes(q: DataFrame, limit: int = 20) -> DataFrame:
    return questions_per_node(q).orderBy(F.desc("total"), "node_id").limit(limit)


def count_tree_by_level(q: DataFrame, nodes: DataFrame) -> DataFrame:
    return on_nodes(q, nodes).groupBy("level_id", F.col("skill_tree_id").alias("tree_id")).agg(total()).orderBy("level_id", F.desc("total"), "tree_id")


def count_skill_in_tree(q: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    joined = on_nodes(q, nodes).join(trees.select(F.col("id").alias("skill_tree_id")), "skill_tree_id")
    keys = ["level_id", F.col("skill_tree_id").alias("tree_id"), "node_id", "title", "node_type"]
    return joined.groupBy(*keys).agg(F.min("order_index").alias("order_index"), total()).orderBy("level_id", "tree_id", "order_index", "node_id")


def level_share(q: DataFrame) -> DataFrame:
    """Questions per level and their percentage of all."""
    by, whole = count_by(q, "level_id"), q.agg(F.count(F.lit(1)).alias("base"))
    return by.crossJoin(F.broadcast(whole)).select("level_id", "total", percent(F.col("total"), F.col("base")).alias("percent"))  # one row on the right


def skill_pivot(counts: DataFrame, skills: list[str]) -> DataFrame:
    """Levels in rows, one column per skill, 0 where there is none."""
    return counts.groupBy("level_id").pivot("skill", skills).agg(F.sum("total")).fillna(0)


def without_excluded(df: DataFrame) -> DataFrame:
    return df.where(~F.col("skill").isin(*EXCLUDED))


def skill_ratio(q: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """Percentage of each skill among a level's questions: numerator by the tree's level, denominator by the question's."""
    levels = q.groupBy("level_id").agg(F.count(F.lit(1)).alias("base"))
    counted = without_excluded(skill_by_level(q, nodes, trees))
    skills = counted.select("skill").distinct()
    grid = levels.crossJoin(F.broadcast(skills))  # levels x skills, a handful of each
    joined = grid.join(counted, ["level_id", "skill"], "left")
    return joined.select("level_id", "skill", percent(F.coalesce("total", F.lit(0)), F.col("base")).alias("percent"))


def spread(x: str) -> dict[str, Column]:
    mean, std = F.avg(x), F.stddev_pop(x)
    return {
        "min": F.min(x), "median": rounded(F.median(x), 2), "max": F.max(x), "std": rounded(std, 2), "mean": rounded(mean, 2),
        "balance_score": rounded(F.when(mean > 0, std / mean).otherwise(F.lit(0.0)), 4),
    }


def balance_by_skill(per_node: DataFrame) -> DataFrame:
    """Spread of questions per node within each skill."""
    return without_excluded(per_node).groupBy("skill").agg(*(c.alias(n) for n, c in spread("total").items())).orderBy("skill")


def balance_by_level(per_node: DataFrame, levels: DataFrame) -> DataFrame:
    """Balance score of each level that has questions; 0 where it has no nodes."""
    scored = without_excluded(per_node).groupBy("level_id").agg(spread("total")["balance_score"].alias("score"))
    return levels.join(scored, "level_id", "left").select("level_id", F.coalesce("score", F.lit(0.0)).alias("balance_score")).orderBy("level_id")


def node_coverage(per_node: DataFrame, levels: DataFrame, lower: int = LOWER, upper: int = UPPER) -> DataFrame:
    """Nodes of each level, and the percentages above and below the bounds (both strict)."""
    n = F.count(F.lit(1))
    rows = without_excluded(per_node).groupBy("level_id").agg(
        n.alias("total_nodes"),
        percent(F.count_if(F.col("total") > lower), n).alias("above_lower_bound_percent"),
        percent(F.count_if(F.col("total") < upper), n).alias("below_upper_bound_percent"),
    )
    return levels.join(rows, "level_id", "left").fillna(0).orderBy("level_id")


def charts(q: DataFrame, nodes: DataFrame, trees: DataFrame) -> dict[str, DataFrame]:
    """The data of each chart, by its name; labels as shown."""
    levels, per_node = q.select("level_id").distinct(), node_by_level_with_skill(q, nodes, trees)
    label = F.format_string("Level %d (%s%%)", "level_id", F.col("percent").cast("string"))
    out = {
        "question-by-level": level_share(q).select(label.alias("label"), "total"),
        "skill-ratio-by-level": skill_ratio(q, nodes, trees),
        "node-balance-by-skill": balance_by_skill(per_node),
        "node-distribution": without_excluded(per_node).select("level_id", F.format_string("Node %d - %s", "node_id", "skill").alias("label"), "total", "order_index"),
        "node-coverage-by-level": node_coverage(per_node, levels),
        "skill-x-question-type": without_excluded(skill_question_type(q, nodes)).select(F.concat_ws(" - ", "skill", "question_type").alias("label"), "total"),
        "balance-score-by-level": balance_by_level(per_node, levels),
    }
    return out
