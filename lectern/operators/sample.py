"""Reproducible quota sampling without replacement, by seeded hash ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.shared import materialize

#: Questions per node, and per type, in this order, in the review node.
SINGLE = ("LISTENING", "SPEAKING")
MOST = 10
REVIEW_QUOTA = {"VOCAB": 4, "MATCHING": 4, "LISTENING": 1, "SPEAKING": 1}


def draw_key(id_: str | Column, seed: str | Column) -> Column:
    """A uniform order for each seed."""
    text = F.col(id_) if isinstance(id_, str) else id_
    return F.md5(F.concat(text.cast("string"), F.lit("#"), F.lit(seed) if isinstance(seed, str) else seed.cast("string")))


def quota(kind: Column) -> Column:
    return F.when(kind.isin(*SINGLE), 1).otherwise(MOST)


def per_node(q: DataFrame, nodes: DataFrame, seed: str) -> DataFrame:
    """(tree_id, node_id, node_type, id, question_type, level_id, rn): up to a node's quota of the questions of its level."""
    own = nodes.where("node_type <> 'REVIEW'").select(F.col("id").alias("node_id"), F.col("skill_tree_id").alias("tree_id"), "node_type", "level_id", "order_index")
    ranked = q.join(own, ["node_id", "level_id"]).withColumn("rn", F.row_number().over(W.partitionBy("node_id").orderBy(draw_key("id", seed), "id")))
    # the plain bound lets each task cut its nodes' questions before the shuffle
    return ranked.where(F.col("rn") <= MOST).where(F.col("rn") <= quota(F.col("node_type"))).select("tree_id", "node_id", "node_type", "id", "question_type", "level_id", "rn")


def review_nodes(nodes: DataFrame) -> DataFrame:
    """(tree_id, level_id, node_id): the review node of each tree; of several the first in order."""
    return nodes.where("node_type = 'REVIEW'").groupBy(F.col("skill_tree_id").alias("tree_id"), "level_id").agg(F.min_by("id", F.struct("order_index", "id")).alias("node_id"))


def review(q: DataFrame, nodes: DataFrame, drawn: DataFrame, most: int, seed: str) -> DataFrame:
    """Questions for each tree's review node: of its level, not drawn for the tree, of types whose own node got some.

    ``most``: how many questions a tree draws at most. A tree and type needs quota + ``most`` candidates at most, so a level's
    questions are cut to that many per type, in each task before the shuffle, and only then meet the trees: rows grow with trees,
    not with trees times questions.
    """
    gate = drawn.select("tree_id", F.col("node_type").alias("question_type")).distinct()
    wants = review_nodes(nodes).join(gate, "tree_id").where(F.col("question_type").isin(*REVIEW_QUOTA))
    size = F.lit(0)
    for kind, n in REVIEW_QUOTA.items():
        size = F.when(F.col("question_type") == kind, n).otherwise(size)
    w = W.partitionBy("level_id", "question_type").orderBy(draw_key("id", seed), "id")
    pool = q.select("id", "level_id", "question_type").withColumn("place", F.row_number().over(w)).where(F.col("place") <= max(REVIEW_QUOTA.values()) + most)
    open_ = pool.join(wants, ["level_id", "question_type"]).join(drawn.select("tree_id", "id"), ["tree_id", "id"], "left_anti")
    ranked = open_.withColumn("rn", F.row_number().over(W.partitionBy("tree_id", "question_type").orderBy("place")))
    return ranked.where(F.col("rn") <= size).select("tree_id", "node_id", F.lit("REVIEW").alias("node_type"), "id", "question_type", "level_id", "rn")


def on_trees(nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """``nodes`` with their tree's level."""
    return nodes.join(trees.select(F.col("id").alias("skill_tree_id"), "level_id"), "skill_tree_id")


def exam(q: DataFrame, nodes: DataFrame, trees: DataFrame, seed: str) -> DataFrame:
    """All drawn rows of all trees. What the nodes draw, a quota each, is written once: the review draw reads it three times."""
    placed = on_trees(nodes, trees)
    drawn = materialize(per_node(q, placed, seed))
    most = drawn.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    return drawn.unionByName(review(q, placed, drawn, most, seed))


def with_empty_nodes(drawn: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """``drawn`` (tree_id, node_id, node_type) with order_index, and a row, null but for the node, for each node that drew nothing.

    Of a tree's review nodes only the first in order is part of an exam.
    """
    placed = on_trees(nodes, trees)
    shown = placed.join(review_nodes(placed).select(F.col("node_id").alias("id"), F.lit(True).alias("first")), "id", "left").where("node_type <> 'REVIEW' or first")
    shown = shown.select(F.col("skill_tree_id").alias("tree_id"), F.col("id").alias("node_id"), "node_type", "order_index")
    return shown.join(drawn.drop("order_index"), ["tree_id", "node_id", "node_type"], "left")


def enrich(drawn: DataFrame, facts: DataFrame, documents: DataFrame) -> DataFrame:
    """Drawn rows with text, options, answer and media, defaults where the document is missing."""
    rows = drawn.join(facts.select("id", "mongo_question_id", "correct_answer"), "id", "left")
    docs = documents.select(F.col("_id").alias("mongo_question_id"), "question_text", "distractors", "metadata")
    joined = rows.join(docs, "mongo_question_id", "left")
    meta = lambda k: F.coalesce(F.try_element_at("metadata", F.lit(k)), F.lit(""))
    return joined.select(*drawn.columns, "correct_answer", F.coalesce("question_text", F.lit("")).alias("question_text"), F.coalesce("distractors", F.array().cast("array<string>")).alias("options"), meta("audio_url").alias("audio_url"), meta("phonetic").alias("phonetic"))


def duplicate_rate(drawn: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return drawn.agg(F.when(n > 0, 1 - F.count_distinct("id") / n).otherwise(F.lit(0.0)).alias("duplicate_rate"))


def type_place(kind: Column) -> Column:
    """The place of a type in a review node."""
    return F.array_position(F.array(*(F.lit(k) for k in REVIEW_QUOTA)), kind)


def nested(drawn: DataFrame, fields: list[str]) -> DataFrame:
    """(tree_id, nodes array<struct<node_id, node_type, questions>>), nodes by id, questions in drawing order, in a review node by
    type before that. A node has its quota at most; one without a question (:func:`with_empty_nodes`) has an empty array.
    """
    place = F.when(F.col("node_type") == "REVIEW", type_place(F.col("question_type"))).otherwise(0)
    one = F.when(F.col("id").isNotNull(), F.struct(place.alias("place"), "rn", "question_type", *(f for f in fields if f not in ("question_type", "rn"))))
    by_node = drawn.groupBy("tree_id", "node_id", "node_type").agg(F.array_sort(F.collect_list(one)).alias("questions"))
    return by_node.groupBy("tree_id").agg(F.array_sort(F.collect_list(F.struct("node_id", "node_type", "questions"))).alias("nodes"))


def flattened(exams: DataFrame) -> DataFrame:
    one = exams.select("tree_id", F.explode("nodes").alias("n"))
    return one.select("tree_id", "n.node_id", "n.node_type", F.explode("n.questions").alias("q")).select("tree_id", "node_id", "node_type", "q.*").drop("place")
