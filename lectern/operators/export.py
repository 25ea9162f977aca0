"""Exam sheets as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.text import append_distinct, real_newlines
from lectern.operators.sample import draw_key, type_place

LETTERS = ("A", "B", "C", "D")


def shuffled_options(options: Column, answer: Column, id_: Column, seed: str, most: int = 4) -> Column:
    """Up to four distinct options in seeded order, the answer always among them."""
    every = append_distinct(options, answer)
    others = F.array_sort(F.transform(F.filter(every, lambda x: x != answer), lambda x: F.struct(draw_key(F.concat(id_.cast("string"), x), seed).alias("k"), x.alias("v"))))
    kept = F.concat(F.transform(F.slice(others, 1, most - 1), lambda x: x["v"]), F.array(answer))
    keyed = F.transform(kept, lambda x: F.struct(draw_key(F.concat(id_.cast("string"), x, F.lit("!")), seed).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda x: x["v"])


def answer_letter(options: Column, answer: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in LETTERS)), F.array_position(options, answer).cast("int"))


def question_text(seed: str) -> Column:
    """One question's block, by its type; in a review node matching pairs are shown as questions."""
    kind, q = F.col("question_type"), F.col("number").cast("string")
    head = F.concat(F.lit("Q"), q, F.lit(": "))
    answer = F.coalesce("correct_answer", F.lit(""))
    opts = shuffled_options(F.col("options"), answer, F.col("id"), seed)
    lines = F.array_join(F.transform(opts, lambda x, i: F.concat(F.get(F.array(*(F.lit(v) for v in LETTERS)), i), F.lit(". "), x)), "\n")
    vocab = F.concat(head, "question_text", F.lit("\n"), lines, F.lit("\nAnswer: "), answer_letter(opts, answer), F.lit("\n\n"))
    plain = lambda t: F.concat(head, t, F.lit("\nAnswer: "), answer, F.lit("\n\n"))
    pair = F.concat(q, F.lit(". "), F.col("question_text"), F.lit(" -> "), answer, F.lit("\n"))
    speaking = F.concat(head, F.lit("[Speaking] "), F.coalesce(F.nullif("question_text", F.lit("")), F.lit("Describe the image")), F.lit("\n"), answer, F.lit("\n\n"))
    return (
        F.when(kind == "VOCAB", vocab)
        .when(kind == "LISTENING", plain(real_newlines(F.col("question_text"))))
        .when((kind == "MATCHING") & (F.col("node_type") == "REVIEW"), plain(F.col("question_text")))
        .when(kind == "MATCHING", pair)
        .when(kind == "SPEAKING", speaking)
        .otherwise("")
    )


def numbered(drawn: DataFrame) -> DataFrame:
    """Drawn rows with their number in the node: in drawing order, in a review node by type before that."""
    place = F.when(F.col("node_type") == "REVIEW", type_place(F.col("question_type"))).otherwise(0)
    return drawn.withColumn("number", F.row_number().over(W.partitionBy("node_id").orderBy(place, "rn")))


def sheets(drawn: DataFrame, trees: DataFrame, seed: str) -> DataFrame:
    """(level_id, tree_number, tree_id, content): a sheet for each tree; the number counts over all levels.

    ``drawn``: enriched rows with node order_index; a node without a question (:func:`lectern.operators.sample.with_empty_nodes`)
    shows its heading. ``trees``: a few rows; each has a sheet, if only of its heading.
    """
    blocks = numbered(drawn).withColumn("block", F.when(F.col("id").isNotNull(), question_text(seed)).otherwise(""))
    sorted_text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["text"]), "")
    node = blocks.groupBy("tree_id", "node_id", "node_type", "order_index").agg(sorted_text(F.struct("number", F.col("block").alias("text"))).alias("body"))
    shown = F.concat(F.lit("NODE "), F.col("node_type"), F.lit("\n\n"), F.col("body"), F.lit("\n\n"))
    tree = node.groupBy("tree_id").agg(sorted_text(F.struct((F.col("node_type") == "REVIEW").alias("last"), "order_index", "node_id", shown.alias("text"))).alias("body"))
    number = F.row_number().over(W.orderBy("level_id", "order_index", "id"))
    head = F.concat(F.lit("TREE "), F.col("tree_id").cast("string"), F.lit("\n" + "=" * 36 + "\n\n"))
    ranked = trees.select("level_id", number.alias("tree_number"), F.col("id").alias("tree_id"))
    return ranked.join(tree, "tree_id", "left").select("level_id", "tree_number", "tree_id", F.concat(head, F.coalesce("body", F.lit(""))).alias("content"))


def write_sheets(sheet: DataFrame, folder: str) -> None:
    """A file level_L/tree_K.txt for each sheet. There are a few dozen; they pass through the driver one partition at a time."""
    spark = sheet.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in sheet.select("level_id", "tree_number", "content").toLocalIterator():
        out = files.create(path(f"{folder}/level_{r['level_id']}/tree_{r['tree_number']}.txt"), True)
        out.write(r["content"].encode())
        out.close()
