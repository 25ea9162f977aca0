"""Load of what is new: insert-if-absent into documents and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.enums import question_type
from lectern.functions.text import explanation, split_options


def question_doc_id(text: str) -> F.Column:
    return F.sha2(F.col(text), 256)


def first_per_sentence(questions: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each sentence, whatever its type or level; combined before the shuffle."""
    return questions.groupBy(F.col("sentence").alias("_s")).agg(F.min_by(F.struct(*questions.columns), F.struct(*order)).alias("_x")).select("_x.*")


def new_documents(questions: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents (_id, question_text, distractors, explanation, metadata) of sentences that ``existing`` (question_text) lacks."""
    fresh = questions.join(existing.select(F.col("question_text").alias("sentence")), "sentence", "left_anti")
    kind = F.coalesce("question_type", F.lit("VOCAB"))
    return fresh.select(
        question_doc_id("sentence").alias("_id"),
        F.col("sentence").alias("question_text"),
        split_options(F.col("options")).alias("distractors"),
        explanation(kind, F.col("difficulty")).alias("explanation"),
        F.create_map(F.lit("audio_url"), F.coalesce("audio_url", F.lit(""))).alias("metadata"),
    )


def new_facts(questions: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows (mongo_question_id, node_id, level_id, question_type, correct_answer) for documents without one in ``facts``."""
    rows = questions.withColumn("mongo_question_id", question_doc_id("sentence"))
    rows = rows.join(facts.select("mongo_question_id"), "mongo_question_id", "left_anti")
    return rows.select("mongo_question_id", "node_id", "level_id", question_type(F.col("question_type")).alias("question_type"), F.col("answer").alias("correct_answer"))


def load_new(questions: DataFrame, documents: DataFrame, facts: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(documents, facts) to append; loading the same questions again appends nothing."""
    first = first_per_sentence(questions, order)
    return new_documents(first, documents), new_facts(first, facts)
