"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import materialize, table
from lectern.llm.packing import pack
from lectern.llm.resample import resample
from lectern.llm.secrets import redact_documents
from lectern.llm.simhash import similar_documents
from lectern.llm.substrings import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample takes; rows with a null id, which no draw tells apart, stay.

    Null and empty texts weigh nothing and are drawn as such; rows of one id share a draw, and stay if any of their texts is taken;
    rows at the last weight that is taken all stay. An empty table gives an empty one.
    """
    kept = resample(docs, table(spark, sf_dir, "labels")).where("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, Jaccard similarity of 0.8 or more), the one with the smallest
    id; of repeated rows all stay, and so do rows with a null id.

    Null, empty and blank texts are near-duplicates of each other. Long texts are compared whole. An empty table gives an empty one.
    """
    kept = similar_documents(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has too; a text that loses nothing stays as it is.

    Every row stays and keeps its own result: null ids come after all others, rows of one id don't take from each other, repeated rows
    end alike, null and empty texts stay. An empty table gives an empty one.
    """
    return without_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark; every row stays, null and empty texts, null ids and repeated rows as they are.

    An empty table gives an empty one.
    """
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids.

    Every row is packed on its own, whatever its id; a null or empty text is its closing token. Long texts take several sequences.
    An empty table gives no pieces.
    """
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("secret scan", secret_scan),
    ("packing", packing),
]

#: Fitted models, fingerprints and tokenisation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), docs)
    return STAGES[-1][1](spark, docs, sf_dir)
