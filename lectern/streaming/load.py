"""Continuous load: each micro-batch appends only what the store lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.load import load_new


def load_stream(questions: DataFrame, documents_path: str, facts_path: str, checkpoint: str, order: list[str]) -> StreamingQuery:
    """Run :func:`load_new` on the available files of a streaming ``questions`` and stop.

    Facts are appended before documents; a batch that is tried again finds what it wrote and appends the rest.
    """

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        docs, facts = load_new(batch, spark.read.parquet(documents_path), spark.read.parquet(facts_path), order)
        facts.write.mode("append").parquet(facts_path)
        docs.write.mode("append").parquet(documents_path)

    return questions.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
