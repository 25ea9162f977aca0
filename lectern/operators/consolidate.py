"""One schema for the accepted rows of all extractors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["sentence", "options", "answer", "difficulty", "question_type", "audio_url"]
#: File name part -> question type and the source column of each target column; constants in quotes. Tried in this order.
LAYOUTS = {
    "vocab": ("VOCAB", {"sentence": "sentence", "options": "distractors", "answer": "answer", "audio_url": "''"}),
    "listening": ("LISTENING", {"sentence": "gapped_text", "options": "''", "answer": "answer", "audio_url": "audio"}),
    "speaking": ("SPEAKING", {"sentence": "sentences", "options": "''", "answer": "''", "audio_url": "audio"}),
    "matching": ("MATCHING", {"sentence": "sentence_left", "options": "'MATCHING_PAIR'", "answer": "sentence_right", "audio_url": "''"}),
}


def layout_of(file_name: str) -> str | None:
    return next((k for k in LAYOUTS if k in file_name.lower()), None)


def to_schema(df: DataFrame, layout: str) -> DataFrame:
    """``df`` in the common schema; a missing column or a null becomes empty text."""
    kind, sources = LAYOUTS[layout]
    value = lambda s: F.lit(s.strip("'")) if s.startswith("'") else (F.coalesce(F.col(s), F.lit("")) if s in df.columns else F.lit(""))
    out = {**{c: value(s) for c, s in sources.items()}, "difficulty": value("difficulty"), "question_type": F.lit(kind)}
    return df.select(*(out[c].alias(c) for c in COLUMNS))


def consolidate(spark: SparkSession, named: list[tuple[str, DataFrame]]) -> DataFrame:
    """All rows of (file name, rows); files of no known kind are passed over."""
    parts = [to_schema(df, kind) for name, df in named if (kind := layout_of(name))]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
    return reduce(DataFrame.unionByName, parts)
