"""Difficulty levels, question types and node ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import trim_unicode

#: Fixed values.
DIFFICULTIES = ("easy", "medium", "hard")
COURSE_MARKS = (("easy", ("basic", "level1")), ("medium", ("developing", "level2")), ("hard", ("expanding", "level3")))
EXAM_MARKS = (("easy", ("b1", "level1")), ("medium", ("b2", "level2")), ("hard", ("c1", "c2", "level3")))
NODE_TYPES = ("VOCAB", "LISTENING", "SPEAKING", "MATCHING", "REVIEW")


def difficulty_of(name: Column, marks=COURSE_MARKS, default: str | None = None) -> Column:
    """The first difficulty one of whose marks is in the lower-cased name."""
    low, out = F.lower(name), None
    for level, words in marks:
        on = F.lit(False)
        for w in words:
            on = on | low.contains(w)
        out = F.when(on, level) if out is None else out.when(on, level)
    return out.otherwise(F.lit(default))


def normalize_difficulty(c: Column) -> Column:
    low = trim_unicode(F.lower(c))
    return F.when(low.isin(*DIFFICULTIES), low).otherwise(F.lit("medium"))


def question_type(c: Column, trimmed: bool = False) -> Column:
    kind = F.upper(F.coalesce(F.nullif(c, F.lit("")), F.lit("VOCAB")))
    return trim_unicode(kind) if trimmed else kind


def level_of(difficulty: Column) -> Column:
    return F.when(difficulty == "easy", 1).when(difficulty == "medium", 2).when(difficulty == "hard", 3)


def node_id(tree: Column, kind: Column) -> Column:
    """(tree - 1) * 5 + the type's place; unknown types count as the first."""
    place = F.lit(1)
    for i, name in enumerate(NODE_TYPES[1:], 2):
        place = F.when(kind == name, i).otherwise(place)
    return (tree - 1) * len(NODE_TYPES) + place
