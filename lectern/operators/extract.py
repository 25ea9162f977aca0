"""The four extractors: items -> accepted rows, rejected rows with the first failing rule, duplicates.

Inputs are :func:`lectern.sources.files.json_items` rows. Order follows ``seq`` everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import enums, text, urls
from lectern.operators.firstseen import both_ways, conflicts, dedupe, once_per_pair
from lectern.sources.files import source_tag


@dataclass(frozen=True)
class Extracted:
    main: DataFrame
    review: DataFrame
    duplicates: DataFrame


def first_reason(*rules: tuple[Column, str | Column]) -> Column:
    """The reason of the first rule that holds, null if none does."""
    out = None
    for holds, reason in rules:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        out = F.when(holds, reason) if out is None else out.when(holds, reason)
    return out


def field(name: str) -> Column:
    return F.coalesce(F.get_json_object("item", f"$.{name}"), F.lit(""))


def missing_sources(items: DataFrame, modes: list[str], reason: str, columns: list[str]) -> DataFrame:
    """A reject row for each source folder that isn't there."""
    rows = [(m, reason) for m in modes]
    df = items.sparkSession.createDataFrame(rows, "mode string, reason string")
    fixed = {"source_file": F.lit(""), "mode": F.col("mode"), "reason": F.col("reason"), "difficulty": F.lit("medium")}
    return df.select(*(fixed.get(c, F.lit("")).alias(c) for c in columns))


LISTENING_REVIEW = ["source_file", "mode", "reason", "gapped_text", "full_text", "answer", "audio", "difficulty"]
LISTENING_CONFLICT = [f"conflict_with_{c}" for c in ("source_file", "mode", "gapped_text", "full_text", "answer", "audio", "difficulty")]
LISTENING_DUPLICATES = ["source_file", "mode", "reason", "gapped_text", "answer", "audio", "difficulty", "conflict_with_source_file", "conflict_with_mode"]


def listening(items: DataFrame, missing: list[str] | None = None) -> Extracted:
    is_object = F.coalesce(F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY"), F.lit(False))
    blanks = F.transform(text.json_strings(field("blanks")), lambda x: F.coalesce(F.get_json_object(x, "$.answer"), F.lit("")))
    rows = items.withColumns({
        "source_file": source_tag(F.col("file"), F.col("pos")),
        "difficulty": enums.difficulty_of(F.col("file")),
        "raw": F.when(is_object, text.normalize_text(field("gapped_text"))).otherwise(""),
        "answers": F.when(is_object, text.nonempty(blanks)).otherwise(F.array().cast("array<string>")),
        "audio": F.when(is_object, text.normalize_lines(field("audio"))).otherwise(""),
    }).withColumns({"answer": text.enumerate_join(F.col("answers")), "gaps": text.count_gaps(F.col("raw"))})
    n_answers = F.size("answers")
    reason = first_reason(
        (F.col("difficulty").isNull(), "UNMAPPED_DIFFICULTY"),
        (F.col("error").isNotNull(), F.col("error")),
        (~is_object, "ITEM_NOT_OBJECT"),
        (F.col("raw") == "", "MISSING_GAPPED_TEXT"),
        (F.col("audio") == "", "MISSING_AUDIO"),
        (urls.media_reason(F.col("audio")).isNotNull(), urls.media_reason(F.col("audio"))),
        (n_answers == 0, "MISSING_ANSWERS"),
        (F.col("gaps") != n_answers, F.format_string("ANSWER_COUNT_MISMATCH(gaps:%d,answers:%d)", "gaps", n_answers)),
    )
    judged = rows.withColumn("reason", reason)
    whole_file = F.col("reason") == "UNMAPPED_DIFFICULTY"
    rejects = judged.where("reason is not null").withColumn("source_file", F.when(whole_file, F.col("file")).otherwise(F.col("source_file")))
    rejects = rejects.where(~whole_file | F.coalesce(F.col("pos"), F.lit(1)).eqNullSafe(1))  # such a file is reported once
    own = {"gapped_text": F.col("raw"), "full_text": F.lit(""), "difficulty": F.coalesce("difficulty", F.lit("medium"))}
    bare = rejects.select(*(own.get(c, F.col(c)).alias(c) for c in LISTENING_REVIEW), *(F.lit("").alias(c) for c in LISTENING_CONFLICT), "seq", F.lit(0).alias("side"))
    valid = judged.where("reason is null").withColumns({"numbered": text.number_gaps(F.col("raw")), "full": text.fill_gaps(F.col("raw"), F.col("answers"))})
    valid = valid.withColumn("norm", text.normalize_lines(F.col("full")))
    same, clash = conflicts(valid, "audio", "norm", "seq", {"f_file": "source_file", "f_mode": "mode", "f_full": "norm", "f_difficulty": "difficulty"})
    clash = once_per_pair(clash, "f_file", "source_file", "seq", ["audio"])
    why, none = F.lit("AUDIO_DUPLICATED_WITH_DIFFERENT_FULL_TEXT"), F.lit("")
    new = [F.col(c) for c in ("source_file", "mode", "numbered", "full", "answer", "audio", "difficulty")]
    old = [F.col("f_file"), F.col("f_mode"), none, F.col("f_full"), none, F.col("audio"), F.col("f_difficulty")]
    names = ["source_file", "mode", "gapped_text", "full_text", "answer", "audio", "difficulty"]
    side = lambda a, b: {"reason": why, **dict(zip(names, a, strict=True)), **dict(zip(LISTENING_CONFLICT, b, strict=True))}
    two = both_ways(clash, side(new, old), side(old, new)).select(*LISTENING_REVIEW, *LISTENING_CONFLICT, "seq", "side")
    review = bare.unionByName(two)
    if missing:
        review = review.unionByName(missing_sources(items, missing, "SOURCE_DIR_NOT_FOUND", [*LISTENING_REVIEW, *LISTENING_CONFLICT]).withColumns({"seq": F.lit(None).cast(items.schema["seq"].dataType), "side": F.lit(0)}))
    key = [text.normalize_lines(F.col("numbered")), F.col("norm"), text.normalize_lines(F.col("answer")), F.col("audio"), F.col("difficulty")]
    first, later = dedupe(same, key, "seq", {"conflict_with_source_file": "source_file", "conflict_with_mode": "mode"})
    shown = text.literal_newlines(F.col("numbered"))
    main = first.select(shown.alias("gapped_text"), "answer", "audio", "difficulty", "seq")
    again = later.withColumns({"gapped_text": shown, "reason": F.lit("EXACT_DUPLICATE_ROW")}).select(*LISTENING_DUPLICATES, "seq")
    return Extracted(main, review, again)


SPEAKING_REVIEW = ["source_file", "mode", "reason", "sentences", "audio", "difficulty"]
SPEAKING_CONFLICT = [f"conflict_with_{c}" for c in ("source_file", "mode", "sentences", "audio", "difficulty")]
SPEAKING_DUPLICATES = [*SPEAKING_REVIEW, "conflict_with_source_file", "conflict_with_mode"]


def speaking(items: DataFrame, missing: list[str] | None = None) -> Extracted:
    clean = lambda c: text.trim_unicode(F.regexp_replace(c, r"\r\n?", "\n"))
    rows = items.withColumns({
        "source_file": source_tag(F.col("file"), F.col("pos")),
        "difficulty": enums.difficulty_of(F.col("file"), default="medium"),
        "list": text.nonempty(text.json_strings(field("sentences")), clean),
        "audio": text.trim_unicode(field("audio")),
    }).withColumn("sentences", text.join_sentences(F.col("list")))
    reason = first_reason(
        (F.col("error").isNotNull(), F.col("error")),
        (F.size("list") == 0, "EMPTY_SENTENCES"),
        (F.col("audio") == "", "MISSING_AUDIO"),
        (urls.media_reason(F.col("audio")).isNotNull(), urls.media_reason(F.col("audio"))),
    )
    judged = rows.withColumns({"reason": reason, "norm": text.normalize_lines(F.col("sentences"), lone_cr=True)})
    bare = judged.where("reason is not null").select(*SPEAKING_REVIEW, *(F.lit("").alias(c) for c in SPEAKING_CONFLICT), "seq")
    origin = {"conflict_with_source_file": "source_file", "conflict_with_mode": "mode", "conflict_with_sentences": "norm", "conflict_with_difficulty": "difficulty"}
    same, clash = conflicts(judged.where("reason is null"), "audio", "norm", "seq", origin)
    clash = once_per_pair(clash, "conflict_with_source_file", "source_file", "seq")
    told = clash.withColumns({"reason": F.lit("AUDIO_CONFLICT"), "conflict_with_audio": F.col("audio")}).select(*SPEAKING_REVIEW, *SPEAKING_CONFLICT, "seq")
    review = bare.unionByName(told)
    if missing:
        review = review.unionByName(missing_sources(items, missing, "SOURCE_NOT_FOUND", [*SPEAKING_REVIEW, *SPEAKING_CONFLICT]).withColumn("seq", F.lit(None).cast(items.schema["seq"].dataType)))
    first, later = dedupe(same, ["norm", "audio", "difficulty"], "seq", {"conflict_with_source_file": "source_file", "conflict_with_mode": "mode"})
    again = later.withColumn("reason", F.lit("EXACT_DUPLICATE_ROW")).select(*SPEAKING_DUPLICATES, "seq")
    return Extracted(first.select("sentences", "audio", "difficulty", "seq"), review, again)


MATCHING_REVIEW = ["source_file", "mode", "reason", "sentence_left", "sentence_right", "difficulty"]
MATCHING_DUPLICATES = ["source_file", "mode", "sentence_left", "sentence_right", "difficulty", "conflict_with_source_file", "conflict_with_mode"]


def matching(items: DataFrame, missing: list[str] | None = None) -> Extracted:
    rows = items.withColumns({
        "source_file": source_tag(F.col("file"), F.col("pos")),
        "difficulty": enums.difficulty_of(F.col("file"), enums.EXAM_MARKS, "medium"),
        "pairs": text.json_strings(field("pairs")),
    })
    broken = rows.where(F.col("error").isNotNull() | F.col("pairs").isNull()).withColumn("reason", F.coalesce("error", F.lit("ITEM_PAIRS_NOT_ARRAY")))
    whole = broken.select("source_file", "mode", "reason", F.lit("").alias("sentence_left"), F.lit("").alias("sentence_right"), "difficulty", F.struct("seq", F.lit(-1).alias("sub")).alias("seq"))
    part = lambda n: text.trim_unicode(F.coalesce(F.get_json_object("pair", f"$.{n}"), F.lit("")))
    pairs = rows.where("error is null and pairs is not null").select("source_file", "mode", "difficulty", "seq", F.posexplode("pairs").alias("sub", "pair"))
    pairs = pairs.select("source_file", "mode", "difficulty", part("left").alias("sentence_left"), part("right").alias("sentence_right"), F.struct("seq", "sub").alias("seq"))
    blank = (F.col("sentence_left") == "") | (F.col("sentence_right") == "")
    review = whole.unionByName(pairs.where(blank).withColumn("reason", F.lit("MISSING_LEFT_OR_RIGHT")).select(*MATCHING_REVIEW, "seq"))
    if missing:
        review = review.unionByName(missing_sources(items, missing, "SOURCE_NOT_FOUND", MATCHING_REVIEW).withColumn("seq", F.lit(None).cast(whole.schema["seq"].dataType)))
    first, later = dedupe(pairs.where(~blank), ["sentence_left"], "seq", {"conflict_with_source_file": "source_file", "conflict_with_mode": "mode"})
    return Extracted(first.select("sentence_left", "sentence_right", "difficulty", "seq"), review, later.select(*MATCHING_DUPLICATES, "seq"))


VOCAB_REVIEW = ["source_file", "sentence", "answer", "options", "difficulty", "reason"]
VOCAB_DUPLICATES = ["source_file", "sentence", "answer", "difficulty"]


def vocab(items: DataFrame) -> Extracted:
    """A file that is no JSON gives a reject row; the others' blank questions and non-objects are passed over."""
    rows = items.withColumns({
        "source_file": F.concat_ws("/", "mode", "file"),
        "difficulty": enums.difficulty_of(F.col("file"), enums.EXAM_MARKS, "medium"),
        "sentence": text.normalize_space(field("question")),
        "answer": text.normalize_space(field("answer")),
        "list": text.option_list(field("options")),
    }).withColumn("distractors", text.join_options(F.col("list")))
    asked = F.col("kind").startswith("OBJECT") & (F.col("sentence") != "")
    unread = F.col("error").startswith("JSON_PARSE_ERROR")
    reason = first_reason(
        (unread, F.col("error")),
        (F.size("list") == 0, "MISSING_OPTIONS"),
        (~F.array_contains("list", F.col("answer")), "ANSWER_NOT_IN_OPTIONS"),
    )
    judged = rows.where(F.coalesce(asked, F.lit(False)) | F.coalesce(unread, F.lit(False))).withColumn("reason", reason)
    review = judged.where("reason is not null").withColumn("options", F.col("distractors")).select(*VOCAB_REVIEW, "seq")
    first, later = dedupe(judged.where("reason is null"), [F.lower("sentence")], "seq", {})
    return Extracted(first.select("sentence", "answer", "distractors", "difficulty", "seq"), review, later.select(*VOCAB_DUPLICATES, "seq"))


def reason_counts(review: DataFrame) -> DataFrame:
    return review.groupBy("reason").agg(F.count(F.lit(1)).alias("total")).orderBy("reason")


def issue_count(review: DataFrame, conflict: str, a: str, b: str, more: list[str]) -> DataFrame:
    """Rejects, with both directions of a conflict counted once."""
    clash = F.col("reason") == conflict
    pair = F.struct(text.sorted_pair(F.col(a), F.col(b)), *(F.col(c) for c in more))
    return review.agg((F.count_if(~clash) + F.count_distinct(F.when(clash, pair))).alias("issues"))


def difficulty_counts(main: DataFrame) -> DataFrame:
    return main.agg(*(F.count_if(F.col("difficulty") == d).alias(d) for d in enums.DIFFICULTIES))
