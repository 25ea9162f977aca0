"""CSV sinks whose bytes follow the source format: guide lines, selective quoting, sentinel rows, trailing line ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import csv_field
from lectern.shared import shared_dir

#: Fixed values.
NOTHING_TO_REVIEW = "=== KHONG_CO_CAU_NAO_CAN_REVIEW ==="
NO_DUPLICATE = "=== KHONG_CO_DONG_TRUNG ==="
#: Lines above the header of review and duplicate files, as their readers know them, and the sentinel's column.
REVIEW_GUIDE = {
    "listening": [
        "# REVIEW_REASON_GUIDE",
        "# SOURCE_DIR_NOT_FOUND: Khong tim thay folder nguon",
        "# UNMAPPED_DIFFICULTY: Khong map duoc difficulty tu ten file",
        "# ROOT_NOT_ARRAY / JSON_PARSE_ERROR:*: Loi dinh dang JSON",
        "# ITEM_NOT_OBJECT: Phan tu khong phai object",
        "# MISSING_GAPPED_TEXT: Thieu gapped_text",
        "# MISSING_AUDIO: Thieu audio",
        "# AUDIO_NOT_CLOUDINARY: Audio khong phai link cloudinary",
        "# AUDIO_NOT_MP3: Audio khong co duoi .mp3",
        "# AUDIO_NOT_CLOUDINARY_AND_NOT_MP3: Audio vua khong cloudinary vua khong .mp3",
        "# MISSING_ANSWERS: Thieu danh sach dap an",
        "# ANSWER_COUNT_MISMATCH(gaps:X,answers:Y): So gap va so answer khong khop",
        "# AUDIO_DUPLICATED_WITH_DIFFERENT_FULL_TEXT: Trung audio nhung full_text khac nhau",
        "# === KHONG_CO_CAU_NAO_CAN_REVIEW ===: Khong co dong nao can review",
    ],
    "speaking": [
        "# REVIEW_REASON_GUIDE",
        "# SOURCE_NOT_FOUND: Khong tim thay folder nguon",
        "# ROOT_NOT_ARRAY / JSON_PARSE_ERROR:*: Loi dinh dang JSON",
        "# EMPTY_SENTENCES: Khong co sentence hop le",
        "# MISSING_AUDIO: Thieu audio",
        "# AUDIO_NOT_CLOUDINARY: Audio khong phai link cloudinary",
        "# AUDIO_NOT_MP3: Audio khong co duoi .mp3",
        "# AUDIO_NOT_CLOUDINARY_AND_NOT_MP3: Audio vua khong cloudinary vua khong .mp3",
        "# AUDIO_CONFLICT: Trung audio nhung noi dung sentences khac nhau",
        "# === KHONG_CO_CAU_NAO_CAN_REVIEW ===: Khong co dong nao can review",
    ],
    "matching": [
        "# REVIEW_REASON_GUIDE",
        "# SOURCE_NOT_FOUND: Khong tim thay folder nguon",
        "# ROOT_NOT_ARRAY / JSON_PARSE_ERROR:*: Loi dinh dang JSON",
        "# ITEM_PAIRS_NOT_ARRAY: Item khong co mang pairs hop le",
        "# MISSING_LEFT_OR_RIGHT: Cap pair thieu left hoac right",
        "# === KHONG_CO_CAU_NAO_CAN_REVIEW ===: Khong co dong nao can review",
    ],
    "vocab": [
        "# REVIEW_REASON_GUIDE",
        "# MISSING_OPTIONS: Cau hoi khong co options hop le",
        "# ANSWER_NOT_IN_OPTIONS: Dap an khong nam trong danh sach options",
        "# === KHONG_CO_CAU_NAO_CAN_REVIEW ===: Khong co dong nao can review",
    ],
}
DUPLICATE_GUIDE = {
    "listening": [
        "# DUPLICATE_GUIDE",
        "# EXACT_DUPLICATE_ROW: Dong bi bo qua do trung hoan toan key dedupe",
        "# === KHONG_CO_DONG_TRUNG ===: Khong co dong duplicate",
    ],
    "speaking": [
        "# DUPLICATE_GUIDE",
        "# EXACT_DUPLICATE_ROW: Dong bi bo qua do trung hoan toan key dedupe",
        "# === KHONG_CO_DONG_TRUNG ===: Khong co dong duplicate",
    ],
    "matching": [
        "# DUPLICATE_LEFT_GUIDE",
        "# Ghi lai cac dong bi loai do trung sentence_left voi dong da xuat hien truoc do",
        "# === KHONG_CO_DONG_TRUNG ===: Khong co dong duplicate",
    ],
    "vocab": [
        "# DUPLICATE_GUIDE",
        "# Ghi lai cac dong bi loai do trung sentence",
        "# === KHONG_CO_DONG_TRUNG ===: Khong co dong duplicate",
    ],
}
DUPLICATE_SENTINEL = {"listening": "reason", "speaking": "reason", "matching": "sentence_left", "vocab": "sentence"}


def csv_lines(df: DataFrame, columns: list[str], always: tuple[str, ...] = ()) -> DataFrame:
    """(line, seq) of each row; columns in ``always`` are quoted in any case."""
    fields = [csv_field(F.coalesce(F.col(c).cast("string"), F.lit("")), c in always) for c in columns]
    order = [c for c in ("seq", "side") if c in df.columns]
    return df.select(F.concat_ws(",", *fields).alias("line"), F.struct(*order).alias("seq") if order else F.monotonically_increasing_id().alias("seq"))


def or_sentinel(df: DataFrame, columns: list[str], sentinel: str, at: str) -> DataFrame:
    """``df``, or a row with the sentinel and difficulty medium if it is empty."""
    row = {at: sentinel, "difficulty": "medium"}
    one = df.sparkSession.createDataFrame([tuple(row.get(c, "") for c in columns)], ", ".join(f"`{c}` string" for c in columns))
    none = df.select(F.lit(1).alias("n")).limit(1).agg((F.count("n") == 0).alias("empty"))
    return df.select(*columns, *(c for c in ("seq", "side") if c in df.columns)).unionByName(one.crossJoin(none).where("empty").drop("empty"), allowMissingColumns=True)


def write_lines(lines: DataFrame, path: str, head: list[str], last_newline: bool = True) -> None:
    """One file, rows in ``seq`` order. Tasks write sorted parts; their bytes are then joined on the file system, no row passing
    through Python."""
    spark = lines.sparkSession
    parts = f"{shared_dir(spark)}/lectern-{uuid.uuid4().hex}"
    lines.orderBy("seq").select("line").write.text(parts)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, at = hadoop.fs.Path(parts).getFileSystem(conf), hadoop.fs.Path(path)
    found = sorted(((s.getPath().getName(), s.getPath(), s.getLen()) for s in source.listStatus(hadoop.fs.Path(parts)) if s.getPath().getName().startswith("part-") and s.getLen()), key=lambda x: x[0])
    out = at.getFileSystem(conf).create(at, True)
    out.write(("\n".join(head) + "\n").encode())
    for k, (_, part, size) in enumerate(found, 1):
        stream = source.open(part)
        spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, size if last_newline or k < len(found) else size - 1)
        stream.close()
    out.close()
    source.delete(hadoop.fs.Path(parts), True)


def write_review(df: DataFrame, columns: list[str], kind: str, path: str) -> None:
    """The rejects of an extractor: guide, header, rows or the sentinel."""
    rows = or_sentinel(df, columns, NOTHING_TO_REVIEW, "reason")
    write_lines(csv_lines(rows, columns), path, [*REVIEW_GUIDE[kind], ",".join(columns)])


def write_duplicates(df: DataFrame, columns: list[str], kind: str, path: str) -> None:
    """The duplicates of an extractor: guide, header, rows or the sentinel."""
    rows = or_sentinel(df, columns, NO_DUPLICATE, DUPLICATE_SENTINEL[kind])
    write_lines(csv_lines(rows, columns), path, [*DUPLICATE_GUIDE[kind], ",".join(columns)])


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with doubled quotes and untouched edges, header in each; replaces what is there."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Append to a store table, a connection per partition; made where there is none."""
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()
