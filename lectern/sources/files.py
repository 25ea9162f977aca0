"""Readers: JSON item files by source mode, CSV files, JDBC tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import json_strings

MODES = ("statics", "stactics", "destination", "upstream")


def selected_modes(mode: str, first: str = "statics", strict: bool = False) -> list[str]:
    """Folders to read for a mode argument. An unknown one means both, or is an error if ``strict``."""
    if mode in MODES:
        return [mode]
    if mode != "both" and strict:
        raise ValueError(f"unknown source mode: {mode}")
    return [first, "upstream"]


def _files(spark: SparkSession, folder: str):
    """The folder's file system and path, None for the path if there is no such folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, path if files.exists(path) else None


def _has_json(spark: SparkSession, folder: str, any_case: bool) -> bool:
    files, path = _files(spark, folder)
    found = files.listStatusIterator(path) if path is not None else None
    while found is not None and found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if status.isFile() and (name.lower() if any_case else name).endswith(".json"):
            return True
    return False


def read_items(spark: SparkSession, root: str, modes: list[str], any_case: bool = True, required: bool = False) -> tuple[DataFrame, list[str]]:
    """Items of all JSON files under root/mode, and the modes without a folder or file. One scan, however many files there are.

    Columns: mode, file, seq (mode, file and item rank), pos (from 1; null for a broken file), item (text), kind (JSON type), error.
    ``required``: a root that is no folder, or has no file for any of the modes, is an error.
    """
    if required and _files(spark, root)[1] is None:
        raise FileNotFoundError(root)
    found = [m for m in modes if _has_json(spark, f"{root}/{m}", any_case)]
    missing = [m for m in modes if m not in found]
    if required and not found:
        raise FileNotFoundError(f"no JSON file under {root}: {', '.join(modes)}")
    if not found:
        return spark.createDataFrame([], "mode string, file string, seq struct<mode_rank:int,file_rank:string,pos:int>, pos int, item string, kind string, error string"), missing
    texts = spark.read.option("pathGlobFilter", "*.[jJ][sS][oO][nN]" if any_case else "*.json").text([f"{root}/{m}" for m in found], wholetext=True)
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))  # names come as parts of a URI
    named = texts.select("value", plain(F.col("_metadata.file_name")).alias("file"), plain(F.element_at(F.split("_metadata.file_path", "/"), -2)).alias("mode"))
    rank = F.array_position(F.array(*(F.lit(m) for m in modes)), F.col("mode")).cast("int") - 1
    # names in order without regard to case, then with
    return json_items(named.select("mode", "file", rank.alias("mode_rank"), F.concat(F.lower("file"), F.lit("/"), "file").alias("file_rank"), "value")), missing


def json_items(texts: DataFrame) -> DataFrame:
    """One row per array element of each JSON text (mode, file, mode_rank, file_rank, value); one with an error for a broken text."""
    root = F.try_parse_json("value")
    is_array = F.schema_of_variant(root).startswith("ARRAY")
    error = F.when(root.isNull(), "JSON_PARSE_ERROR:invalid JSON").when(~is_array, "ROOT_NOT_ARRAY")
    kinds = F.transform(F.from_json(F.col("value"), "array<variant>"), lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID")))
    found = texts.withColumn("error", error)
    good = found.where("error is null").select("mode", "file", "mode_rank", "file_rank", F.posexplode(F.arrays_zip(json_strings(F.col("value")).alias("item"), kinds.alias("kind"))).alias("pos", "x"), "error")
    bad = found.where("error is not null").select("mode", "file", "mode_rank", "file_rank", F.lit(-1).alias("pos"), F.struct(F.lit(None).cast("string").alias("item"), F.lit(None).cast("string").alias("kind")).alias("x"), "error")
    every = good.unionByName(bad)
    pos = F.when(F.col("pos") >= 0, F.col("pos") + 1)
    return every.select("mode", "file", F.struct("mode_rank", "file_rank", F.col("pos")).alias("seq"), pos.alias("pos"), "x.item", "x.kind", "error")


def read_csv(spark: SparkSession, path: str | list[str], comments: bool = False) -> DataFrame:
    """All columns as text; header trimmed, byte-order mark removed, doubled quotes and line breaks in fields read."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    df = (reader.option("comment", "#") if comments else reader).csv(path)
    return df.toDF(*(c.replace("\ufeff", "").strip() for c in df.columns))


def read_consolidated(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The consolidated file, ``columns`` in this order; a missing file is an error."""
    if _files(spark, path)[1] is None:
        raise FileNotFoundError(path)
    return read_csv(spark, path).select(*columns)


def read_csv_folder(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    """(file name, rows) of every file in a folder, by name; their headers differ, so each is a frame of its own."""
    files, path = _files(spark, folder)
    if path is None:
        raise FileNotFoundError(folder)
    names = sorted(s.getPath().getName() for s in files.listStatus(path) if s.isFile())
    return [(n, read_csv(spark, f"{folder}/{n}")) for n in names]


def read_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A store table; partitionColumn, lowerBound, upperBound and numPartitions make the scan parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def source_tag(file: Column, pos: Column) -> Column:
    return F.when(pos.isNull(), file).otherwise(F.concat(file, F.lit("#"), pos.cast("string")))
