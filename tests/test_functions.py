from pyspark.sql import functions as F

from lectern.functions import enums, text, urls


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_white_space_is_unicode(spark):
    assert one(spark, text.normalize_space(F.col("a")), a="\u00a0 a \t\r\n b\u2003 c\ufeff") == "a b c"
    assert one(spark, text.normalize_lines(F.col("a")), a=" a \t b\r\nc ") == "a b\nc"
    assert one(spark, text.normalize_lines(F.col("a"), lone_cr=True), a="a\rb\r\nc") == "a\nb\nc"
    assert one(spark, text.normalize_text(F.col("a")), a=" a  b\r\n") == "a  b"


def test_gaps(spark):
    c = F.col("a")
    assert one(spark, text.count_gaps(c), a="__ a _ b ____") == 2
    assert one(spark, text.number_gaps(c), a="__ a _ b ____") == "_______(1) a _ b _______(2)"
    assert one(spark, text.fill_gaps(c, F.array(F.lit("x"))), a="__ a ____!") == "x a !"
    assert one(spark, text.number_gaps(c), a="no gap") == "no gap"


def test_options(spark):
    c = text.option_list(F.col("a"))
    assert one(spark, c, a='["x", " y ", "", null]') == ["x", "y"]
    assert one(spark, c, a='{"B": "b", "A": "a"}') == ["b", "a"]
    assert one(spark, c, a='["0", "1", "false", 0, 0.0, 1, 2.5, true, false, null, "x"]') == ["0", "1", "false", "1", "2.5", "true", "x"]
    assert one(spark, c, a='{"b": "0", "a": 0, "c": false}') == ["0"]
    assert one(spark, c, a="5") == [] and one(spark, c, a="oops") == []
    assert one(spark, text.split_options(F.col("a")), a="a|b|c") == ["a", "b", "c"]
    assert one(spark, text.split_options(F.col("a")), a="") == []


def test_csv_field(spark):
    assert one(spark, text.csv_field(F.col("a")), a='say "hi"') == '"say ""hi"""'
    assert one(spark, text.csv_field(F.col("a")), a="plain") == "plain"
    assert one(spark, text.csv_field(F.col("a"), True), a="plain") == '"plain"'


def test_urls(spark):
    reason = urls.media_reason(F.col("a"))
    assert one(spark, reason, a="https://res.cloudinary.com/x/a.MP3?v=1") is None
    assert one(spark, reason, a="https://res.cloudinary.com/x/a.wav") == "AUDIO_NOT_MP3"
    assert one(spark, reason, a="https://example.com/a.mp3") == "AUDIO_NOT_CLOUDINARY"
    assert one(spark, reason, a="not a url") == "AUDIO_NOT_CLOUDINARY_AND_NOT_MP3"


def test_enums(spark):
    assert one(spark, enums.difficulty_of(F.col("a")), a="Level2.json") == "medium"
    assert one(spark, enums.difficulty_of(F.col("a")), a="other.json") is None
    assert one(spark, enums.difficulty_of(F.col("a"), enums.EXAM_MARKS, "medium"), a="C1.json") == "hard"
    assert one(spark, enums.normalize_difficulty(F.col("a")), a=" Easy ") == "easy"
    assert one(spark, enums.normalize_difficulty(F.col("a")), a="odd") == "medium"
    assert one(spark, enums.normalize_difficulty(F.col("a")), a="\thard\n") == "hard"
    assert one(spark, enums.normalize_difficulty(F.col("a")), a="\u00a0EASY") == "easy"
    assert one(spark, enums.node_id(F.lit(3), F.col("a")), a="MATCHING") == 14
    assert one(spark, enums.node_id(F.lit(3), F.col("a")), a="OTHER") == 11
