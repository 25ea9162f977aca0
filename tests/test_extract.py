import json

import pytest

from lectern.operators import extract
from lectern.sources.files import json_items, read_items, selected_modes

MP3 = "https://res.cloudinary.com/x/%s.mp3"


def items(spark, *files):
    rows = [("upstream", name, 0, i, body if isinstance(body, str) else json.dumps(body)) for i, (name, body) in enumerate(files)]
    return json_items(spark.createDataFrame(rows, "mode string, file string, mode_rank int, file_rank int, value string"))


def reasons(review):
    return sorted((r["source_file"], r["reason"]) for r in review.collect())


def test_listening_reasons(spark):
    ok = {"gapped_text": "a __ b", "blanks": [{"answer": "x"}], "audio": MP3 % 1}
    rows = [
        ok, None, 5, ok | {"gapped_text": " "}, ok | {"audio": ""}, ok | {"audio": "http://e.com/a.mp3"}, ok | {"blanks": []},
        ok | {"gapped_text": "__ and __"}, ok, ok | {"gapped_text": "c __ b"}, [1],
    ]
    out = extract.listening(items(spark, ("level1.json", rows), ("odd.json", [ok]), ("level2.json", "{"), ("level3.json", {"a": 1})), ["statics"])
    assert [(r["gapped_text"], r["answer"], r["difficulty"]) for r in out.main.collect()] == [("a _______(1) b", "1:x", "easy")]
    assert reasons(out.review) == sorted([
        ("level1.json#2", "ITEM_NOT_OBJECT"), ("level1.json#3", "ITEM_NOT_OBJECT"), ("level1.json#4", "MISSING_GAPPED_TEXT"), ("level1.json#5", "MISSING_AUDIO"),
        ("level1.json#6", "AUDIO_NOT_CLOUDINARY"), ("level1.json#7", "MISSING_ANSWERS"), ("level1.json#8", "ANSWER_COUNT_MISMATCH(gaps:2,answers:1)"),
        ("level1.json#10", "AUDIO_DUPLICATED_WITH_DIFFERENT_FULL_TEXT"), ("level1.json#1", "AUDIO_DUPLICATED_WITH_DIFFERENT_FULL_TEXT"), ("level1.json#11", "MISSING_GAPPED_TEXT"),
        ("odd.json", "UNMAPPED_DIFFICULTY"), ("level2.json", "JSON_PARSE_ERROR:invalid JSON"), ("level3.json", "ROOT_NOT_ARRAY"), ("", "SOURCE_DIR_NOT_FOUND"),
    ])
    back = [r for r in out.review.collect() if r["source_file"] == "level1.json#1"][0]
    assert back["conflict_with_source_file"] == "level1.json#10" and back["gapped_text"] == "" and back["full_text"] == "a x b"
    assert [(r["source_file"], r["conflict_with_source_file"]) for r in out.duplicates.collect()] == [("level1.json#9", "level1.json#1")]


def test_speaking_reasons(spark):
    ok = {"id": 1, "sentences": ["a ", "", "b"], "audio": MP3 % 1}
    out = extract.speaking(items(spark, ("basic.json", [ok, ok, ok | {"sentences": ["c"]}, ok | {"sentences": "x"}, ok | {"audio": None}, None])))
    assert [(r["sentences"], r["difficulty"]) for r in out.main.collect()] == [("a\nb", "easy")]
    assert reasons(out.review) == [("basic.json#3", "AUDIO_CONFLICT"), ("basic.json#4", "EMPTY_SENTENCES"), ("basic.json#5", "MISSING_AUDIO"), ("basic.json#6", "EMPTY_SENTENCES")]
    assert out.duplicates.count() == 1


def test_matching_reasons(spark):
    rows = [{"pairs": [{"left": "a", "right": "1"}, {"left": " a ", "right": "2"}, {"left": "A", "right": "3"}, {"left": "", "right": "x"}]}, {"pairs": 3}]
    out = extract.matching(items(spark, ("c1.json", rows)))
    assert sorted(r["sentence_left"] for r in out.main.collect()) == ["A", "a"]
    assert reasons(out.review) == [("c1.json#1", "MISSING_LEFT_OR_RIGHT"), ("c1.json#2", "ITEM_PAIRS_NOT_ARRAY")]
    assert [(r["sentence_right"], r["conflict_with_source_file"]) for r in out.duplicates.collect()] == [("2", "c1.json#1")]


def test_vocab_reasons(spark):
    rows = [
        {"question": "Q one", "answer": "a", "options": ["a", "b"]}, {"question": "q  ONE", "answer": "a", "options": {"A": "a"}},
        {"question": "two", "answer": "A", "options": ["a"]}, {"question": "three", "answer": "a"}, {"question": " ", "answer": "a", "options": ["a"]}, 7,
        {"question": "four", "answer": "0", "options": ["0", 1]}, {"question": "five", "answer": "0", "options": [0, "1"]},
    ]
    out = extract.vocab(items(spark, ("b1.json", rows), ("b2.json", "[{")))
    assert sorted((r["sentence"], r["distractors"], r["difficulty"]) for r in out.main.collect()) == [("Q one", "a|b", "easy"), ("four", "0|1", "easy")]
    assert reasons(out.review) == [("upstream/b1.json", "ANSWER_NOT_IN_OPTIONS"), ("upstream/b1.json", "ANSWER_NOT_IN_OPTIONS"), ("upstream/b1.json", "MISSING_OPTIONS"), ("upstream/b2.json", "JSON_PARSE_ERROR:invalid JSON")]
    assert [r["sentence"] for r in out.duplicates.collect()] == ["q ONE"]


def test_reading_folders(spark, tmp_path):
    folder = tmp_path / "upstream"
    folder.mkdir()
    (folder / "b.JSON").write_text("[1]")
    (folder / "A.json").write_text("[2, 3]")
    (folder / "no.txt").write_text("[4]")
    found, missing = read_items(spark, str(tmp_path), ["destination", "upstream"])
    assert missing == ["destination"]
    assert [(r["file"], r["item"], r["pos"]) for r in found.orderBy("seq").collect()] == [("A.json", "2", 1), ("A.json", "3", 2), ("b.JSON", "1", 1)]
    assert selected_modes("x") == ["statics", "upstream"] and selected_modes("upstream") == ["upstream"]
    (folder / "C d%1.json").write_text("[5]")
    (tmp_path / "statics").mkdir()
    (tmp_path / "statics" / "z.json").write_text("{")
    both, missing = read_items(spark, str(tmp_path), ["statics", "upstream"], any_case=False)
    assert missing == [] and [(r["mode"], r["file"], r["error"] is None) for r in both.orderBy("seq").collect()] == [("statics", "z.json", False), ("upstream", "A.json", True), ("upstream", "A.json", True), ("upstream", "C d%1.json", True)]
    assert len(both.inputFiles()) == 3
    for root, modes in ((str(tmp_path / "no"), ["upstream"]), (str(tmp_path), ["destination"])):
        with pytest.raises(FileNotFoundError):
            read_items(spark, root, modes, required=True)
    (tmp_path / "statics" / "z.json").unlink()
    none, missing = read_items(spark, str(tmp_path), ["statics"])
    assert none.count() == 0 and missing == ["statics"]
