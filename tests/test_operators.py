from pyspark.sql import functions as F

import pytest

from lectern.operators import assign, charts, export, load, report, sample, sinks, stats
from lectern.sources import store
from lectern.sources.files import read_consolidated, read_csv, read_jdbc
from lectern.streaming.load import load_stream


def test_round_robin_is_even_under_one_hot_level(spark):
    q = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(2).alias("level_id"))
    trees = spark.createDataFrame([(10, 1), (11, 1), (12, 1), (20, 2)], "id long, level_id int")
    got = assign.round_robin(q, trees, ["id"])
    counts = {r["tree_id"]: r["count"] for r in got.groupBy("tree_id").count().collect()}
    assert counts == {10: 300, 11: 300, 12: 300, 20: 100}
    assert {r["id"] % 3: r["tree_id"] for r in got.where("level_id = 1").collect()} == {0: 10, 1: 11, 2: 12}


def test_numbers_have_no_gap_under_a_hot_level_and_wide_rows(spark):
    q = spark.range(120_000).select((F.col("id") * 7919 % 120_000).alias("id"), F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 10).cast("int").alias("level_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 6).alias("text"), F.lit(5).alias("_n"))
    q = q.unionByName(q.where("id < 0")).repartition(7)
    got = assign.numbered(q, "level_id", ["id"], "place")
    assert got.columns == [*q.columns, "place"]
    by = got.groupBy("level_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("place").alias("d"), F.min("place").alias("low"), F.max("place").alias("high")).collect()
    assert sum(r["n"] for r in by) == 120_000 and all(r["d"] == r["n"] == r["high"] + 1 and r["low"] == 0 for r in by)
    assert got.join(got.select("level_id", (F.col("place") + 1).alias("place"), F.col("id").alias("before")), ["level_id", "place"]).where("before >= id").count() == 0
    assert sorted(r["place"] for r in assign.numbered(spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "level_id int, id int"), "level_id", ["id"], "place").collect()) == [0, 0, 1]


def questions(spark):
    rows = [(i, f"text {i % 7}", "a|b", "a", "easy", "VOCAB", None, 5, 1) for i in range(20)]
    return spark.createDataFrame(rows, "pos int, sentence string, options string, answer string, difficulty string, question_type string, audio_url string, node_id int, level_id int")


def test_loading_twice_adds_nothing(spark):
    q = questions(spark)
    empty_docs, empty_facts = spark.createDataFrame([], "question_text string"), spark.createDataFrame([], "mongo_question_id string")
    docs, facts = load.load_new(q, empty_docs, empty_facts, ["pos"])
    assert docs.count() == facts.count() == 7
    again = load.load_new(q, docs, facts, ["pos"])
    assert again[0].count() == again[1].count() == 0


def test_stream_load(spark, tmp_path):
    q = questions(spark)
    docs, facts = load.load_new(q.where("pos < 3"), spark.createDataFrame([], "question_text string"), spark.createDataFrame([], "mongo_question_id string"), ["pos"])
    docs.write.parquet(str(tmp_path / "docs"))
    facts.write.parquet(str(tmp_path / "facts"))
    q.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))
        load_stream(stream, str(tmp_path / "docs"), str(tmp_path / "facts"), str(tmp_path / "state"), ["pos"]).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "docs")).count() == spark.read.parquet(str(tmp_path / "facts")).count() == 7


def exam(spark, seed):
    kinds = ["VOCAB", "LISTENING", "SPEAKING", "MATCHING"]
    nodes = spark.createDataFrame([(t * 5 + i, t, f"n{i}", k, i) for t in (0, 1) for i, k in enumerate([*kinds, "REVIEW"])], "id long, skill_tree_id long, title string, node_type string, order_index int")
    trees = spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "id long, level_id int, order_index int")
    q = spark.createDataFrame([(i, (i % 2) * 5 + (i // 2) % 4, 1, kinds[(i // 2) % 4]) for i in range(400)], "id long, node_id long, level_id int, question_type string")
    return sample.exam(q, nodes, trees, seed), trees, nodes


def test_quotas_and_disjoint_review(spark):
    drawn, _, _ = exam(spark, "a")
    rows = drawn.collect()
    sizes = {}
    for r in rows:
        sizes[r["tree_id"], r["node_type"]] = sizes.get((r["tree_id"], r["node_type"]), 0) + 1
    assert all(sizes[t, k] == n for t in (0, 1) for k, n in {"VOCAB": 10, "MATCHING": 10, "LISTENING": 1, "SPEAKING": 1, "REVIEW": 10}.items())
    for t in (0, 1):
        ids = [r["id"] for r in rows if r["tree_id"] == t]
        assert len(ids) == len(set(ids))
    assert {tuple(r) for r in exam(spark, "a")[0].collect()} == {tuple(r) for r in rows} != {tuple(r) for r in exam(spark, "b")[0].collect()}


def test_sheets(spark, tmp_path):
    drawn, trees, nodes = exam(spark, "a")
    facts = drawn.select("id", F.col("id").cast("string").alias("mongo_question_id"), F.lit("right").alias("correct_answer")).distinct()
    docs = facts.select(F.col("mongo_question_id").alias("_id"), F.concat(F.lit("Q\\n"), "mongo_question_id").alias("question_text"), F.array(*(F.lit(x) for x in ("w1", "w2", "w3", "w4", "right"))).alias("distractors"), F.create_map(F.lit("audio_url"), F.lit("u")).alias("metadata"))
    rows = sample.enrich(drawn.join(nodes.select(F.col("id").alias("node_id"), "order_index"), "node_id"), facts, docs)
    got = export.sheets(rows, trees, "s").orderBy("tree_number").collect()
    assert [r["tree_number"] for r in got] == [1, 2]
    body = got[0]["content"]
    assert body.startswith("TREE 0\n" + "=" * 36 + "\n\nNODE VOCAB\n\nQ1: ")
    assert [line for line in body.split("\n") if line.startswith("NODE")] == [f"NODE {k}" for k in ("VOCAB", "LISTENING", "SPEAKING", "MATCHING", "REVIEW")]
    assert "Answer: None" not in body and " -> right\n" in body
    export.write_sheets(export.sheets(rows, trees, "s"), str(tmp_path / "out"))
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.txt")) == ["level_1/tree_1.txt", "level_1/tree_2.txt"]
    assert (tmp_path / "out" / "level_1" / "tree_1.txt").read_text() == body


def test_sheet_layout(spark):
    """Every kind of question, a node that drew nothing, and the order in a review node."""
    nodes = spark.createDataFrame([(1, 7, "VOCAB", 0), (2, 7, "LISTENING", 1), (3, 7, "SPEAKING", 2), (4, 7, "MATCHING", 3), (5, 7, "REVIEW", 4), (6, 7, "REVIEW", 5)], "id long, skill_tree_id long, node_type string, order_index int")
    trees = spark.createDataFrame([(7, 2, 0), (8, 3, 0)], "id long, level_id int, order_index int")
    drawn = [(7, 1, "VOCAB", 11, "VOCAB", 1), (7, 3, "SPEAKING", 12, "SPEAKING", 1), (7, 4, "MATCHING", 13, "MATCHING", 1), (7, 4, "MATCHING", 14, "MATCHING", 2)]
    drawn += [(7, 5, "REVIEW", 21, "SPEAKING", 1), (7, 5, "REVIEW", 22, "LISTENING", 1), (7, 5, "REVIEW", 23, "MATCHING", 2), (7, 5, "REVIEW", 24, "MATCHING", 1), (7, 5, "REVIEW", 25, "VOCAB", 1)]
    rows = spark.createDataFrame([(*r, 2) for r in drawn], "tree_id long, node_id long, node_type string, id long, question_type string, rn int, level_id int")
    full = sample.with_empty_nodes(rows, nodes, trees).withColumns({"correct_answer": F.concat(F.lit("a"), "id"), "question_text": F.when(F.col("id") == 12, "").otherwise(F.concat(F.lit("t"), "id")), "options": F.array().cast("array<string>")})
    got = {r["tree_number"]: r["content"] for r in export.sheets(full, trees, "s").collect()}
    line = "=" * 36
    assert got[1] == (
        f"TREE 7\n{line}\n\n"
        "NODE VOCAB\n\nQ1: t11\nA. a11\nAnswer: A\n\n\n\n"
        "NODE LISTENING\n\n\n\n"
        "NODE SPEAKING\n\nQ1: [Speaking] Describe the image\na12\n\n\n\n"
        "NODE MATCHING\n\n1. t13 -> a13\n2. t14 -> a14\n\n\n"
        "NODE REVIEW\n\nQ1: t25\nA. a25\nAnswer: A\n\nQ2: t24\nAnswer: a24\n\nQ3: t23\nAnswer: a23\n\nQ4: t22\nAnswer: a22\n\nQ5: [Speaking] t21\na21\n\n\n\n"
    )
    assert got[2] == f"TREE 8\n{line}\n\n"
    nested = sample.nested(sample.with_empty_nodes(rows, nodes, trees), ["id"]).first()["nodes"]
    assert [(n["node_type"], [q["id"] for q in n["questions"]]) for n in nested] == [("VOCAB", [11]), ("LISTENING", []), ("SPEAKING", [12]), ("MATCHING", [13, 14]), ("REVIEW", [25, 24, 23, 22, 21])]


def test_nodes_without_questions_count_zero(spark):
    nodes = spark.createDataFrame([(1, 1, "a", "VOCAB", 0), (2, 1, "b", "VOCAB", 1), (3, 1, "c", "LISTENING", 2)], "id long, skill_tree_id long, title string, node_type string, order_index int")
    trees = spark.createDataFrame([(1, 1, 0)], "id long, level_id int, order_index int")
    q = spark.createDataFrame([(i, 1, 1, "VOCAB") for i in range(4)], "id long, node_id long, level_id int, question_type string")
    assert [tuple(r) for r in stats.skill_by_level(q, nodes, trees).collect()] == [(1, "LISTENING", 0), (1, "VOCAB", 4)]
    per_node = stats.node_by_level_with_skill(q, nodes, trees)
    assert [r["total"] for r in per_node.collect()] == [4, 0, 0]
    assert [tuple(r) for r in stats.node_coverage(per_node, q.select("level_id").distinct(), 1, 3).collect()] == [(1, 3, 33.33, 66.67)]


def test_report(spark):
    rate = spark.createDataFrame([(0.25,)], "duplicate_rate double")

    def call(level, seed):
        if level == 2:
            raise ValueError
        return rate

    rows = report.summarize(report.measure(spark, call, [1, 2], 3)).collect()
    assert [(r["level"], r["success"], r["avg_duplicate"]) for r in rows] == [(1, 3, 25.0), (2, 0, 0.0)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, 'b "q"', "x\ny"), (1, "a", "p,q")], "seq int, left string, right string")
    path = tmp_path / "main.csv"
    sinks.write_lines(sinks.csv_lines(df, ["left", "right"], ("left",)), str(path), ["# guide", "left,right"])
    assert path.read_text() == '# guide\nleft,right\n"a","p,q"\n"b ""q""","x\ny"\n'
    back = read_csv(spark, str(path), comments=True)
    assert {tuple(r) for r in back.collect()} == {("a", "p,q"), ('b "q"', "x\ny")}
    empty = sinks.or_sentinel(df.where("seq > 9").withColumn("difficulty", F.lit("")), ["left", "difficulty"], sinks.NO_DUPLICATE, "left")
    assert [r["left"] for r in empty.collect()] == [sinks.NO_DUPLICATE]
    full = sinks.or_sentinel(df.withColumn("difficulty", F.lit("")), ["left", "difficulty"], sinks.NO_DUPLICATE, "left")
    assert full.count() == 2
    sinks.write_lines(sinks.csv_lines(df, ["left"]), str(tmp_path / "bare.csv"), ["left"], last_newline=False)
    assert (tmp_path / "bare.csv").read_text() == 'left\na\n"b ""q"""'
    sinks.write_review(df.where("seq > 9").withColumns({"reason": F.lit(""), "difficulty": F.lit("")}), ["left", "reason", "difficulty"], "matching", str(tmp_path / "review.csv"))
    lines = (tmp_path / "review.csv").read_text().split("\n")
    assert lines[0] == "# REVIEW_REASON_GUIDE" and lines[-3:] == ["left,reason,difficulty", f",{sinks.NOTHING_TO_REVIEW},medium", ""]
    sinks.write_duplicates(df.withColumns({"reason": F.lit("EXACT_DUPLICATE_ROW"), "difficulty": F.lit("easy")}), ["reason", "left", "difficulty"], "speaking", str(tmp_path / "again.csv"))
    assert (tmp_path / "again.csv").read_text().split("\n")[3:6] == ["reason,left,difficulty", "EXACT_DUPLICATE_ROW,a,easy", 'EXACT_DUPLICATE_ROW,"b ""q""",easy']
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert read_csv(spark, str(tmp_path / "csv")).count() == 2


def test_missing_inputs_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_consolidated(spark, str(tmp_path / "none.csv"), ["a"])
    (tmp_path / "some.csv").write_text("\ufeffa , b\n1,2\n")
    assert [tuple(r) for r in read_consolidated(spark, str(tmp_path / "some.csv"), ["b", "a"]).collect()] == [("2", "1")]


def test_store_tables_over_jdbc(spark, tmp_path):
    """The embedded database that comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/store;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id int, title string")
    sinks.append_jdbc(df.where("id < 6"), url, "nodes", **driver)
    sinks.append_jdbc(df.where("id >= 6"), url, "nodes", **driver)
    back = read_jdbc(spark, url, "nodes", **driver, partitionColumn="id", lowerBound="0", upperBound="10", numPartitions="2")
    assert back.rdd.getNumPartitions() == 2
    assert sorted((r["id"], r["title"]) for r in back.collect()) == [(i, f"n{i}") for i in range(10)]


def test_charts(spark, tmp_path):
    from xml.etree import ElementTree

    nodes = spark.createDataFrame([(i, 1 + i % 2, f"n{i}", ["VOCAB", "LISTENING", "REVIEW"][i % 3], i) for i in range(12)], "id long, skill_tree_id long, title string, node_type string, order_index int")
    trees = spark.createDataFrame([(1, 1, 0), (2, 2, 0)], "id long, level_id int, order_index int")
    q = spark.createDataFrame([(i, i % 12, 1 + i % 2, "VOCAB" if i % 4 else "<odd & type>") for i in range(120)], "id long, node_id long, level_id int, question_type string")
    charts.write_charts(stats.charts(q, nodes, trees), str(tmp_path / "charts"))
    found = {p.stem: ElementTree.parse(p).getroot() for p in (tmp_path / "charts").glob("*.svg")}
    assert sorted(found) == ["balance-score-by-level", "node-balance-by-skill", "node-coverage-by-level", "node-distribution-level-1", "node-distribution-level-2", "question-by-level", "skill-ratio-by-level", "skill-x-question-type"]
    tips = {name: [t.text for t in root.iter("{http://www.w3.org/2000/svg}title")] for name, root in found.items()}
    assert "Level 1 (50.0%): 60" in tips["question-by-level"]
    assert "VOCAB - <odd & type>: 10" in tips["skill-x-question-type"]
    assert "Node 3 - VOCAB: 10" in tips["node-distribution-level-2"]


def test_chart_shapes():
    assert charts.pie(["a", "b", "c"], [1, 3, 0], "t").count("<path") == 2 and charts.pie(["a"], [5], "t").count("<circle") == 1
    assert charts.pie([], [], "t").endswith("</svg>") and charts.bars([], [], "t").endswith("</svg>") and charts.grouped_bars([], {}, "t").endswith("</svg>")
    height = lambda svg, tip: float(svg[: svg.index(tip)].rsplit('height="', 1)[1].split('"')[0])
    one = charts.stacked_bars(["x", "y"], {"a": [1, 2], "b": [3, 2]}, "t")
    assert height(one, "x, b: 3") == pytest.approx(3 * height(one, "x, a: 1"), abs=0.2)


def test_store_fallback():
    tried = []

    def connect(uri):
        tried.append(uri)
        if uri == "a":
            raise OSError("querySrv ENOTFOUND")
        if uri == "c":
            raise OSError("refused")
        return uri

    assert store.with_fallback(connect, "a", "b") == "b" and tried == ["a", "b"]
    for uri, direct in (("a", None), ("c", "b")):
        with pytest.raises(OSError):
            store.with_fallback(connect, uri, direct)
