"""The pipeline on a small corpus, stage by stage."""

import random

import corpus_pipeline
from lectern.llm.packing import SCHEMA


def test_pipeline(spark, as_tables):
    rng = random.Random(3)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    rows = [(i, prose(200) + ". The end.") for i in range(120)]
    rows += [(200 + i, " ".join(w + "&&&" for w in prose(150).split())) for i in range(30)]
    rows += [(300, rows[3][1]), (301, rows[4][1] + " tail"), (302, passage + " " + prose(100)), (303, prose(100) + " " + passage), (304, prose(80) + ' token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" ' + prose(80)), (305, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _ in rows if i < 300 and i % 2 == 0], "doc_id long, quality int, toxic int")
    folder = as_tables(documents=docs, labels=labels)
    steps, at = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
        if name != "packing":
            assert at.columns == docs.columns
        at = as_tables(x=at)
        at = spark.read.parquet(f"{at}/x.parquet")
        steps[name] = at
    ids = {k: {r["doc_id"] for r in v.select("doc_id").collect()} for k, v in steps.items()}
    first = ids["quality classifier"]
    assert len([i for i in first if i < 200]) >= 118 and len([i for i in first if 200 <= i < 230]) <= 1
    second = ids["simhash near-dedup"]
    assert 300 not in second and {3, 302, 303} & first <= second
    third = {r["doc_id"]: r["text"] for r in steps["substring dedup"].collect()}
    if {302, 303} <= set(third):
        assert passage in third[302] and passage not in third[303]
    fourth = {r["doc_id"]: r for r in steps["secret scan"].collect()}
    assert "[SECRET]" in fourth[304]["text"] and fourth[304]["n_chars"] == len(fourth[304]["text"])
    assert set(fourth) == set(third)
    assert steps["packing"].columns[:7] == [c.split()[0] for c in SCHEMA.split(", ")]
    assert {r["doc_id"] for r in steps["packing"].collect()} == set(fourth)
    assert corpus_pipeline.run(spark, folder).count() == steps["packing"].count()


def test_rows_of_shared_and_null_ids_keep_their_own_text(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, own = prose(40), [prose(30) for _ in range(6)]
    rows = [(1, passage + " " + own[0]), (5, own[1] + " " + passage), (5, passage + " " + own[2]), (5, own[3]), (None, own[4] + " " + passage), (None, passage + " " + own[5])]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.substring_dedup(spark, docs, "").collect()
    want = [(1, rows[0][1]), (5, own[1]), (5, own[2]), (5, own[3]), (None, own[4]), (None, own[5])]
    assert sorted(map(tuple, got), key=str) == sorted(((i, t, len(t)) for i, t in want), key=str)


def test_edges_of_the_stages(spark, as_tables):
    """Null ids and texts, empty and long texts, repeated rows and further columns with clashing names, stage by stage; empty tables."""
    rng = random.Random(4)
    prose = lambda n: " ".join(f"{rng.choice(['the', 'of', 'and', 'to'])} w{rng.randrange(300)}" for _ in range(n))
    shared = prose(60)
    rows = [(i, prose(60)) for i in range(40)] + [(50, None), (51, ""), (None, prose(80)), (None, shared), (52, shared + " " + prose(30)), (53, prose(20) + " " + shared), (54, prose(20_000)), (7, None)]
    rows += [rows[3], rows[3], (60, rows[3][1])]
    full = [(t, i, "en", "s", len(t or ""), f"b{k}", 1, [k]) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, "text string, doc_id long, lang string, source string, n_chars long, block string, shard int, words array<int>")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")  # of one kind: all stay
    folder = as_tables(labels=labels)
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = at.collect()
        at = spark.read.parquet(as_tables(x=stage(spark, at, folder)) + "/x.parquet")
        if name == "packing":
            assert at.select("doc_id").distinct().count() == len({r["doc_id"] for r in before})
            break
        after = at.collect()
        assert at.columns == docs.columns
        assert all(r["n_chars"] == len(r["text"] or "") for r in after)
        if name == "simhash near-dedup":
            assert 60 not in {r["doc_id"] for r in after} and sum(r["doc_id"] == 3 for r in after) == 3 and sum(r["doc_id"] is None for r in after) == 2
        else:
            assert sorted(r["block"] for r in after) == sorted(r["block"] for r in before)
    none = docs.where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, folder)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, as_tables(documents=none, labels=labels.limit(0))).count() == 0
