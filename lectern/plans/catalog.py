"""Registered queries of the engine and their DuckDB twins.

Each query applies one operator of the library to the driver's tables as bound in :mod:`lectern.plans.bind`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import enums, text, urls
from lectern.operators import assign, consolidate, export, extract, firstseen, load, report, sample, sinks, stats
from lectern.plans.bind import STORE, nodes, questions, read, trees

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        _queries[key] = f
        if sql:
            _sql[key] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def store(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return questions(spark, d), nodes(spark, d), trees(spark, d)


def docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents")


# ---- scans


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def scan_documents(spark, d):
    return docs(spark, d).select("doc_id", "lang", "source", "n_chars")


@query("SELECT event_id, event_type, value FROM events")
def scan_events(spark, d):
    return read(spark, d, "events").select("event_id", "event_type", "value")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text END AS first_item, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'ROOT_NOT_ARRAY' ELSE 'JSON_PARSE_ERROR' END AS error, CASE doc_id % 3 WHEN 0 THEN 2 ELSE 1 END AS n_rows FROM documents")
def json_source_errors(spark, d):
    """Texts as JSON: an array of two, an object, an array that is cut off."""
    from lectern.sources.files import json_items

    array = F.to_json(F.array("text", "lang"))
    value = F.when(F.col("doc_id") % 3 == 0, array).when(F.col("doc_id") % 3 == 1, F.to_json(F.struct("text"))).otherwise(F.expr("substring(to_json(array(text, lang)), 1, length(to_json(array(text, lang))) - 1)"))
    items = json_items(docs(spark, d).select(F.lit("m").alias("mode"), F.col("doc_id").cast("string").alias("file"), F.lit(0).alias("mode_rank"), F.col("doc_id").cast("int").alias("file_rank"), value.alias("value")))
    by = items.groupBy("file").agg(F.max(F.when(F.col("pos") == 1, F.col("item"))).alias("first_item"), F.substring_index(F.max("error"), ":", 1).alias("error"), F.count(F.lit(1)).alias("n_rows"))
    return by.select(F.col("file").cast("long").alias("doc_id"), "first_item", "error", "n_rows")


@query("SELECT doc_id, source FROM documents WHERE trim(text) <> ''")
def filter_nonblank(spark, d):
    return docs(spark, d).where(text.trim_unicode(F.col("text")) != "").select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3')")
def filter_source_mode(spark, d):
    return docs(spark, d).where(F.col("source").isin("src1", "src3")).select("doc_id", "source")


# ---- text

TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
GAPPED = "regexp_replace(text, '[a-z]{7,}', '___', 'g')"


def gapped() -> Column:
    return F.regexp_replace("text", "[a-z]{7,}", "___")


@query(rf"""SELECT doc_id, {TRIM.format(r"regexp_replace(regexp_replace(text, '[\t\r\n\f]+', ' ', 'g'), '\s{2,}', ' ', 'g')")} AS normalized FROM documents""")
def text_normalize_space(spark, d):
    return docs(spark, d).select("doc_id", text.normalize_space(F.col("text")).alias("normalized"))


@query(rf"""SELECT doc_id, {TRIM.format(r"regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '[ \t]+', ' ', 'g')")} AS listening, {TRIM.format(r"regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g')")} AS speaking, {TRIM.format("replace(text, chr(13) || chr(10), chr(10))")} AS plain FROM documents""")
def text_normalize_compare(spark, d):
    t = F.col("text")
    return docs(spark, d).select("doc_id", text.normalize_lines(t).alias("listening"), text.normalize_lines(t, lone_cr=True).alias("speaking"), text.normalize_text(t).alias("plain"))


@query("SELECT doc_id, left(text, 40) AS preview FROM documents")
def text_preview(spark, d):
    return docs(spark, d).select("doc_id", text.preview(F.col("text")).alias("preview"))


@query(r"SELECT doc_id, replace(text, chr(10), '\n') AS literal FROM documents")
def text_literal_newline(spark, d):
    return docs(spark, d).select("doc_id", text.literal_newlines(F.col("text")).alias("literal"))


@query("SELECT doc_id, replace(text, ' ', chr(10)) AS lines FROM documents")
def text_unescape_newline(spark, d):
    """Every space is a line break in its two-character form."""
    return docs(spark, d).select("doc_id", text.real_newlines(F.replace("text", F.lit(" "), F.lit("\\n"))).alias("lines"))


@query(f"SELECT doc_id, CAST(len(regexp_extract_all({GAPPED}, '_{{2,}}')) AS INTEGER) AS gaps FROM documents")
def gap_count(spark, d):
    return docs(spark, d).select("doc_id", text.count_gaps(gapped()).alias("gaps"))


@query(f"SELECT doc_id, array_to_string(list_transform(parts, lambda x, i: CASE WHEN i < len(parts) THEN x || '_______(' || i || ')' ELSE x END), '') AS numbered FROM (SELECT doc_id, string_split_regex({GAPPED}, '_{{2,}}') AS parts FROM documents)")
def gap_number(spark, d):
    return docs(spark, d).select("doc_id", text.number_gaps(gapped()).alias("numbered"))


@query(r"SELECT doc_id, regexp_replace(text, '([a-z]{7,})', '<\1>', 'g') AS filled FROM documents")
def gap_fill(spark, d):
    """Long words are cut out and filled in again, in brackets."""
    words = F.transform(F.expr("regexp_extract_all(text, '([a-z]{7,})', 1)"), lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    return docs(spark, d).select("doc_id", text.fill_gaps(gapped(), words).alias("filled"))


@query("SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[a-z]{9,}'), lambda x, i: i || ':' || x), ' | ') AS answers FROM documents")
def array_enumerate_join(spark, d):
    return docs(spark, d).select("doc_id", text.enumerate_join(F.expr("regexp_extract_all(text, '([a-z]{9,})', 1)")).alias("answers"))


@query("SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, chr(10) || ' ')), lambda x: x <> ''), '#') AS parts FROM documents")
def array_transform_filter(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(text.nonempty(F.split("text", r"\.", -1)), "#").alias("parts"))


@query("SELECT conv_id, trim(string_agg(text, chr(10) ORDER BY turn), chr(10) || ' ') AS sentences FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def conv_join_sentences(spark, d):
    by = read(spark, d, "conversations").where("text is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return by.select("conv_id", text.join_sentences(F.col("t.text")).alias("sentences"))


@query("SELECT doc_id, CAST(len(string_split(joined, '|')) AS INTEGER) AS n, joined FROM (SELECT doc_id, array_to_string(string_split(text, ' '), '|') AS joined FROM documents)")
def split_join_roundtrip(spark, d):
    """Words as options; one with the separator in it comes back as two, as it does in the source format."""
    joined = text.join_options(F.split("text", " ", -1))
    return docs(spark, d).select("doc_id", F.size(text.split_options(joined)).alias("n"), joined.alias("joined"))


@query("SELECT doc_id, array_to_string(list_filter([CAST(doc_id % 3 AS VARCHAR), CASE WHEN doc_id % 5 > 0 THEN CAST(doc_id % 5 AS VARCHAR) ELSE '' END, 'false', lang, CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE '' END], lambda x: x <> ''), '|') AS options FROM documents")
def option_list(spark, d):
    """Options of mixed JSON types: numbers as strings and as numbers, where 0 counts as none, truth values as both, null."""
    number, flag = (F.col("doc_id") % 5).cast("string"), F.when(F.col("doc_id") % 2 == 0, "true").otherwise("false")
    listed = F.concat(F.lit('["'), (F.col("doc_id") % 3).cast("string"), F.lit('", '), number, F.lit(', "false", null, "'), "lang", F.lit('", '), flag, F.lit("]"))
    keyed = F.concat(F.lit('{"z": "'), (F.col("doc_id") % 3).cast("string"), F.lit('", "y": '), number, F.lit(', "x": "false", "w": null, "v": "'), "lang", F.lit('", "a": '), flag, F.lit("}"))
    return docs(spark, d).select("doc_id", text.join_options(text.option_list(F.when(F.col("doc_id") % 4 < 2, listed).otherwise(keyed))).alias("options"))


@query("SELECT doc_id, list_contains(opts, ans) AS found FROM (SELECT doc_id, string_split(text, ' ') AS opts, source AS ans FROM documents)")
def array_contains_check(spark, d):
    return docs(spark, d).select("doc_id", F.array_contains(F.split("text", " ", -1), F.col("source")).alias("found"))


@query("SELECT doc_id, array_to_string(list_distinct_ordered, '|') AS options FROM (SELECT doc_id, list_transform(list_filter(list_zip(o, range(1, len(o) + 1)), lambda p: list_position(o, p[1]) = p[2]), lambda p: p[1]) AS list_distinct_ordered FROM (SELECT doc_id, [lang, source, lang, 'en', source] AS o FROM documents))")
def array_distinct_append(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(text.append_distinct(F.array("lang", "source", "lang", F.lit("en")), F.col("source")), "|").alias("options"))


@query("""SELECT doc_id, CASE WHEN contains(f, '"') OR contains(f, ',') OR contains(f, chr(10)) OR contains(f, chr(13)) THEN '"' || replace(f, '"', '""') || '"' ELSE f END AS field, '"' || replace(f, '"', '""') || '"' AS quoted FROM (SELECT doc_id, text AS f FROM documents)""")
def csv_escape(spark, d):
    return docs(spark, d).select("doc_id", text.csv_field(F.col("text")).alias("field"), text.csv_field(F.col("text"), True).alias("quoted"))


@query("SELECT doc_id, 'Type: ' || upper(lang) || '. Level: ' || source || '.' AS explanation FROM documents")
def template_string(spark, d):
    return docs(spark, d).select("doc_id", text.explanation(F.upper("lang"), F.col("source")).alias("explanation"))


@query("SELECT doc_id, least(source, lang) || ' <-> ' || greatest(source, lang) AS pair FROM documents")
def pair_key(spark, d):
    return docs(spark, d).select("doc_id", text.sorted_pair(F.col("source"), F.col("lang")).alias("pair"))


@query("SELECT page_id, url AS audio_url, '' AS phonetic FROM pages")
def map_access(spark, d):
    made = read(spark, d, "pages").select("page_id", F.create_map(F.lit("audio_url"), F.coalesce("url", F.lit(""))).alias("metadata"))
    get = lambda k: F.coalesce(F.try_element_at("metadata", F.lit(k)), F.lit(""))
    return made.select("page_id", get("audio_url").alias("audio_url"), get("phonetic").alias("phonetic"))


@query("SELECT page_id, coalesce(url, '') AS audio_url FROM pages")
def map_construct(spark, d):
    return read(spark, d, "pages").select("page_id", F.element_at(F.create_map(F.lit("audio_url"), F.coalesce("url", F.lit(""))), "audio_url").alias("audio_url"))


# ---- URLs

HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
PATH = "lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1))"
ON_HOST, NAMED = f"contains({HOST}, 'example.com')", f"ends_with({PATH}, '.html')"


@query(f"SELECT page_id, {ON_HOST} AS on_host FROM pages")
def url_host_check(spark, d):
    return read(spark, d, "pages").select("page_id", urls.host_contains(F.col("url"), "example.com").alias("on_host"))


@query(f"SELECT page_id, {NAMED} AS named FROM pages")
def url_suffix_check(spark, d):
    return read(spark, d, "pages").select("page_id", urls.path_ends(F.col("url"), ".html").alias("named"))


@query(f"SELECT page_id, CASE WHEN NOT {ON_HOST} AND NOT {NAMED} THEN 'AUDIO_NOT_CLOUDINARY_AND_NOT_MP3' WHEN NOT {ON_HOST} THEN 'AUDIO_NOT_CLOUDINARY' WHEN NOT {NAMED} THEN 'AUDIO_NOT_MP3' END AS reason FROM pages")
def url_validate_reason(spark, d):
    return read(spark, d, "pages").select("page_id", urls.media_reason(F.col("url"), "example.com", ".html").alias("reason"))


# ---- enums


@query("""SELECT p_partkey, CASE WHEN contains(n, 'brand#1') THEN 'easy' WHEN contains(n, 'brand#2') THEN 'medium' WHEN contains(n, 'brand#3') OR contains(n, 'brand#4') THEN 'hard' ELSE 'medium' END AS difficulty, CASE WHEN contains(n, 'basic') OR contains(n, 'level1') THEN 'easy' WHEN contains(n, 'developing') OR contains(n, 'level2') THEN 'medium' WHEN contains(n, 'expanding') OR contains(n, 'level3') THEN 'hard' END AS course FROM (SELECT p_partkey, lower(p_brand) || '_level' || (p_partkey % 5) AS n FROM part)""")
def case_map_difficulty(spark, d):
    name = F.concat("p_brand", F.lit("_level"), (F.col("p_partkey") % 5).cast("string"))
    marks = (("easy", ("brand#1",)), ("medium", ("brand#2",)), ("hard", ("brand#3", "brand#4")))
    return read(spark, d, "part").select("p_partkey", enums.difficulty_of(name, marks, "medium").alias("difficulty"), enums.difficulty_of(name).alias("course"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN ['easy', 'medium', 'hard'][doc_id % 4 + 1] ELSE 'medium' END AS difficulty, CASE WHEN doc_id % 2 = 0 THEN 'VOCAB' ELSE upper(lang) END AS question_type FROM documents")
def normalize_enum_default(spark, d):
    raw = F.get(F.array(F.lit("\t Easy\n"), F.lit("MEDIUM\u00a0"), F.lit("hard"), F.lit("other")), (F.col("doc_id") % 4).cast("int"))
    kind = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat(F.lit(" "), "lang"))
    return docs(spark, d).select("doc_id", enums.normalize_difficulty(raw).alias("difficulty"), enums.question_type(kind, trimmed=True).alias("question_type"))


@query("SELECT c_custkey, c_nationkey * 5 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 2 WHEN 'MACHINERY' THEN 3 WHEN 'FURNITURE' THEN 4 WHEN 'HOUSEHOLD' THEN 5 ELSE 1 END AS node_id FROM customer")
def node_id_formula(spark, d):
    n = nodes(spark, d)
    return n.select(F.col("id").alias("c_custkey"), enums.node_id(F.col("skill_tree_id"), F.col("node_type")).alias("node_id"))


@query(STORE + "SELECT n.skill_tree_id AS tree_id, n.node_type, MAX(n.id) AS mapped_id FROM nodes n JOIN trees t ON n.skill_tree_id = t.id GROUP BY ALL")
def node_map_build(spark, d):
    return assign.node_map(nodes(spark, d), trees(spark, d))


PLACED = "placed AS (SELECT q.id, q.question_type, (q.id % 30) + 1 AS tree_id FROM q), mapping AS (SELECT skill_tree_id AS tree_id, node_type, MAX(id) AS mapped_id FROM nodes GROUP BY ALL)"


@query(STORE + f", {PLACED} SELECT p.id, coalesce(nullif(m.mapped_id, 0), (p.tree_id - 1) * 5 + CASE p.question_type WHEN 'LISTENING' THEN 2 WHEN 'SPEAKING' THEN 3 WHEN 'MATCHING' THEN 4 ELSE 1 END) AS node_id FROM placed p LEFT JOIN mapping m ON m.tree_id = p.tree_id AND m.node_type = p.question_type")
def node_id_lookup(spark, d):
    q, n, t = store(spark, d)
    placed = q.select("id", "question_type", (F.col("id") % 30 + 1).alias("tree_id"))
    return assign.with_node(placed, assign.node_map(n, t)).select("id", "node_id")


# ---- validation

FIRST_FAILURE = "CASE WHEN source = 'src3' THEN 'MISSING_AUDIO' WHEN n_chars < 300 THEN 'MISSING_ANSWERS' WHEN lang = 'fr' THEN 'ANSWER_COUNT_MISMATCH(gaps:' || (doc_id % 5) || ',answers:' || (doc_id % 7) || ')' END"


@query(f"SELECT doc_id, {FIRST_FAILURE} AS reason FROM documents")
def validate_first_failure(spark, d):
    mismatch = F.format_string("ANSWER_COUNT_MISMATCH(gaps:%d,answers:%d)", F.col("doc_id") % 5, F.col("doc_id") % 7)
    reason = extract.first_reason((F.col("source") == "src3", "MISSING_AUDIO"), (F.col("n_chars") < 300, "MISSING_ANSWERS"), (F.col("lang") == "fr", mismatch))
    return docs(spark, d).select("doc_id", reason.alias("reason"))


@query(f"SELECT split_part(reason, '(', 1) AS reason, COUNT(*) AS total FROM (SELECT {FIRST_FAILURE} AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY 1")
def reason_counts(spark, d):
    return extract.reason_counts(validate_first_failure(spark, d).where("reason is not null").withColumn("reason", F.substring_index("reason", "(", 1)))


@query("SELECT COUNT_IF(d = 'easy') AS easy, COUNT_IF(d = 'medium') AS medium, COUNT_IF(d = 'hard') AS hard FROM (SELECT ['easy', 'medium', 'hard'][n_chars % 3 + 1] AS d FROM documents)")
def summarize_by_difficulty(spark, d):
    level = F.get(F.array(*(F.lit(x) for x in enums.DIFFICULTIES)), (F.col("n_chars") % 3).cast("int"))
    return extract.difficulty_counts(docs(spark, d).select(level.alias("difficulty")))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 END AS level_id FROM documents WHERE lang IN ('en', 'de')")
def filter_by_enum(spark, d):
    level = F.when(F.col("lang") == "en", "easy").when(F.col("lang") == "de", "medium")
    return docs(spark, d).select("doc_id", enums.level_of(level).alias("level_id")).where("level_id is not null")


def id_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Matching items made from documents: lines split at the first space, some without a right side."""
    rows = docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    left, right = F.substring_index("line", " ", 1), F.substring_index("line", " ", -1)
    return rows.select("doc_id", F.col("pos").cast("int").alias("pos"), left.alias("left"), F.when(F.col("pos") % 3 < 2, right).otherwise("").alias("right"))


LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"


@query(f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, split_part(line, ' ', 1) AS \"left\" FROM {LINES}")
def explode_pairs(spark, d):
    return id_pairs(spark, d).select("doc_id", "pos", "left")


@query(f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, CASE WHEN split_part(line, ' ', 1) = '' OR pos % 3 = 2 THEN 'MISSING_LEFT_OR_RIGHT' END AS reason FROM {LINES}")
def explode_validate(spark, d):
    blank = (F.col("left") == "") | (F.col("right") == "")
    return id_pairs(spark, d).select("doc_id", "pos", extract.first_reason((blank, "MISSING_LEFT_OR_RIGHT")).alias("reason"))


@query(f"SELECT 'doc#' || (pos + 1) AS tag, COUNT(*) AS n FROM {LINES} GROUP BY 1")
def explode_index(spark, d):
    from lectern.sources.files import source_tag

    return id_pairs(spark, d).groupBy(source_tag(F.lit("doc"), F.col("pos") + 1).alias("tag")).agg(F.count(F.lit(1)).alias("n"))


# ---- first seen


@query("SELECT MIN(doc_id) AS doc_id, lower(text) AS key FROM documents GROUP BY lower(text)")
def dedupe_first_seen(spark, d):
    first, _ = firstseen.dedupe(docs(spark, d).withColumn("key", F.lower("text")), ["key"], "doc_id", {})
    return first.select("doc_id", "key")


@query("SELECT doc_id, first_id, first_source FROM (SELECT doc_id, MIN(doc_id) OVER (PARTITION BY lower(text)) AS first_id, FIRST_VALUE(source) OVER (PARTITION BY lower(text) ORDER BY doc_id) AS first_source FROM documents) WHERE doc_id <> first_id")
def duplicates_with_origin(spark, d):
    _, later = firstseen.dedupe(docs(spark, d).withColumn("key", F.lower("text")), ["key"], "doc_id", {"first_id": "doc_id", "first_source": "source"})
    return later.select("doc_id", "first_id", "first_source")


CLASH = "(SELECT event_id, user_id, event_type, FIRST_VALUE(event_type) OVER w AS first_type, FIRST_VALUE(event_id) OVER w AS first_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"


def clashes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return firstseen.conflicts(read(spark, d, "events").select("event_id", "user_id", "event_type"), "user_id", "event_type", "event_id", {"first_type": "event_type", "first_id": "event_id"})


@query(f"SELECT event_id, user_id, event_type, first_type, first_id FROM {CLASH} WHERE event_type <> first_type")
def conflict_first_seen(spark, d):
    return clashes(spark, d)[1]


PAIRS = f"(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, least(event_type, first_type), greatest(event_type, first_type) ORDER BY event_id) AS rn FROM {CLASH} WHERE event_type <> first_type)"


@query(f"SELECT 0 AS side, event_type AS own, first_type AS other, CAST(event_id AS VARCHAR) AS event FROM {PAIRS} WHERE rn = 1 UNION ALL SELECT 1, first_type, event_type, CAST(first_id AS VARCHAR) FROM {PAIRS} WHERE rn = 1")
def conflict_bidirectional(spark, d):
    once = firstseen.once_per_pair(clashes(spark, d)[1], "event_type", "first_type", "event_id", ["user_id"])
    a, b = (F.col("event_type"), F.col("first_type")), (F.col("first_type"), F.col("event_type"))
    side = lambda x, i: {"own": x[0], "other": x[1], "event": F.col(i)}
    return firstseen.both_ways(once, side(a, "event_id"), side(b, "first_id")).select("side", "own", "other", "event")


@query(f"SELECT COUNT(DISTINCT least(event_type, first_type) || ' <-> ' || greatest(event_type, first_type) || user_id) + (SELECT COUNT(*) FROM events WHERE value < 1) AS issues FROM {CLASH} WHERE event_type <> first_type")
def conflict_issue_count(spark, d):
    clash = clashes(spark, d)[1].select(F.lit("CONFLICT").alias("reason"), "event_type", "first_type", "user_id")
    other = read(spark, d, "events").where("value < 1").select(F.lit("LOW").alias("reason"), "event_type", F.lit("").alias("first_type"), "user_id")
    return extract.issue_count(clash.unionByName(other), "CONFLICT", "event_type", "first_type", ["user_id"])


# ---- consolidation, assignment, load


@query("""SELECT 'VOCAB' AS question_type, source AS sentence, lang AS options, '' AS answer, 'easy' AS difficulty, '' AS audio_url FROM documents UNION ALL SELECT 'LISTENING', text, '', role, 'medium', '' FROM conversations UNION ALL SELECT 'SPEAKING', url, '', '', 'hard', url FROM pages UNION ALL SELECT 'MATCHING', n_name, 'MATCHING_PAIR', CAST(n_nationkey AS VARCHAR), 'easy', '' FROM nation""")
def consolidate_union(spark, d):
    vocab = docs(spark, d).select(F.col("source").alias("sentence"), F.col("lang").alias("distractors"), F.lit("").alias("answer"), F.lit("easy").alias("difficulty"))
    listening = read(spark, d, "conversations").select(F.col("text").alias("gapped_text"), F.col("role").alias("answer"), F.lit("medium").alias("difficulty"))
    speaking = read(spark, d, "pages").select(F.col("url").alias("sentences"), F.col("url").alias("audio"), F.lit("hard").alias("difficulty"))
    matching = read(spark, d, "nation").select(F.col("n_name").alias("sentence_left"), F.col("n_nationkey").cast("string").alias("sentence_right"), F.lit("easy").alias("difficulty"))
    return consolidate.consolidate(spark, [("a_vocab.csv", vocab), ("Listening.csv", listening), ("speaking.csv", speaking), ("x_matching.csv", matching), ("other.csv", matching)])


@query(STORE + ", i AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY level_id ORDER BY id) - 1 AS i FROM q), r AS (SELECT id AS tree_id, level_id, ROW_NUMBER() OVER (PARTITION BY level_id ORDER BY id) - 1 AS rank, COUNT(*) OVER (PARTITION BY level_id) AS n FROM trees) SELECT i.id, i.level_id, i.node_id, i.question_type, r.tree_id FROM i JOIN r ON i.level_id = r.level_id AND i.i % r.n = r.rank")
def round_robin_assign(spark, d):
    q, _, t = store(spark, d)
    return assign.round_robin(q, t, ["id"]).select("id", "level_id", "node_id", "question_type", "tree_id")


LOADED = """WITH r AS (SELECT doc_id, text, lang, source, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
SELECT sha256(text) AS mongo_question_id, doc_id % 5 AS node_id, 1 AS level_id, upper(lang) AS question_type, source AS correct_answer FROM r WHERE rn = 1 AND text NOT IN (SELECT text FROM documents WHERE lang = 'de')"""


@query(LOADED)
def load_insert_new(spark, d):
    """The German documents are in the store already."""
    rows = docs(spark, d).select("doc_id", F.col("text").alias("sentence"), F.lit("a|b").alias("options"), F.col("source").alias("answer"), F.lit("easy").alias("difficulty"), F.col("lang").alias("question_type"), F.lit("").alias("audio_url"), (F.col("doc_id") % 5).alias("node_id"), F.lit(1).alias("level_id"))
    known = rows.where("question_type = 'de'")
    facts = known.select(load.question_doc_id("sentence").alias("mongo_question_id"))
    return load.load_new(rows, known.select(F.col("sentence").alias("question_text")), facts, ["doc_id"])[1]


@query("SELECT sha256(text) AS _id, explanation, CAST(n AS INTEGER) AS n_options, audio_url FROM (SELECT text, 'Type: ' || lang || '. Level: easy.' AS explanation, 2 AS n, '' AS audio_url, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def load_documents(spark, d):
    rows = docs(spark, d).select("doc_id", F.col("text").alias("sentence"), F.lit("a|b").alias("options"), F.lit("easy").alias("difficulty"), F.col("lang").alias("question_type"), F.lit(None).cast("string").alias("audio_url"))
    made = load.new_documents(load.first_per_sentence(rows, ["doc_id"]), spark.createDataFrame([], "question_text string"))
    return made.select("_id", "explanation", F.size("distractors").alias("n_options"), F.col("metadata")["audio_url"].alias("audio_url"))


@query("SELECT doc_id FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'de')")
def anti_join_new(spark, d):
    known = docs(spark, d).where("lang = 'de'").select("text")
    return docs(spark, d).join(known, "text", "left_anti").select("doc_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def anti_join_used(spark, d):
    used = read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, d, "orders").join(used, "o_orderkey", "left_anti").select("o_orderkey")


@query("SELECT o.o_orderkey AS id, coalesce(c.c_name, '') AS question_text, coalesce(c.c_mktsegment, '') AS audio_url FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o.o_custkey = c.c_custkey")
def enrich_left_join(spark, d):
    """Customers of one segment have no document and get defaults."""
    doc = read(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("question_text"), F.array("c_name").alias("distractors"), F.create_map(F.lit("audio_url"), "c_mktsegment").alias("metadata"))
    facts = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("mongo_question_id"), F.lit("x").alias("correct_answer"))
    return sample.enrich(facts.select("id"), facts, doc).select("id", "question_text", "audio_url")


# ---- joins and counts


@query(STORE + "SELECT n.id AS node_id, t.id AS tree_id, t.level_id FROM nodes n JOIN trees t ON n.skill_tree_id = t.id WHERE t.level_id = 1")
def join_node_tree(spark, d):
    joined = stats.nodes_with_level(nodes(spark, d), trees(spark, d)).where("level_id = 1")
    return joined.select(F.col("id").alias("node_id"), F.col("skill_tree_id").alias("tree_id"), "level_id")


@query(STORE + "SELECT COUNT(*) AS total FROM q")
def count_total(spark, d):
    return stats.count_total(questions(spark, d))


@query(STORE + "SELECT level_id, COUNT(*) AS total FROM q GROUP BY 1")
def count_by_level(spark, d):
    return stats.count_by(questions(spark, d), "level_id")


@query(STORE + "SELECT question_type, COUNT(*) AS total FROM q GROUP BY 1")
def count_by_type(spark, d):
    return stats.count_by(questions(spark, d), "question_type")


@query(STORE + "SELECT node_type, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id GROUP BY 1")
def count_by_node_type(spark, d):
    q, n, _ = store(spark, d)
    return stats.count_by_node_type(q, n)


@query(STORE + "SELECT level_id, question_type, COUNT(*) AS total FROM q GROUP BY 1, 2")
def count_type_by_level(spark, d):
    return stats.count_by(questions(spark, d), "level_id", "question_type")


@query(STORE + "SELECT level_id, node_type, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id GROUP BY 1, 2")
def count_node_type_by_level(spark, d):
    q, n, _ = store(spark, d)
    return stats.count_node_type_by_level(q, n)


@query(STORE + "SELECT level_id, skill, CAST(SUM(total) AS BIGINT) AS total FROM per_node GROUP BY 1, 2")
def skill_by_level_left_join(spark, d):
    q, n, t = store(spark, d)
    return stats.skill_by_level(q, n, t)


@query(STORE + "SELECT * FROM per_node")
def node_by_level_with_skill(spark, d):
    q, n, t = store(spark, d)
    return stats.node_by_level_with_skill(q, n, t)


@query(STORE + "SELECT node_type AS skill, question_type, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id GROUP BY 1, 2")
def skill_question_type(spark, d):
    q, n, _ = store(spark, d)
    return stats.skill_question_type(q, n)


@query(STORE + "SELECT node_id, COUNT(*) AS total FROM q GROUP BY 1 ORDER BY total DESC, node_id LIMIT 20")
def top_nodes(spark, d):
    return stats.top_nodes(questions(spark, d))


@query(STORE + "SELECT q.level_id, t.id AS tree_id, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id JOIN trees t ON n.skill_tree_id = t.id GROUP BY 1, 2")
def count_tree_by_level(spark, d):
    q, n, _ = store(spark, d)
    return stats.count_tree_by_level(q, n)


@query(STORE + "SELECT q.level_id, t.id AS tree_id, n.id AS node_id, n.title, n.node_type, MIN(n.order_index) AS order_index, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id JOIN trees t ON n.skill_tree_id = t.id GROUP BY 1, 2, 3, 4, 5")
def count_skill_in_tree(spark, d):
    return stats.count_skill_in_tree(*store(spark, d))


@query(STORE + "SELECT level_id, total, round(total * 100.0 / (SELECT COUNT(*) FROM q), 2) AS percent FROM (SELECT level_id, COUNT(*) AS total FROM q GROUP BY 1)")
def pct_of_total(spark, d):
    return stats.level_share(questions(spark, d))


@query(STORE + "SELECT 'Level ' || level_id || ' (' || CAST(round(total * 100.0 / (SELECT COUNT(*) FROM q), 2) AS VARCHAR) || '%)' AS label, total FROM (SELECT level_id, COUNT(*) AS total FROM q GROUP BY 1)")
def label_format(spark, d):
    return stats.charts(*store(spark, d))["question-by-level"]


@query(STORE + "SELECT level_id, CAST(SUM(CASE WHEN skill = 'VOCAB' THEN total ELSE 0 END) AS BIGINT) AS \"VOCAB\", CAST(SUM(CASE WHEN skill = 'LISTENING' THEN total ELSE 0 END) AS BIGINT) AS \"LISTENING\", CAST(SUM(CASE WHEN skill = 'MATCHING' THEN total ELSE 0 END) AS BIGINT) AS \"MATCHING\" FROM per_node GROUP BY 1")
def pivot_skill_level(spark, d):
    q, n, t = store(spark, d)
    return stats.skill_pivot(stats.skill_by_level(q, n, t), ["VOCAB", "LISTENING", "MATCHING"])


@query(STORE + "SELECT l.level_id, s.skill, round(coalesce(c.total, 0) * 100.0 / l.base, 2) AS percent FROM (SELECT level_id, COUNT(*) AS base FROM q GROUP BY 1) l CROSS JOIN (SELECT DISTINCT skill FROM per_node WHERE skill <> 'REVIEW') s LEFT JOIN (SELECT level_id, skill, SUM(total) AS total FROM per_node GROUP BY 1, 2) c ON c.level_id = l.level_id AND c.skill = s.skill")
def skill_ratio_by_level(spark, d):
    q, n, t = store(spark, d)
    return stats.skill_ratio(q, n, t)


@query(STORE + "SELECT skill, MIN(total) AS min, round(median(total), 2) AS median, MAX(total) AS max, round(stddev_pop(total), 2) AS std, round(avg(total), 2) AS mean, round(CASE WHEN avg(total) > 0 THEN stddev_pop(total) / avg(total) ELSE 0 END, 4) AS balance_score FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1")
def balance_by_skill(spark, d):
    q, n, t = store(spark, d)
    return stats.balance_by_skill(stats.node_by_level_with_skill(q, n, t))


@query(STORE + "SELECT l.level_id, coalesce(round(CASE WHEN s.mean > 0 THEN s.std / s.mean ELSE 0 END, 4), 0) AS balance_score FROM (SELECT DISTINCT level_id FROM q) l LEFT JOIN (SELECT level_id, avg(total) AS mean, stddev_pop(total) AS std FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1) s ON s.level_id = l.level_id")
def balance_by_level(spark, d):
    q, n, t = store(spark, d)
    return stats.balance_by_level(stats.node_by_level_with_skill(q, n, t), q.select("level_id").distinct())


@query(STORE + "SELECT level_id, COUNT(*) AS total_nodes, round(COUNT_IF(total > 1) * 100.0 / COUNT(*), 2) AS above_lower_bound_percent, round(COUNT_IF(total < 3) * 100.0 / COUNT(*), 2) AS below_upper_bound_percent FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1")
def node_coverage(spark, d):
    q, n, t = store(spark, d)
    return stats.node_coverage(stats.node_by_level_with_skill(q, n, t), q.select("level_id").distinct(), 1, 3)


@query(STORE + "SELECT level_id, 'Node ' || node_id || ' - ' || skill AS label, total, order_index FROM per_node WHERE skill <> 'REVIEW'")
def chart_node_distribution(spark, d):
    q, n, t = store(spark, d)
    return stats.charts(q, n, t)["node-distribution"]


@query(STORE + "SELECT node_type || ' - ' || question_type AS label, COUNT(*) AS total FROM q JOIN nodes n ON q.node_id = n.id WHERE node_type <> 'REVIEW' GROUP BY 1")
def chart_skill_question_type(spark, d):
    return stats.charts(*store(spark, d))["skill-x-question-type"]


@query(STORE + "SELECT l.level_id, s.skill, round(coalesce(c.total, 0) * 100.0 / l.base, 2) AS percent FROM (SELECT level_id, COUNT(*) AS base FROM q GROUP BY 1) l CROSS JOIN (SELECT DISTINCT skill FROM per_node WHERE skill <> 'REVIEW') s LEFT JOIN (SELECT level_id, skill, SUM(total) AS total FROM per_node GROUP BY 1, 2) c ON c.level_id = l.level_id AND c.skill = s.skill")
def chart_skill_ratio(spark, d):
    return stats.charts(*store(spark, d))["skill-ratio-by-level"]


@query(STORE + "SELECT skill, MIN(total) AS min, round(median(total), 2) AS median, MAX(total) AS max, round(stddev_pop(total), 2) AS std, round(avg(total), 2) AS mean, round(CASE WHEN avg(total) > 0 THEN stddev_pop(total) / avg(total) ELSE 0 END, 4) AS balance_score FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1")
def chart_node_balance(spark, d):
    return stats.charts(*store(spark, d))["node-balance-by-skill"]


@query(STORE + "SELECT l.level_id, coalesce(n, 0) AS total_nodes, coalesce(above, 0) AS above_lower_bound_percent, coalesce(below, 0) AS below_upper_bound_percent FROM (SELECT DISTINCT level_id FROM q) l LEFT JOIN (SELECT level_id, COUNT(*) AS n, round(COUNT_IF(total > 100) * 100.0 / COUNT(*), 2) AS above, round(COUNT_IF(total < 1000) * 100.0 / COUNT(*), 2) AS below FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1) c ON c.level_id = l.level_id")
def chart_node_coverage(spark, d):
    return stats.charts(*store(spark, d))["node-coverage-by-level"]


@query(STORE + "SELECT l.level_id, coalesce(round(CASE WHEN s.mean > 0 THEN s.std / s.mean ELSE 0 END, 4), 0) AS balance_score FROM (SELECT DISTINCT level_id FROM q) l LEFT JOIN (SELECT level_id, avg(total) AS mean, stddev_pop(total) AS std FROM per_node WHERE skill <> 'REVIEW' GROUP BY 1) s ON s.level_id = l.level_id")
def chart_balance_score(spark, d):
    return stats.charts(*store(spark, d))["balance-score-by-level"]


# ---- sampling and export

PLACED_NODES = STORE + """, placed AS (SELECT n.*, t.level_id FROM nodes n JOIN trees t ON n.skill_tree_id = t.id),
drawn AS (SELECT tree_id, node_id, node_type, id, question_type, level_id, rn FROM (SELECT p.skill_tree_id AS tree_id, p.id AS node_id, p.node_type, q.id, q.question_type, q.level_id, ROW_NUMBER() OVER (PARTITION BY p.id ORDER BY md5(q.id || '#s'), q.id) AS rn FROM q JOIN placed p ON q.node_id = p.id AND q.level_id = p.level_id WHERE p.node_type <> 'REVIEW') WHERE rn <= CASE WHEN node_type IN ('LISTENING', 'SPEAKING') THEN 1 ELSE 10 END),
target AS (SELECT skill_tree_id AS tree_id, level_id, id AS node_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY skill_tree_id ORDER BY order_index, id) AS place FROM placed WHERE node_type = 'REVIEW') WHERE place = 1),
gate AS (SELECT DISTINCT tree_id, node_type AS question_type FROM drawn),
review AS (SELECT tree_id, node_id, 'REVIEW' AS node_type, id, question_type, level_id, rn FROM (SELECT t.tree_id, t.node_id, q.id, q.question_type, q.level_id, ROW_NUMBER() OVER (PARTITION BY t.tree_id, q.question_type ORDER BY md5(q.id || '#s'), q.id) AS rn FROM target t JOIN gate g ON g.tree_id = t.tree_id JOIN q ON q.level_id = t.level_id AND q.question_type = g.question_type WHERE NOT EXISTS (SELECT 1 FROM drawn d WHERE d.tree_id = t.tree_id AND d.id = q.id)) WHERE rn <= CASE WHEN question_type IN ('VOCAB', 'MATCHING') THEN 4 ELSE 1 END),
exam AS (SELECT * FROM drawn UNION ALL SELECT * FROM review),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY node_id ORDER BY CASE WHEN node_type = 'REVIEW' THEN list_position(['VOCAB', 'MATCHING', 'LISTENING', 'SPEAKING'], question_type) ELSE 0 END, rn) AS number FROM exam)
"""


def drawn(spark: SparkSession, d: str, seed: str = "s") -> DataFrame:
    return sample.exam(*store(spark, d), seed)


@query(PLACED_NODES + "SELECT tree_id, node_id, node_type, id, question_type, level_id, CAST(rn AS INTEGER) AS rn FROM drawn")
def sample_per_node(spark, d):
    return drawn(spark, d).where("node_type <> 'REVIEW'")


@query(PLACED_NODES + "SELECT tree_id, node_id, node_type, id, question_type, level_id, CAST(rn AS INTEGER) AS rn FROM review")
def sample_review(spark, d):
    return drawn(spark, d).where("node_type = 'REVIEW'")


@query(PLACED_NODES + "SELECT 1 - COUNT(DISTINCT id) / COUNT(*) AS duplicate_rate FROM exam")
def duplicate_rate(spark, d):
    return sample.duplicate_rate(drawn(spark, d))


@query(PLACED_NODES + "SELECT p.skill_tree_id AS tree_id, COUNT(DISTINCT p.id) AS nodes, COUNT(e.id) AS questions FROM placed p LEFT JOIN exam e ON e.node_id = p.id WHERE p.node_type <> 'REVIEW' OR p.id IN (SELECT node_id FROM target) GROUP BY 1")
def exam_nested(spark, d):
    _, n, t = store(spark, d)
    exams = sample.nested(sample.with_empty_nodes(drawn(spark, d), n, t), ["id"])
    size = F.aggregate("nodes", F.lit(0).cast("long"), lambda a, x: a + F.size(x["questions"]))
    return exams.select("tree_id", F.size("nodes").cast("long").alias("nodes"), size.alias("questions"))


@query(PLACED_NODES + "SELECT tree_id, node_id, node_type, question_type, CAST(rn AS INTEGER) AS rn, id FROM exam")
def exam_flatten(spark, d):
    return sample.flattened(sample.nested(drawn(spark, d), ["id"]))


@query(PLACED_NODES + "SELECT node_id, id, CAST(number AS INTEGER) AS number FROM numbered")
def number_within_group(spark, d):
    return export.numbered(drawn(spark, d)).select("node_id", "id", "number")


@query(STORE + "SELECT id AS tree_id, CAST(ROW_NUMBER() OVER (ORDER BY level_id, order_index, id) AS INTEGER) AS tree_number FROM trees")
def global_rank(spark, d):
    return trees(spark, d).select(F.col("id").alias("tree_id"), F.row_number().over(W.orderBy("level_id", "order_index", "id")).alias("tree_number"))  # a few dozen trees


SHUFFLED = """WITH given AS (SELECT c_custkey AS id, c_mktsegment AS answer, unnest([c_name, 'x', 'y', 'z']) AS v FROM customer),
others AS (SELECT id, v, ROW_NUMBER() OVER (PARTITION BY id ORDER BY md5(id || v || '#s'), v) AS place FROM given WHERE v <> answer),
kept AS (SELECT id, v FROM others WHERE place < 4 UNION ALL SELECT c_custkey, c_mktsegment FROM customer),
shown AS (SELECT id, v, ROW_NUMBER() OVER (PARTITION BY id ORDER BY md5(id || v || '!#s'), v) AS place FROM kept)
SELECT c.c_custkey, string_agg(s.v, '|' ORDER BY s.place) AS options, ['A', 'B', 'C', 'D'][MAX(CASE WHEN s.v = c.c_mktsegment THEN s.place END)] AS letter FROM customer c JOIN shown s ON s.id = c.c_custkey GROUP BY 1"""


@query(SHUFFLED)
def shuffle_options(spark, d):
    opts = F.array("c_name", "c_mktsegment", F.lit("x"), F.lit("y"), F.lit("z"))
    rows = read(spark, d, "customer").withColumn("options", export.shuffled_options(opts, F.col("c_mktsegment"), F.col("c_custkey"), "s"))
    return rows.select("c_custkey", F.array_join("options", "|").alias("options"), export.answer_letter(F.col("options"), F.col("c_mktsegment")).alias("letter"))


SHEETS = PLACED_NODES.rstrip() + """, asked AS (SELECT x.*, o.o_orderpriority AS answer, c.c_name AS question, c.c_mktsegment AS segment FROM numbered x JOIN orders o ON o.o_orderkey = x.id JOIN customer c ON c.c_custkey = o.o_custkey),
options AS (SELECT node_id, id, answer, v, ROW_NUMBER() OVER (PARTITION BY node_id, id ORDER BY md5(id || v || '!#s'), v) AS place FROM (SELECT node_id, id, answer, unnest([question, segment, answer]) AS v FROM asked WHERE question_type = 'VOCAB')),
listed AS (SELECT node_id, id, string_agg(['A', 'B', 'C'][place] || '. ' || v, chr(10) ORDER BY place) AS lines, ['A', 'B', 'C'][MAX(CASE WHEN v = answer THEN place END)] AS letter FROM options GROUP BY 1, 2),
blocks AS (SELECT a.node_id, a.number, CASE
    WHEN question_type = 'VOCAB' THEN 'Q' || number || ': ' || question || chr(10) || lines || chr(10) || 'Answer: ' || letter || chr(10) || chr(10)
    WHEN question_type = 'LISTENING' OR (question_type = 'MATCHING' AND node_type = 'REVIEW') THEN 'Q' || number || ': ' || question || chr(10) || 'Answer: ' || answer || chr(10) || chr(10)
    WHEN question_type = 'MATCHING' THEN number || '. ' || question || ' -> ' || answer || chr(10)
    WHEN question_type = 'SPEAKING' THEN 'Q' || number || ': [Speaking] ' || question || chr(10) || answer || chr(10) || chr(10) END AS block FROM asked a LEFT JOIN listed l ON l.node_id = a.node_id AND l.id = a.id),
bodies AS (SELECT node_id, string_agg(block, '' ORDER BY number) AS body FROM blocks GROUP BY 1),
parts AS (SELECT p.skill_tree_id AS tree_id, p.id, p.order_index, p.node_type, 'NODE ' || p.node_type || chr(10) || chr(10) || coalesce(b.body, '') || chr(10) || chr(10) AS part FROM placed p LEFT JOIN bodies b ON b.node_id = p.id WHERE p.node_type <> 'REVIEW' OR p.id IN (SELECT node_id FROM target)),
whole AS (SELECT tree_id, string_agg(part, '' ORDER BY node_type = 'REVIEW', order_index, id) AS body FROM parts GROUP BY 1)
SELECT t.level_id, CAST(ROW_NUMBER() OVER (ORDER BY t.level_id, t.order_index, t.id) AS INTEGER) AS tree_number, t.id AS tree_id, 'TREE ' || t.id || chr(10) || repeat('=', 36) || chr(10) || chr(10) || coalesce(w.body, '') AS content FROM trees t LEFT JOIN whole w ON w.tree_id = t.id"""


@query(SHEETS)
def exam_sheets(spark, d):
    q, n, t = store(spark, d)
    facts = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("mongo_question_id"), F.col("o_orderpriority").alias("correct_answer"))
    doc = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("question_text"), F.array("c_name", "c_mktsegment").alias("distractors"), F.create_map(F.lit("audio_url"), F.lit("")).alias("metadata"))
    return export.sheets(sample.with_empty_nodes(sample.enrich(drawn(spark, d), facts, doc), n, t), t, "s")


MEASURED = "(SELECT CAST(l_linenumber AS INTEGER) AS level, CAST(l_suppkey % 4 AS INTEGER) AS runs, l_quantity > 5 AS ok, CASE WHEN l_quantity > 5 THEN l_quantity END AS ms, CASE WHEN l_quantity > 5 THEN l_discount END AS duplicate FROM lineitem)"


@query(f"SELECT runs, level, COUNT_IF(ok) AS success, round(coalesce(avg(ms), 0), 2) AS avg_time, 50 AS avg_iteration, round(coalesce(avg(duplicate), 0) * 100, 2) AS avg_duplicate, round(coalesce(stddev_pop(ms), 0), 4) AS std_dev FROM {MEASURED} GROUP BY 1, 2")
def report_runs(spark, d):
    ok = F.col("l_quantity") > 5
    rows = read(spark, d, "lineitem").select(F.col("l_linenumber").cast("int").alias("level"), (F.col("l_suppkey") % 4).cast("int").alias("runs"), ok.alias("ok"), F.when(ok, F.col("l_quantity")).alias("ms"), F.when(ok, F.col("l_discount")).alias("duplicate"))
    return report.summarize(rows)


@query("SELECT '=== KHONG_CO_CAU_NAO_CAN_REVIEW ===,medium' AS line WHERE NOT EXISTS (SELECT 1 FROM documents WHERE text IS NULL) UNION ALL SELECT source || ',' || lang FROM documents WHERE text IS NULL")
def sink_sentinel(spark, d):
    """Documents without a text are the rejects."""
    rejects = docs(spark, d).where("text is null").select(F.col("source").alias("reason"), F.col("lang").alias("difficulty"))
    return sinks.csv_lines(sinks.or_sentinel(rejects, ["reason", "difficulty"], sinks.NOTHING_TO_REVIEW, "reason"), ["reason", "difficulty"]).select("line")


@query("""SELECT '"' || source || '","' || replace(text, '"', '""') || '",' || lang AS line FROM documents""")
def sink_quoted(spark, d):
    """The two sides of a pair are always quoted, the level isn't."""
    return sinks.csv_lines(docs(spark, d), ["source", "text", "lang"], ("source", "text")).select("line")
