"""The driver's tables seen as the question store, for the registered queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: customer segment -> node type; order priority -> question type; order status -> level
SEGMENTS = {"BUILDING": "VOCAB", "AUTOMOBILE": "LISTENING", "MACHINERY": "SPEAKING", "FURNITURE": "MATCHING", "HOUSEHOLD": "REVIEW"}
PRIORITIES = {"1-URGENT": "VOCAB", "2-HIGH": "LISTENING", "3-MEDIUM": "SPEAKING", "4-NOT SPECIFIED": "MATCHING", "5-LOW": "VOCAB"}
STATUSES = {"F": 1, "O": 2, "P": 3}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(column: str, values: dict) -> F.Column:
    out = None
    for k, v in values.items():
        out = F.when(F.col(column) == k, v) if out is None else out.when(F.col(column) == k, v)
    return out


def questions(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("node_id"), choose("o_orderstatus", STATUSES).alias("level_id"), choose("o_orderpriority", PRIORITIES).alias("question_type"))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") + 1).alias("skill_tree_id"), F.col("c_name").alias("title"), choose("c_mktsegment", SEGMENTS).alias("node_type"), (F.col("c_custkey") % 7).alias("order_index"))


def trees(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "nation").select((F.col("n_nationkey") + 1).alias("id"), (F.col("n_regionkey") % 3 + 1).alias("level_id"), F.col("n_nationkey").alias("order_index"))


def case(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v if isinstance(v, int) else repr(v)}" for k, v in values.items()) + " END"


#: The same three tables for DuckDB.
STORE = f"""WITH q AS (SELECT o_orderkey AS id, o_custkey AS node_id, {case("o_orderstatus", STATUSES)} AS level_id, {case("o_orderpriority", PRIORITIES)} AS question_type FROM orders),
nodes AS (SELECT c_custkey AS id, c_nationkey + 1 AS skill_tree_id, c_name AS title, {case("c_mktsegment", SEGMENTS)} AS node_type, c_custkey % 7 AS order_index FROM customer),
trees AS (SELECT n_nationkey + 1 AS id, n_regionkey % 3 + 1 AS level_id, n_nationkey AS order_index FROM nation),
per_node AS (SELECT t.level_id, n.id AS node_id, n.title, n.node_type AS skill, n.order_index, COUNT(f.id) AS total FROM nodes n JOIN trees t ON n.skill_tree_id = t.id LEFT JOIN q f ON f.node_id = n.id GROUP BY ALL)
"""
