"""Views that the registered queries read, in SQL that Spark and other engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT = """
SELECT o_custkey AS page, o_orderkey AS region, CAST((o_orderkey * 37) % 900 AS INT) AS x1, CAST((o_orderkey * 53) % 1500 AS INT) AS y1,
  CAST((o_orderkey * 37) % 900 + 20 + (o_orderkey * 17) % 260 AS INT) AS x2, CAST((o_orderkey * 53) % 1500 + 10 + (o_orderkey * 29) % 200 AS INT) AS y2,
  CASE o_orderkey % 6 WHEN 0 THEN 'title' WHEN 1 THEN 'header' WHEN 2 THEN 'advert' WHEN 3 THEN 'text' WHEN 4 THEN 'region' ELSE 'table' END AS label,
  CAST(o_orderkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence
FROM orders
"""
FRAGS = """
SELECT conv_id, turn, text, CAST((turn % 2) * 350 + (conv_id % 7) * 10 AS INT) AS x1, CAST(floor(turn / 2) * 120 AS INT) AS y1,
  CAST((turn % 2) * 350 + (conv_id % 7) * 10 + 300 AS INT) AS x2, CAST(floor(turn / 2) * 120 + 100 AS INT) AS y2
FROM conversations
"""
# each turn as two fragments, one under the other, that together are all of it: most first halves end open
HALVES = """
SELECT conv_id, CAST(2 * turn + part AS BIGINT) AS turn, CASE part WHEN 0 THEN left(text, CAST(floor(length(text) / 2) AS INT)) ELSE substr(text, CAST(floor(length(text) / 2) AS INT) + 1) END AS text,
  CAST((turn % 2) * 350 + (conv_id % 7) * 10 AS INT) AS x1, CAST(floor(turn / 2) * 120 + part * 60 AS INT) AS y1,
  CAST((turn % 2) * 350 + (conv_id % 7) * 10 + 300 AS INT) AS x2, CAST(floor(turn / 2) * 120 + part * 60 + 50 AS INT) AS y2
FROM conversations CROSS JOIN (SELECT 0 AS part UNION ALL SELECT 1 AS part) AS parts
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LAYOUT.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


def frags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as text boxes, in SQL as FRAGS."""
    x, y = (F.col("turn") % 2) * 350 + (F.col("conv_id") % 7) * 10, F.floor(F.col("turn") / 2) * 120
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", *[c.cast("int").alias(n) for n, c in (("x1", x), ("y1", y), ("x2", x + 300), ("y2", y + 100))])


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of each turn as text boxes, in SQL as HALVES."""
    half, x = F.floor(F.length("text") / 2).cast("int"), (F.col("turn") % 2) * 350 + (F.col("conv_id") % 7) * 10
    y = F.floor(F.col("turn") / 2) * 120 + F.col("part") * 60
    text = F.when(F.col("part") == 0, F.left("text", half)).otherwise(F.substr("text", half + 1))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    return rows.select("conv_id", (F.col("turn") * 2 + F.col("part")).cast("long").alias("turn"), text.alias("text"), *[c.cast("int").alias(n) for n, c in (("x1", x), ("y1", y), ("x2", x + 300), ("y2", y + 50))])
