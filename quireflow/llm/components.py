"""Connected components by repeated contraction: each round every vertex moves to its smallest neighbour, until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, root) for every vertex of edges (a, b), two longs; root is the smallest vertex of its component.

    A round's map is smaller than the one before, as every vertex with an edge moves unless it is smallest among its
    neighbours. The rounds' maps are applied one after the other at the end.
    """
    now = scratch.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    vertices = now.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("root", F.col("v"))
    maps: list[DataFrame] = []
    while now.take(1):
        both = now.select(F.col("a").alias("v"), F.col("b").alias("to")).unionByName(now.select(F.col("b").alias("v"), F.col("a").alias("to")))
        step = scratch.cut(both.groupBy("v").agg(F.min("to").alias("to")).where("to < v"), f"map{len(maps)}")
        maps.append(step)
        for side in ("a", "b"):
            moved = step.select(F.col("v").alias("_v"), F.col("to").alias("_to"))
            now = now.join(moved, F.col(side) == F.col("_v"), "left").withColumn(side, F.coalesce("_to", side)).drop("_v", "_to")
        now = scratch.cut(now.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"edges{len(maps)}")
    for step in maps:
        moved = step.select(F.col("v").alias("_v"), F.col("to").alias("_to"))
        vertices = vertices.join(moved, F.col("root") == F.col("_v"), "left").withColumn("root", F.coalesce("_to", "root")).drop("_v", "_to")
    return scratch.cut(vertices, "components")
