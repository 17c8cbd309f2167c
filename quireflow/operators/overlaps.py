"""Overlapping boxes of detections: greedy suppression by score, and boxes that lie within larger ones. Boxes are columns x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.tables import Tables

#: Side of the cells that boxes are dealt to, in pixels: a page has few, so that most boxes are shuffled once, and only boxes of one cell are compared.
CELL = 1024


def _area(p: str) -> Column:
    side = lambda a, z: F.greatest((F.col(f"{p}{z}") - F.col(f"{p}{a}")).cast("long"), F.lit(0))
    return side("x1", "x2") * side("y1", "y2")


def overlapping(boxes: DataFrame, doc: str, idx: str, extra: list[str], cell: int = CELL) -> DataFrame:
    """doc, and for two boxes that share an area a_ and b_ of idx and the columns ``extra``, with ``common``, ``a_area`` and ``b_area``; each pair both ways round.

    A box is dealt to the cells that it covers, so only boxes of one cell meet. A pair is taken in the cell of the corner where
    what they share begins, which both cover, and nowhere else. Empty boxes and rows with nulls in the key or the box have none.
    """
    at = lambda c: F.floor(c / F.lit(cell)).cast("long")
    whole = boxes.where("x2 > x1 AND y2 > y1")
    cells = F.explode(F.sequence(at(F.col("x1")), at(F.col("x2") - 1)))
    cols = list(dict.fromkeys(["x1", "y1", "x2", "y2", idx, *extra]))
    side = whole.select(doc, *cols).withColumn("_cx", cells).withColumn("_cy", F.explode(F.sequence(at(F.col("y1")), at(F.col("y2") - 1))))
    low = lambda c: F.greatest(f"a_{c}", f"b_{c}")
    high = lambda c: F.least(f"a_{c}", f"b_{c}")
    # both sides are one frame, names and all, so that it is shuffled once
    of = lambda p, c: F.col(f"{p}.`{c}`")
    same = (of("a", doc) == of("b", doc)) & (of("a", "_cx") == of("b", "_cx")) & (of("a", "_cy") == of("b", "_cy")) & (of("a", idx) != of("b", idx))
    # no broadcast: a table's size tells nothing of the cells that its boxes cover
    met = side.alias("a").join(side.alias("b").hint("merge"), same).select(of("a", doc).alias(doc), of("a", "_cx").alias("a_cx"), of("a", "_cy").alias("a_cy"), *(of(p, c).alias(f"{p}_{c}") for p in "ab" for c in cols))
    here = (at(low("x1")) == F.col("a_cx")) & (at(low("y1")) == F.col("a_cy"))
    met = met.where((low("x1") < high("x2")) & (low("y1") < high("y2")) & here)
    common = (high("x2") - low("x1")).cast("long") * (high("y2") - low("y1"))
    return met.select(doc, *(F.col(f"{p}{c}") for p in ("a_", "b_") for c in dict.fromkeys([idx, *extra])), common.alias("common"), _area("a_").alias("a_area"), _area("b_").alias("b_area"))


def suppress(boxes: DataFrame, doc: str, idx: str, score: str, least: float = 0.5, tables: Tables | None = None) -> DataFrame:
    """Boxes that greedy suppression keeps: by falling score (then by idx), one goes if an earlier one that stays covers it by an intersection over union above ``least``.

    Each round keeps the boxes that no box which is still open may drop, and drops what these cover; only conflicting pairs are
    looked at, and they become fewer with each round. A null score is lower than any. idx is unique in its doc.
    """
    tables = tables or Tables(boxes.sparkSession, "suppress")
    worth = lambda p: F.coalesce(F.col(f"{p}{score}").cast("double"), F.lit(float("-inf")))
    pairs = overlapping(boxes, doc, idx, [score])
    first = (worth("a_") > worth("b_")) | ((worth("a_") == worth("b_")) & (F.col(f"a_{idx}") < F.col(f"b_{idx}")))
    hit = pairs.where(first & (F.col("common") > F.lit(least) * (F.col("a_area") + F.col("b_area") - F.col("common"))))
    open_ = tables.cut(hit.select(F.col(doc).alias("d"), F.col(f"a_{idx}").alias("hi"), F.col(f"b_{idx}").alias("lo")), "pairs")
    gone: list[DataFrame] = []
    while open_.take(1):
        weak = open_.select("d", F.col("lo").alias("hi")).distinct()
        free = open_.join(weak, ["d", "hi"], "left_anti")
        gone.append(tables.cut(free.select("d", "lo").distinct(), f"gone{len(gone)}"))
        left = open_.join(gone[-1], ["d", "lo"], "left_anti").join(gone[-1].withColumnRenamed("lo", "hi"), ["d", "hi"], "left_anti")
        open_ = tables.cut(left.select("d", "hi", "lo"), f"pairs{len(gone)}")
    out = boxes
    for g in gone:
        own = g.select(F.col("d").alias("_d"), F.col("lo").alias("_lo"))
        out = out.join(own, (F.col(doc) == F.col("_d")) & (F.col(idx) == F.col("_lo")), "left_anti")
    return out


def keep_containers(boxes: DataFrame, doc: str, idx: str, share: float = 0.9) -> DataFrame:
    """Boxes without those of which ``share`` or more lies within one other, larger box ("large": the container stays). Of equal boxes the one with the smallest idx stays."""
    pairs = overlapping(boxes, doc, idx, [])
    larger = (F.col("a_area") > F.col("b_area")) | ((F.col("a_area") == F.col("b_area")) & (F.col(f"a_{idx}") < F.col(f"b_{idx}")))
    inner = pairs.where(larger & (F.col("common") >= F.lit(share) * F.col("b_area"))).select(F.col(doc).alias("_d"), F.col(f"b_{idx}").alias("_i")).distinct()
    return boxes.join(inner, (F.col(doc) == F.col("_d")) & (F.col(idx) == F.col("_i")), "left_anti")


#: Ways to settle overlaps of a page's boxes.
MODES = ["none", "large", "score"]


def settle(boxes: DataFrame, doc: str, idx: str, score: str, mode: str, tables: Tables | None = None) -> DataFrame:
    """Boxes after one of MODES; an unknown one raises."""
    if mode not in MODES:
        raise ValueError(f"no such way to settle overlaps: {mode}")
    return boxes if mode == "none" else keep_containers(boxes, doc, idx) if mode == "large" else suppress(boxes, doc, idx, score, tables=tables)
