"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the keys are split into equal ranges, as many as the number of
documents asks for, the ranges' sizes are summed up to prefix sums, and only the one range in which the source's budget
runs out is sorted row by row: that gives the key at which the source is cut and how many words of the document there are
still due. Applying it needs one row per source. A target above the source's size takes the whole source once (or more)
before the cut: those are its epochs.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the last in order; a null
doc_id is keyed like any other; repeated rows have equal keys and share what is due at the cut evenly; an empty table
gives an empty result. Other columns go through unchanged, also when named like this module's results, which replace them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, n_words, row_count

#: Above so many sources the per-source cuts are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 100_000
#: Documents of a source that one key range holds at most, about, and bits of a key that tell its range at least and at most.
PER_RANGE, LEAST_BITS, MOST_BITS = 50_000, 8, 28


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) with target: each source's weight's part of ``share`` of all words, at most ``most`` times its own size.

    What capped sources leave is shared by weight again. Sorted by size over weight, the capped ones come first, so one
    running sum finds them; this is the fixed point of resharing until no source is above its cap.
    """
    by_name, every = Window.orderBy(F.col("source").isNull(), "source"), Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    df = sizes.withColumn("_w", w).withColumn("_due", F.lit(share) * F.sum("source_size").over(every))
    order = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").isNull(), "source")
    df = df.withColumn("_caps", F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    df = df.withColumn("_left", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    capped = F.lit(most) * F.col("source_size") * F.col("_left") <= F.col("_w") * (F.col("_due") - F.col("_caps"))
    df = df.withColumn("_level", F.when(~capped, (F.col("_due") - F.col("_caps")) / F.col("_left")))
    level = F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("_level", level).select("source", "source_size", F.coalesce(F.when(~capped, F.col("_w") * F.col("_level")), F.lit(most) * F.col("source_size")).alias("target"))


def range_bits(rows: int) -> int:
    """So many bits that a range of keys holds PER_RANGE rows at most, about, even if one source has them all."""
    return min(MOST_BITS, max(LEAST_BITS, (rows // PER_RANGE).bit_length()))


def _planned(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    """doc (a struct of docs' columns) with size, source_size, target, taken and copies."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    # the columns in a struct, so that no name of theirs can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    sized = whole.withColumn("source", F.col("doc.source")).withColumn("size", n_words(F.col("doc.text")))
    sized = sized.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("null")), F.col("size").cast("string")).cast("binary")))
    lean = scratch.cut(sized.select("source", "size", "key"), "sizes")
    bits = range_bits(row_count(lean))
    lean = lean.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits).cast("int"))
    ranges = scratch.cut(lean.groupBy("source", "range").agg(F.sum("size").alias("sum")), "ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("sum").alias("source_size")), weights, share, most)
    budget = F.floor("target")
    targets = targets.withColumn("full", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    targets = scratch.cut(targets.withColumn("rest", (budget - F.col("full") * F.col("source_size")).cast("long")), "targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ranges.withColumn("before", before).alias("r")
    ends = ends.join(targets.alias("t"), same(ranges, targets)).where("r.before < t.rest and t.rest <= r.before + r.sum")
    ends = scratch.cut(ends.select("r.source", "r.range", (F.col("t.rest") - F.col("r.before")).alias("due")), "ends")
    few = targets.count() <= BROADCAST_SOURCES
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    rows = lean.alias("l").join(small(ends).alias("e"), lean["source"].eqNullSafe(ends["source"]) & (lean["range"] == ends["range"]))
    tied = rows.where("l.size > 0").groupBy("l.source", "l.key", "e.due").agg(F.sum("l.size").alias("sum"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = tied.withColumn("before", before).where("before < due and due <= before + sum")
    cuts = cuts.select("source", F.col("key").alias("cut"), F.expr("(due - before) div n").alias("part"))
    plan = targets.alias("t").join(cuts.alias("c"), targets["source"].eqNullSafe(cuts["source"]), "left")
    plan = scratch.cut(plan.select(F.col("t.source").alias("of"), "t.source_size", "t.target", "t.full", "c.cut", "c.part"), "plan")
    scratch.drop("sizes", "ranges", "targets", "ends")
    out = sized.join(small(plan), sized["source"].eqNullSafe(plan["of"]))
    part = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), F.col("part")).otherwise(F.lit(0))
    out = out.withColumn("taken", (F.col("full") * F.col("size") + part).cast("long"))
    out = out.withColumn("copies", (F.col("full") + (2 * part >= F.greatest(F.col("size"), F.lit(1))).cast("long")).cast("int"))
    return out.select("doc", "size", "source_size", "target", "taken", "copies")


def mix_plan(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """docs with size, source_size, target, taken, and copies: how often the document is taken if documents are kept whole."""
    made = ["size", "source_size", "target", "taken", "copies"]
    planned = _planned(docs, weights, share, most, seed)
    return planned.select(*(F.col(f"doc.`{c}`") for c in docs.columns if c not in made), *made)


def mix_documents(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself, of whole documents: a row of docs for each time it is taken. The document at a cut is in if half of it is due."""
    return _planned(docs, weights, share, most, seed).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
