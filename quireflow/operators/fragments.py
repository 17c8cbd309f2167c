"""Markdown with bbox markers to fragments, by lines and inline, and grouping of crops' Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.functions import textclean as T

# A box marker in Markdown.
MARKER = r"bbox:\[(\d+),\s*(\d+),\s*(\d+),\s*(\d+)\]"


def _box(df: DataFrame, marker: str) -> DataFrame:
    default = (0, 0, 1000, 100)
    return df.withColumns({c: F.when(F.col(marker).isNull(), F.lit(default[k])).otherwise(F.regexp_extract(marker, MARKER, k + 1).try_cast("int")) for k, c in enumerate(("x1", "y1", "x2", "y2"))})


def parse_lines(docs: DataFrame, doc: str, text: str = "markdown") -> DataFrame:
    """doc, block_id, text, box: a line with a marker ends the fragment of the lines before it and is used up whole."""
    rows = docs.select(doc, F.posexplode(T.lines(F.col(text))).alias("_i", "_line")).withColumn("_mark", F.when(F.col("_line").rlike(MARKER), F.col("_line")))
    later = Window.partitionBy(doc).orderBy("_i")
    rows = rows.withColumn("_g", F.count("_mark").over(later) - F.col("_mark").isNotNull().cast("int"))
    body = F.sort_array(F.collect_list(F.when(F.col("_mark").isNull(), F.struct("_i", T.rstrip(F.col("_line")).alias("l")))))
    out = rows.groupBy(doc, "_g").agg(T.strip(F.array_join(F.transform(body, lambda x: x["l"]), "\n")).alias("text"), F.max("_mark").alias("_mark")).where("text <> ''")
    return _box(out, "_mark").select(doc, (F.row_number().over(Window.partitionBy(doc).orderBy("_g")) - 1).alias("block_id"), "text", "x1", "y1", "x2", "y2")


def parse_inline(docs: DataFrame, doc: str, text: str = "markdown") -> DataFrame:
    """The same with markers anywhere: the text before each is its fragment, stripped."""
    marks = F.regexp_extract_all(F.col(text), F.lit(f"({MARKER})"), F.lit(1))
    pieces = F.transform(F.split(F.col(text), MARKER, -1), T.strip)
    rows = docs.select(doc, F.posexplode(F.arrays_zip(pieces.alias("t"), marks.alias("m"))).alias("_i", "_p")).select(doc, "_i", F.col("_p.t").alias("text"), F.col("_p.m").alias("_mark")).where("text <> ''")
    return _box(rows, "_mark").select(doc, (F.row_number().over(Window.partitionBy(doc).orderBy("_i")) - 1).alias("block_id"), "text", "x1", "y1", "x2", "y2")


def group_crops(pieces: DataFrame, doc: str, big: str, seq: str, is_title: str, text: str) -> DataFrame:
    """doc, big, part, text: a crop's pieces in order; titles stand alone, the others between them are joined by newlines; each is cleaned, and goes if nothing is left."""
    order = Window.partitionBy(doc, big).orderBy(seq)
    titles = F.sum(F.col(is_title).cast("int")).over(order)
    rows = pieces.withColumn("_part", 2 * titles - F.col(is_title).cast("int"))
    body = F.sort_array(F.collect_list(F.struct(F.col(seq), F.col(text))))
    joined = F.array_join(F.transform(body, lambda x: x[text]), "\n")
    grouped = rows.groupBy(doc, big, "_part").agg(joined.alias("_raw"))
    cleaned = grouped.select(doc, big, F.col("_part").alias("part"), T.normalise_markdown(T.full_clean(F.col("_raw"))).alias("text"))
    return cleaned.where("text <> ''")


def add_markers(groups: DataFrame, boxes: DataFrame, doc: str, big: str) -> DataFrame:
    """doc, markdown: groups' texts, each group followed by its crop's box (negative coordinates as 0), joined by blank lines."""
    parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "\n\n")
    g = groups.groupBy(doc, big).agg(parts.alias("_text")).join(boxes, [doc, big], "left")
    low = [F.greatest(F.lit(0), F.col(c)) for c in ("x1", "y1", "x2", "y2")]
    marker = F.when(F.col("x1").isNotNull(), F.concat(F.lit("\n\nbbox:["), F.concat_ws(",", *low), F.lit("]"))).otherwise(F.lit(""))
    every = F.sort_array(F.collect_list(F.struct(F.col(big), F.concat("_text", marker).alias("t"))))
    return g.groupBy(doc).agg(F.array_join(F.transform(every, lambda x: x["t"]), "\n\n").alias("markdown"))


def positional_labels(crops: DataFrame, doc: str, big: str, sub: str, label: str, there: str) -> DataFrame:
    """crops with format_label and group_label, as labels are found when lists are paired by position.

    Labels are those of sub crops only, in order. The n-th is taken for the n-th crop with a result (``there``) when titles
    are formatted, and for the n-th crop of all when they part groups; crops beyond the list have none.
    """
    order = Window.partitionBy(doc).orderBy(big, F.coalesce(sub, F.lit(0)))
    upto = lambda c: F.sum(c.cast("int")).over(order)
    held = Window.partitionBy(doc)
    rows = crops.withColumns({"_of_all": F.row_number().over(order), "_of_there": F.when(F.col(there), upto(F.col(there))), "_of_subs": F.when(F.col(sub).isNotNull(), upto(F.col(sub).isNotNull()))})
    labels = F.transform(F.sort_array(F.collect_list(F.when(F.col(sub).isNotNull(), F.struct("_of_subs", label))).over(held)), lambda x: x[label])
    rows = rows.withColumn("_labels", labels)
    at = lambda k: F.get("_labels", F.col(k) - 1)
    return rows.withColumns({"format_label": at("_of_there"), "group_label": at("_of_all")}).drop("_of_all", "_of_there", "_of_subs", "_labels")
