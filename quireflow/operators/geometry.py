"""Region boxes: normalisation, clipping, filters, naming and padding. Boxes are columns x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rescale(df: DataFrame, width: int, height: int, target_width: int, target_height: int) -> DataFrame:
    """Detector coordinates to page coordinates, truncated toward zero; unchanged if the sizes are equal."""
    if (width, height) == (target_width, target_height):
        return df
    sx, sy = F.lit(width / target_width), F.lit(height / target_height)
    return df.withColumns({c: (F.col(c) * (sx if c[0] == "x" else sy)).cast("int") for c in ("x1", "y1", "x2", "y2")})


def clip(df: DataFrame, width: int, height: int) -> DataFrame:
    low = lambda c: F.greatest(F.lit(0), F.col(c))
    return df.withColumns({"cx1": low("x1"), "cy1": low("y1"), "cx2": F.least(F.lit(width), F.col("x2")), "cy2": F.least(F.lit(height), F.col("y2"))})


def drop_degenerate(df: DataFrame, width: int, height: int) -> DataFrame:
    """Boxes that are empty after clipping go; the others keep their unclipped coordinates too."""
    return clip(df, width, height).where("cx2 > cx1 AND cy2 > cy1")


def filter_labels(df: DataFrame, ignored: list[str]) -> DataFrame:
    return df.where(~F.col("label").isin(*ignored)) if ignored else df


def filter_labels_by_table(df: DataFrame, ignored: DataFrame) -> DataFrame:
    """The same with labels in a table, of any size: Spark broadcasts it if it is small."""
    return df.join(ignored, "label", "left_anti")


def should_resegment(w: Column, h: Column, page_area: int) -> Column:
    """A large part of the page, or an elongated shape."""
    aspect = w / h
    return (w * h / F.lit(page_area) > 0.125) | aspect.between(0.15, 0.71) | aspect.between(1.45, 6.8)


def pad_geometry(df: DataFrame) -> DataFrame:
    """Side of the white square a crop is centred on, the crop's place in it, and whether its shape is padded at all."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    side = F.floor(F.greatest(w, h) * 1.5).cast("int")
    half = lambda x: F.floor((side - x) / 2).cast("int")
    return df.withColumns({"side": side, "pad_left": half(w), "pad_top": half(h), "padded": (w / h).between(0.1, 10)})


def name_crops(df: DataFrame, page: str, order: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(page).orderBy(order))
    return df.withColumn("big_no", n).withColumn("name", F.concat(F.lit("crop_"), n.cast("string")))


def sub_crops(df: DataFrame, subs: str = "subs") -> DataFrame:
    """Rows of the array ``subs`` (x1, y1, x2, y2 within the crop), numbered before empty ones go, in page coordinates, clipped to the crop.

    A crop without any valid sub box stays as itself (sub_no null). Labels of sub boxes, if they have any, are sub_label.
    """
    labelled = "label" in df.schema[subs].dataType.elementType.fieldNames()
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    box = lambda b, i: F.struct((i + 1).alias("sub_no"), F.greatest(F.lit(0), b["x1"]).alias("a"), F.greatest(F.lit(0), b["y1"]).alias("b"), F.least(w, b["x2"]).alias("c"), F.least(h, b["y2"]).alias("d"), *([b["label"].alias("label")] if labelled else []))
    fine = F.filter(F.transform(subs, box), lambda s: (s["c"] > s["a"]) & (s["d"] > s["b"]))
    out = df.withColumn("_s", F.explode_outer(fine))
    name = F.when(F.col("_s").isNull(), F.col("name")).otherwise(F.concat_ws(".", "name", F.col("_s.sub_no").cast("string")))
    base = {"x1": "x1", "y1": "y1"}
    return out.withColumns({
        "sub_name": name, "sub_no": F.col("_s.sub_no"),
        "px1": F.coalesce(F.col(base["x1"]) + F.col("_s.a"), F.col("x1")), "py1": F.coalesce(F.col(base["y1"]) + F.col("_s.b"), F.col("y1")),
        "px2": F.coalesce(F.col(base["x1"]) + F.col("_s.c"), F.col("x2")), "py2": F.coalesce(F.col(base["y1"]) + F.col("_s.d"), F.col("y2")),
        **({"sub_label": F.col("_s.label")} if labelled else {}),
    }).drop("_s")


def font_size(longest_edge: Column) -> Column:
    return F.least(F.greatest(F.floor(longest_edge * 16 / 1920).cast("int"), F.lit(12)), F.lit(40))
