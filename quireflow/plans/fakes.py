"""Deterministic stand-ins for models, and pages that carry their layout in their first pixels: for tests and the registered queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.operators.continuity import PlainScorer
from quireflow.plans.registry import BACKENDS
from quireflow.plans.views import layout

#: Pixels of a page; boxes of the layout view are ten times as large.
WIDTH, HEIGHT = 120, 171


def pages(s: SparkSession, d: str) -> DataFrame:
    """doc_id and content: a grey Netpbm picture for each page of the layout view. Its first pixels are the characters of the detector's result, up to a newline."""
    box = F.struct(F.array(*((F.col(c) / 10.0) for c in ("x1", "y1", "x2", "y2"))).alias("coordinate"), "label", F.col("confidence").alias("score"))
    rows = layout(s, d).groupBy(F.col("page").alias("doc_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("region", box.alias("b")))), lambda r: r["b"]).alias("boxes"))
    result = F.concat(F.to_json(F.struct(F.struct("boxes").alias("res"))), F.lit("\n"))
    body = F.rpad(result, WIDTH * HEIGHT, "\x7f" * WIDTH)  # a line at a time
    return rows.select("doc_id", F.concat(F.lit(f"P5\n{WIDTH} {HEIGHT}\n255\n"), body).cast("binary").alias("content"))


def detect(pictures):
    return [bytes(p.ravel()).split(b"\n", 1)[0].decode() for p in pictures]


def detect_fine(pictures):
    """So many sub boxes as the size tells, the second one always empty; those of large pictures fail."""
    out = []
    for p in pictures:
        h, w = p.shape[:2]
        if h + w > 40:
            raise ValueError("too large")
        out.append({"res": {"boxes": [{"coordinate": [k * 3 - 1, k * 2, 0 if k == 1 else k * 3 + 9, k * 2 + 6], "block_label": "title" if k == 2 else "text"} for k in range((h + w) % 4)]}})
    return out


def recognise(pictures):
    """A text by size and mean of the picture; null for some, and blocks for others."""
    out = []
    for p in pictures:
        h, w, mean = *p.shape[:2], int(p.mean(dtype=np.float64))
        text = f"Size {h} by {w}, mean {mean}" + (" ends." if mean % 2 else " goes on")
        out.append(None if (h + mean) % 11 == 0 else [{"label": "text", "bbox": [0, 0, w, h], "content": text}, {"label": "text", "bbox": [0, 0, 9, 2], "content": "a second block"}] if mean % 5 == 0 else text)
    return out


def goes_on(a: str, b: str) -> float:
    if (len(a) + len(b)) % 29 == 0:
        raise ValueError("no score")
    return ((len(a) * 31 + len(b) * 17) % 997) / 998


def nothing_goes_on() -> PlainScorer:
    return PlainScorer(lambda a, b: 0.0)


BACKENDS.register("detector:fake")(lambda: detect)
BACKENDS.register("detector:fake_fine")(lambda: detect_fine)
BACKENDS.register("recogniser:fake")(lambda: recognise)
BACKENDS.register("scorer:fake")(lambda: PlainScorer(goes_on))
CONFIG = {"coarse_detector": {"model": "fake", "target_size": [WIDTH, HEIGHT]}, "fine_detector": {"model": "fake_fine"}, "ocr": {"model": "fake", "threads": 1, "timeout": None}, "reorder": {"model": "fake"}}
