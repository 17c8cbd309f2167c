"""Detection stages around plugged-in models: page pictures, results as JSON, boxes, crops, and the second detection inside crops."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.operators import geometry as G
from quireflow.operators.xycut import CROP_SCALE, order_boxes
from quireflow.tables import ship

_LOG = logging.getLogger(__name__)
#: What a detector gives: results as JSON text or as the object itself, one for each picture; None for none.
Detect = Callable[[Sequence[np.ndarray]], Sequence[str | dict | None]]
Decode = Callable[[bytes], np.ndarray]
RESULT = "struct<res: struct<boxes: array<struct<coordinate: array<double>, label: string, score: double, confidence: double>>>>"
PICTURE = "h int, w int, c int, data binary"
#: Pages that are decoded at once; an Arrow batch may hold hundreds of compressed ones.
SLICE = 8
#: Bytes of crops' pixels that are sent on at once, beyond those of one page.
PIXELS = 4 << 20


def _netpbm_head(content: bytes) -> tuple[bytes, int, int, int]:
    """Kind, width, height, and where the pixels begin."""
    fields: list[bytes] = []
    at = 0
    while len(fields) < 4:
        while content[at : at + 1].isspace():
            at += 1
        if content[at : at + 1] == b"#":
            at = content.index(b"\n", at)
            continue
        end = at
        while end < len(content) and not content[end : end + 1].isspace():
            end += 1
        if end == at:
            raise ValueError("no Netpbm picture")
        fields.append(content[at:end])
        at = end
    kind, (w, h, most) = fields[0], map(int, fields[1:])
    if kind not in (b"P5", b"P6") or most > 255:
        raise ValueError("only P5 and P6 pictures of 8 bits are read")
    return kind, w, h, at + 1


def netpbm_size(content: bytes) -> int:
    """Bytes of the first picture of a Netpbm file."""
    kind, w, h, at = _netpbm_head(content[:4096])
    return min(len(content), at + w * h * (3 if kind == b"P6" else 1))


def decode_netpbm(content: bytes) -> np.ndarray:
    """A binary grey (P5) or colour (P6) Netpbm picture of 8 bits."""
    kind, w, h, at = _netpbm_head(content)
    pixels = np.frombuffer(content, np.uint8, w * h * (3 if kind == b"P6" else 1), at)
    return pixels.reshape((h, w, 3) if kind == b"P6" else (h, w))


def decode_picture(content: bytes) -> np.ndarray:
    """Netpbm by itself, other kinds with the picture library, where it is installed."""
    if content[:2] in (b"P5", b"P6"):
        return decode_netpbm(content)
    import io

    from PIL import Image

    return np.array(Image.open(io.BytesIO(content)))


def _lanczos(old: int, new: int) -> np.ndarray:
    """Weights (new, old) of a Lanczos filter of three lobes, widened when the picture shrinks."""
    step = old / new
    wide = max(step, 1.0)
    centre = (np.arange(new) + 0.5) * step
    x = (np.arange(old)[None] + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(1, keepdims=True)


def resize(picture: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """The picture in size (width, height); itself if it has that size."""
    h, w = picture.shape[:2]
    if (w, h) == tuple(size):
        return picture
    rows, columns = _lanczos(h, size[1]), _lanczos(w, size[0])
    flat = picture.reshape(h, w, -1).astype(float)
    out = np.einsum("yh,hwc,xw->yxc", rows, flat, columns, optimize=True)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape(size[1], size[0], *picture.shape[2:])


def _text(result: str | dict | None) -> str | None:
    return result if result is None or isinstance(result, str) else json.dumps(result)


def detect_pages(pages: DataFrame, doc: str, content: str, detector: Callable[[], Detect], decode: Decode = decode_picture, target: tuple[int, int] = (1240, 1755), permissive: bool = False, name: str | None = None) -> DataFrame:
    """doc, page_w, page_h, result (JSON) and error of pages. Pictures are resized to ``target`` for the model, SLICE pages at a time.

    A model's error ends the job, or is the page's ``error`` if permissive. With a name, a worker loads the model once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(f"detector:{name}", detector, plan) if name else detector()
        for b in batches:
            contents, sizes, results, errors = b[content].tolist(), [], [], []
            for at in range(0, len(contents), SLICE):
                pictures, good = [], []
                for k, x in enumerate(contents[at : at + SLICE], at):
                    try:
                        p = decode(bytes(x))
                        small = resize(p, target)
                    except Exception as e:
                        if not permissive:
                            raise
                        sizes.append((None, None)), errors.append(str(e))
                    else:
                        sizes.append((p.shape[1], p.shape[0])), pictures.append(small), errors.append(None), good.append(k)
                results += [None] * (len(errors) - at)
                try:
                    got = list(model(pictures)) if pictures else []
                    for k, r in zip(good, got, strict=False):
                        results[k] = _text(r)
                except Exception as e:
                    if not permissive:
                        raise
                    for k in good:
                        errors[k] = str(e)
            yield pd.DataFrame({doc: b[doc], "page_w": pd.Series([w for w, _ in sizes], dtype="Int32", index=b.index), "page_h": pd.Series([h for _, h in sizes], dtype="Int32", index=b.index), "result": pd.Series(results, dtype=object, index=b.index), "error": pd.Series(errors, dtype=object, index=b.index)})

    from quireflow.operators.backends import loaded

    ship(pages.sparkSession)
    plan = uuid.uuid4().hex
    kept = pages.where(F.col(content).isNotNull()).select(doc, content)
    return kept.mapInPandas(run, f"`{doc}` {kept.schema[doc].dataType.simpleString()}, page_w int, page_h int, result string, error string")


def result_boxes(result: Column) -> Column:
    """The array of boxes of a result, under res.boxes or directly under res; empty without any."""
    under = F.from_json(result, RESULT)["res"]["boxes"]
    direct = F.from_json(result, RESULT.replace("struct<boxes: ", "", 1)[:-1])["res"]
    return F.coalesce(under, direct, F.from_json(F.lit("[]"), "array<struct<coordinate: array<double>, label: string, score: double, confidence: double>>"))


def normalise_boxes(detections: DataFrame, result: str, target: tuple[int, int]) -> DataFrame:
    """A row per box: region (from 0, as detected), label, confidence, x1, y1, x2, y2 in the page's own pixels.

    Boxes of fewer than four coordinates go. The confidence is the score, else ``confidence``, else 0; a missing label is
    empty. Coordinates are scaled back and truncated if the page was resized (page_w, page_h differ from ``target``), else
    truncated only.
    """
    rows = detections.select("*", F.posexplode(result_boxes(F.col(result))).alias("region", "_b")).where(F.size("_b.coordinate") >= 4)
    sx, sy = F.col("page_w") / F.lit(float(target[0])), F.col("page_h") / F.lit(float(target[1]))
    at = lambda k, s: (F.get("_b.coordinate", F.lit(k)) * s).cast("int")
    made = {"label": F.coalesce("_b.label", F.lit("")), "confidence": F.coalesce("_b.score", "_b.confidence", F.lit(0.0)), "x1": at(0, sx), "y1": at(1, sy), "x2": at(2, sx), "y2": at(3, sy)}
    return rows.withColumns(made).drop("_b", result)


def crop_pixels(boxes: DataFrame, pages: DataFrame, doc: str, content: str, decode: Decode = decode_picture) -> DataFrame:
    """boxes with the pixels (h, w, c, data) inside cx1, cy1, cx2, cy2; boxes of a page without content get none.

    A page's boxes are gathered to one row, which is a few hundred bytes, and come to its page: it is decoded once for all of
    them, and only its row is in memory. Pages stream past the gathered boxes: they are not sorted, which would hold contents
    that a shuffle's size, as it is compressed, tells nothing of.
    """
    inner = [f for f in boxes.schema if f.name != doc]
    gathered = boxes.groupBy(doc).agg(F.collect_list(F.struct(*(F.col(f"`{f.name}`") for f in inner))).alias("_boxes")).withColumnRenamed(doc, "_doc")
    met = gathered.hint("shuffle_hash").join(pages.select(doc, content), F.col("_doc").eqNullSafe(F.col(doc)), "left").select(F.col("_doc").alias(doc), "_boxes", content)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = pc.list_value_length(b.column(1)).to_pylist()
            held = pc.list_flatten(b.column(1))
            corners = list(zip(*(pc.struct_field(held, c).to_pylist() for c in ("cx1", "cy1", "cx2", "cy2")), strict=True))
            owner = pc.list_parent_indices(b.column(1))
            first, at, parts, size = 0, 0, [], 0
            for row, n in enumerate(counts):
                bytes_ = b.column(2)[row].as_py()
                picture = None if bytes_ is None else decode(bytes_)
                for x1, y1, x2, y2 in corners[at : at + n]:
                    if picture is None:
                        parts.append((None, None, None, None))
                        continue
                    p = picture[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)]
                    parts.append((p.shape[0], p.shape[1], p.shape[2] if p.ndim == 3 else 1, p.tobytes()))
                    size += p.nbytes
                at += n
                if size < PIXELS and row + 1 < len(counts):
                    continue
                some = held.slice(first, at - first)
                own = [pc.struct_field(some, f.name) for f in inner]
                pixels = [pa.array([p[k] for p in parts], kind) for k, kind in enumerate([pa.int32()] * 3 + [pa.binary()])]
                key = b.column(0).take(owner.slice(first, at - first))
                yield pa.RecordBatch.from_arrays([key, *own, *pixels], [doc, *(f.name for f in inner), "h", "w", "c", "data"])
                first, parts, size = at, [], 0

    ship(boxes.sparkSession)
    kind = T.StructType([boxes.schema[doc], *inner, *T.StructType.fromDDL(PICTURE).fields])
    return met.mapInArrow(cut, kind).select(*boxes.columns, "h", "w", "c", "data")


def _columns(parts: list[np.ndarray | None], index) -> dict[str, pd.Series]:
    shape = lambda f: pd.Series([None if p is None else f(p) for p in parts], dtype="Int32", index=index)
    return {"h": shape(lambda p: p.shape[0]), "w": shape(lambda p: p.shape[1]), "c": shape(lambda p: p.shape[2] if p.ndim == 3 else 1), "data": pd.Series([None if p is None else p.tobytes() for p in parts], dtype=object, index=index)}


def picture_of(row) -> np.ndarray | None:
    if row.data is None:
        return None
    return np.frombuffer(row.data, np.uint8).reshape((row.h, row.w, row.c) if row.c > 1 else (row.h, row.w))


def map_pixels(crops: DataFrame, change: Callable) -> DataFrame:
    """crops with each row's pixels replaced by change(picture, row); rows without pixels stay as they are."""
    ship(crops.sparkSession)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [None if (p := picture_of(r)) is None else change(p, r) for r in b.itertuples(index=False)]
            yield b.assign(**_columns(parts, b.index))

    return crops.mapInPandas(run, kind)


def sub_boxes(result: str | dict | None, scale: tuple[float, float] = CROP_SCALE) -> list[tuple[int, int, int, int, str]]:
    """The boxes of a second detection in reading order, with label or block_label, else ``region``."""
    found = json.loads(result) if isinstance(result, str) else result
    res = (found or {}).get("res", {})
    boxes = [b for b in (res.get("boxes", []) if isinstance(res, dict) else res) if len(b.get("coordinate") or []) >= 4]
    corners = [[int(v) for v in b["coordinate"][:4]] for b in boxes]
    labels = [b.get("label") or b.get("block_label") or "region" for b in boxes]
    return [(*corners[k], labels[k]) for k in order_boxes(corners, scale)]


def detect_in_crops(crops: DataFrame, detector: Callable[[], Detect], scale: tuple[float, float] = CROP_SCALE, name: str | None = None) -> DataFrame:
    """crops with ``subs``: the sub boxes of each picture, in reading order; null where the model fails or finds none. One call a batch; if it fails, each picture is tried by itself."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema)

    from quireflow.operators.backends import loaded

    ship(crops.sparkSession)
    plan = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(f"fine detector:{name}", detector, plan) if name else detector()

        def one(p: np.ndarray) -> str | dict | None:
            try:
                return next(iter(model([p])), None)
            except Exception:
                _LOG.debug("the second detection failed", exc_info=True)
                return None

        for b in batches:
            pictures = [picture_of(r) for r in b.itertuples(index=False)]
            there = [p for p in pictures if p is not None]
            try:
                got = list(model(there)) if there else []
            except Exception:
                got = [one(p) for p in there]
                _LOG.warning("the second detection failed on %d of %d crops", got.count(None), len(got))
            results = iter([*got, *[None] * (len(there) - len(got))])
            subs = [None if p is None else [dict(zip(("x1", "y1", "x2", "y2", "label"), s, strict=True)) for s in sub_boxes(next(results), scale)] or None for p in pictures]
            yield b.assign(subs=pd.Series(subs, dtype=object, index=b.index))

    return crops.mapInPandas(run, f"{kind}, subs array<struct<x1: int, y1: int, x2: int, y2: int, label: string>>")


def sub_pixels(named: DataFrame) -> DataFrame:
    """Rows of ``geometry.sub_crops`` with the sub box's own pixels, coordinates and label; a crop without sub boxes keeps its own."""
    inside = F.col("sub_no").isNotNull()
    rows = named.withColumns({"ox": F.col("px1") - F.col("x1"), "oy": F.col("py1") - F.col("y1"), "ow": F.when(inside, F.col("px2") - F.col("px1")), "oh": F.when(inside, F.col("py2") - F.col("py1"))})
    cut = map_pixels(rows, lambda p, r: p if pd.isna(r.ow) else p[int(r.oy) : int(r.oy + r.oh), int(r.ox) : int(r.ox + r.ow)])
    return cut.drop("ox", "oy", "ow", "oh")


def fine_crops(crops: DataFrame, detector: Callable[[], Detect], doc: str, scale: tuple[float, float] = CROP_SCALE, name: str | None = None) -> DataFrame:
    """crops (doc, big_no, name, label, x1.., cx1.., h, w, c, data) fanned out into sub crops; a crop that none is found in stays as itself.

    The picture covers the clipped box, so sub boxes count from its corner, as the source's do from the box's own: page
    coordinates are the box's corner plus the sub box's.
    """
    found = detect_in_crops(crops, detector, scale, name)
    # sub_crops clips to x2 - x1 and y2 - y1, which here must be the picture's size
    picture = found.withColumns({"bx1": F.col("x1"), "by1": F.col("y1"), "bx2": F.col("x2"), "by2": F.col("y2"), "x2": F.col("x1") + F.col("w"), "y2": F.col("y1") + F.col("h")})
    rows = sub_pixels(G.sub_crops(picture))
    own = F.col("sub_no").isNull()
    label = F.when(own, F.col("label")).otherwise(F.col("sub_label"))
    rows = rows.withColumns({"label": label, "px2": F.when(own, F.col("bx2")).otherwise(F.col("px2")), "py2": F.when(own, F.col("by2")).otherwise(F.col("py2"))})
    return rows.select(doc, "big_no", "sub_no", F.col("sub_name").alias("name"), "label", "bx1", "by1", "bx2", "by2", F.col("px1").alias("x1"), F.col("py1").alias("y1"), F.col("px2").alias("x2"), F.col("py2").alias("y2"), "h", "w", "c", "data")
