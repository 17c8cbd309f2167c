"""Pages in, Markdown out."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quireflow.functions.textclean import strip_bbox_lines
from quireflow.plans.registry import BACKENDS, InputError
from quireflow.sources.datasource import PARTITION_BYTES, Splitter, batch_done, register
from quireflow.tables import ship

def read_pages(spark: SparkSession, path: str, splitters: dict[str, Splitter] | None = None, names: str = "stem", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """doc_id, document, page_no, path, content of the page files directly in a folder, of one file of any suffix, or of what a pattern tells. A path that is not there raises.

    doc_id is a page's own key. The document is the file's stem, or its whole name where two files have one stem (with names
    "file" it is the whole name of any); a file of several pages, as a splitter of its suffix gives them, has a row for each. Splitters are those registered by
    ``splitter:<suffix>``, and those given.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    if not found:
        raise InputError("no such path", path=path)
    known = {n.split(":", 1)[1]: BACKENDS.get(n)() for n in BACKENDS.names() if n.startswith("splitter:")}
    register(spark, known | dict(splitters or {}))
    paths = [path] if len(found) == 1 and not re.search(r"[*?\[{]", path) else [f.getPath().toString() for f in found]
    return spark.read.format("quireflow_pages").option("files", json.dumps(paths)).option("names", names).option("partition_bytes", partition_bytes).load()


def final_text(final: Column, annotated: Column) -> Column:
    """The final text, else the annotated one without its markers."""
    return F.coalesce(F.when(final != "", final), strip_bbox_lines(annotated))


def file_name(key: object) -> str:
    """A document's name as a file's: separators and control characters are percent-coded, null is ``null``."""
    return quote("null" if key is None else str(key), safe=" !#$&'()+,;=@[]{}~^`") or "%"


def write_files(files: DataFrame, root: str) -> int:
    """Writes each row's ``body`` (binary) to the path below root that its ``parts`` (array of names) tell, and gives the number of rows.

    The executors write, through Arrow's file systems, each file under a hidden name first; a file that is there is replaced,
    so a task that runs again does no harm.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for b in batches:
            for parts, body in zip(b["parts"], b["body"], strict=True):
                *folders, name = map(file_name, parts)
                folder = "/".join([base, *folders])
                store.create_dir(folder, recursive=True)
                hidden = f"{folder}/.{uuid.uuid4().hex}"
                with store.open_output_stream(hidden) as f:
                    f.write(bytes(body or b""))
                store.move(hidden, f"{folder}/{name}")
            yield pd.DataFrame({"n": [len(b)]})

    ship(files.sparkSession)
    return files.select("parts", "body").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]


def write_markdown(docs: DataFrame, root: str, doc: str = "doc_id", text: str = "markdown", suffix: str = "", batch: str | None = None) -> int:
    """Writes root/name/name.md for each document, in UTF-8, and gives their number. With a suffix, root/name/name<suffix>.md.

    Files are seen when all are written, and a failing job changes none. With ``batch``, a mark is left that ``batch_done``
    finds, and a batch that is marked isn't written again.
    """
    if batch is not None and batch_done(root, batch):
        return 0
    register(docs.sparkSession)
    seen = Observation()
    rows = docs.select(F.coalesce(F.col(doc).cast("string"), F.lit("null")).alias("doc_id"), F.col(text).cast("string").alias("markdown")).observe(seen, F.count(F.lit(1)).alias("n"))
    out = rows.write.format("quireflow_markdown").mode("append").option("path", root).option("suffix", suffix)
    (out if batch is None else out.option("batch", batch)).save()
    return seen.get["n"]


def write_crop_texts(results: DataFrame, root: str, doc: str = "doc_id") -> int:
    """Writes root/name/debug/crop/crop.md for each recognised crop (doc, name, blocks) that has a text."""
    said = F.array_join(F.transform("blocks", lambda b: b["content"]), "\n\n")
    rows = results.where(F.col("blocks").isNotNull()).select(F.array(F.coalesce(F.col(doc).cast("string"), F.lit("null")), F.lit("debug"), "name", F.concat("name", F.lit(".md"))).alias("parts"), said.alias("said"))
    return write_files(rows.where(~F.col("said").rlike(r"(?U)\A\s*\z")).select("parts", F.col("said").cast("binary").alias("body")), root)


def netpbm(picture: np.ndarray) -> bytes:
    """A picture as a binary Netpbm file: grey, or colour without alpha."""
    grey = picture.ndim == 2 or picture.shape[2] == 1
    body = picture if grey else np.ascontiguousarray(picture[..., :3])
    return b"P%d\n%d %d\n255\n" % (5 if grey else 6, picture.shape[1], picture.shape[0]) + body.tobytes()


def _folder(doc: str):
    return F.coalesce(F.col(doc).cast("string"), F.lit("null"))


def write_outlines(pages: DataFrame, boxes: DataFrame, root: str, name: str, decode: Callable[[bytes], np.ndarray], doc: str = "doc_id", thickness: int = 8, order: str | None = None, edge=(255, 0, 0), ink=(255, 255, 0)) -> int:
    """Writes root/name/debug/<name>.ppm for each page with boxes (doc, x1, y1, x2, y2): the page as a Netpbm picture with their outlines, each with its number, and its label if there is one, on a badge.

    Numbers go by the column ``order``, else from the top left.
    """
    from quireflow.operators.raster import paint_boxes, paint_captions

    keys = [order] if order else ["y1", "x1", "y2", "x2"]
    label = [F.col("label").cast("string").alias("label")] if "label" in boxes.columns else [F.lit(None).cast("string").alias("label")]
    lean = boxes.select(F.col(doc).alias("_of"), F.struct(*(F.col(k).alias(f"k{n}") for n, k in enumerate(keys)), *(F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")), *label).alias("b"))
    gathered = lean.groupBy("_of").agg(F.sort_array(F.collect_list("b")).alias("boxes"))
    met = gathered.join(pages.select(doc, "content"), F.col("_of").eqNullSafe(F.col(doc))).where("content IS NOT NULL").select(_folder("_of").alias("key"), "boxes", "content")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, own, content in b.itertuples(index=False):
                corners = [tuple(int(x[c]) for c in ("x1", "y1", "x2", "y2")) for x in own]
                captions = [f"{n}:{x['label']}" if x["label"] else str(n) for n, x in enumerate(own, 1)]
                outlined = paint_boxes(decode(bytes(content)), corners, colour=edge, thickness=thickness)
                yield pd.DataFrame({"key": [key], "body": [netpbm(paint_captions(outlined, corners, captions, edge, ink))]})

    ship(pages.sparkSession)
    drawn = met.mapInPandas(draw, "key string, body binary")
    return write_files(drawn.select(F.array("key", F.lit("debug"), F.lit(f"{name}.ppm")).alias("parts"), "body"), root)


def write_crop_pictures(crops: DataFrame, root: str, suffix: str = "", doc: str = "doc_id") -> int:
    """Writes root/name/debug/crop/crop<suffix>.ppm for each crop (doc, name, h, w, c, data) that has pixels."""
    from quireflow.operators.detect import picture_of

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "name": b["name"], "body": [netpbm(picture_of(r)) for r in b.itertuples(index=False)]})

    ship(crops.sparkSession)
    lean = crops.where("data IS NOT NULL AND h > 0 AND w > 0").select(_folder(doc).alias("key"), "name", "h", "w", "c", "data")
    drawn = lean.mapInPandas(draw, "key string, name string, body binary")
    return write_files(drawn.select(F.array("key", F.lit("debug"), "name", F.concat("name", F.lit(f"{suffix}.ppm"))).alias("parts"), "body"), root)


def success_count(tasks: DataFrame, done: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """One row: documents, and how many of them have a text."""
    good = done.where(F.col(text) != "").select(F.col(doc).alias("_done")).distinct()
    return tasks.select(doc).distinct().join(good, F.col(doc) == F.col("_done"), "left").agg(F.count(F.lit(1)).alias("documents"), F.count("_done").alias("succeeded"))
