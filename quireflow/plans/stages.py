"""The registered stages of the page pipeline, in their default order, and its default configuration.

Pages are rows of doc_id and content. Models are plugged in by name: ``<stage>.model`` names a loader in BACKENDS.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.functions import textclean as T
from quireflow.operators import continuity as S
from quireflow.operators import detect as E
from quireflow.operators import direction as D
from quireflow.operators import fragments as P
from quireflow.operators import geometry as G
from quireflow.operators import nsp  # noqa: F401 - registers its scorer
from quireflow.operators import overlaps as O
from quireflow.operators import raster as R
from quireflow.operators import xycut as X
from quireflow.operators.backends import recognise_pictures
from quireflow.operators.chain import ChainOptions
from quireflow.plans.registry import BACKENDS, STAGES, Config, Context, Pipeline
from quireflow.sources.pages import final_text, write_markdown

DOC = "doc_id"
DEFAULTS: dict = {
    "pipeline": {},
    "source": {"decoder": "picture"},
    "coarse_detector": {"model": "none", "target_size": [1240, 1755], "threshold": 0.0, "overlaps": "none", "permissive": False},
    "sorter": {"scale": list(X.PAGE_SCALE), "rounds": 2},
    "crop_filter": {"ignore_labels": ["header", "advert"]},
    "fine_detector": {"model": "none", "scale": list(X.CROP_SCALE)},
    "column_expander": {"extra": 5, "ink_below": 100, "least_depth": 0.6, "least_valley": 2, "least_column": 18, "smooth": 4, "jitter": 2},
    "ocr": {"model": "none", "second": None, "threads": 8, "timeout": 120},
    "postprocessor": {"lexicon": None, "segmenter": "dictionary", "broadcast_words": D.MOST_WORDS, "positional_labels": False},
    "reorder": {"model": "none", "weights": None, "left": 200, "diagonal": 100, "below": 1000, "least": 0.6, "decay": 500.0},
    "aggregator": {"output": None},
}

BACKENDS.register("decoder:picture")(lambda: E.decode_picture)
BACKENDS.register("detector:none")(lambda: lambda pictures: [None] * len(pictures))
BACKENDS.register("recogniser:none")(lambda: lambda pictures: [None] * len(pictures))
BACKENDS.register("scorer:none")(lambda: S.PlainScorer(lambda a, b: 0.0))


def _backend(ctx: Context, kind: str, key: str):
    return BACKENDS.get(f"{kind}:{ctx.get(key, 'none')}")


@STAGES.register("coarse_detector")
def coarse_detector(pages: DataFrame, ctx: Context) -> DataFrame:
    """Boxes of pages. The pages are kept for the cropper, and in a permissive run the errors for the aggregator."""
    ctx.tables["pages"] = pages
    target, permissive, name = tuple(ctx.get("coarse_detector.target_size")), bool(ctx.get("coarse_detector.permissive")), ctx.get("coarse_detector.model")
    found = E.detect_pages(pages, DOC, "content", _backend(ctx, "detector", "coarse_detector.model"), _backend(ctx, "decoder", "source.decoder")(), target, permissive, name)
    if permissive:
        found = ctx.cut(found, "detected")  # read twice
        ctx.tables["errors"] = found.where(F.col("error").isNotNull()).select(DOC, "error")
    boxes = E.normalise_boxes(found.drop("error"), "result", target)
    boxes = boxes.where(F.col("confidence") >= float(ctx.get("coarse_detector.threshold")))
    mode = ctx.get("coarse_detector.overlaps")
    if mode == "none":
        return boxes
    return O.settle(ctx.cut(boxes, "boxes"), DOC, "region", "confidence", mode, ctx.written(boxes))


def _named(crops: DataFrame) -> DataFrame:
    """Crops as the second detection leaves them, where that stage was passed over."""
    if "big_no" in crops.columns:
        return crops
    rows = G.name_crops(crops, DOC, "rank" if "rank" in crops.columns else "region")
    return rows.withColumns({"sub_no": F.lit(None).cast("int"), **{f"b{c}": F.col(c) for c in ("x1", "y1", "x2", "y2")}})


@STAGES.register("sorter")
def sorter(boxes: DataFrame, ctx: Context) -> DataFrame:
    return X.reading_order(boxes, DOC, "region", tuple(ctx.get("sorter.scale")), int(ctx.get("sorter.rounds")), ctx.written(boxes))


@STAGES.register("cropper")
def cropper(boxes: DataFrame, ctx: Context) -> DataFrame:
    """Boxes that are left of the page's area, with their pixels if the pages are there."""
    low = lambda c: F.greatest(F.lit(0), F.col(c))
    clipped = boxes.withColumns({"cx1": low("x1"), "cy1": low("y1"), "cx2": F.least("page_w", "x2"), "cy2": F.least("page_h", "y2")}).where("cx2 > cx1 AND cy2 > cy1")
    if "pages" not in ctx.tables:
        return clipped
    return E.crop_pixels(clipped, ctx.tables["pages"], DOC, "content", _backend(ctx, "decoder", "source.decoder")())


@STAGES.register("crop_filter")
def crop_filter(crops: DataFrame, ctx: Context) -> DataFrame:
    return G.filter_labels(crops, list(ctx.get("crop_filter.ignore_labels") or []))


@STAGES.register("fine_detector")
def fine_detector(crops: DataFrame, ctx: Context) -> DataFrame:
    """Named crops and sub crops; a crop without pixels goes, but counts."""
    named = G.name_crops(crops, DOC, "rank" if "rank" in crops.columns else "region").where(F.col("data").isNotNull())
    return E.fine_crops(named, _backend(ctx, "detector", "fine_detector.model"), DOC, tuple(ctx.get("fine_detector.scale")), ctx.get("fine_detector.model"))


@STAGES.register("column_expander")
def column_expander(crops: DataFrame, ctx: Context) -> DataFrame:
    options = R.GutterOptions(**ctx.get("column_expander"))
    return E.map_pixels(_named(crops), lambda p, r: R.widen(p, options, seed=R.seed_of(r.doc_id, r.name)) if r.label == "region" else p)


@STAGES.register("preprocessor")
def preprocessor(crops: DataFrame, ctx: Context) -> DataFrame:
    return E.map_pixels(crops, lambda p, r: R.pad_white(p) if 0.1 <= p.shape[1] / p.shape[0] <= 10 else p)


@STAGES.register("ocr")
def ocr(crops: DataFrame, ctx: Context) -> DataFrame:
    second = BACKENDS.get(f"recogniser:{name}") if (name := ctx.get("ocr.second")) else None
    return recognise_pictures(_named(crops), _backend(ctx, "recogniser", "ocr.model"), second, threads=int(ctx.get("ocr.threads")), timeout=ctx.get("ocr.timeout"), names=(ctx.get("ocr.model"), name))


def _turned(results: DataFrame, ctx: Context) -> DataFrame:
    """Blocks with lines the way they are likelier, if there is a lexicon: one that can be broadcast goes to the workers, a larger one is used in shards."""
    path, name = ctx.get("postprocessor.lexicon"), ctx.get("postprocessor.segmenter")
    segment = {"dictionary": D.segment_dictionary, "words": D.segment_words}[name]
    if not path:
        return results
    words = ctx.cut(D.lexicon_rows(results.sparkSession, path), "lexicon")
    most = int(ctx.get("postprocessor.broadcast_words"))
    if name == "dictionary" and words.limit(most + 1).count() > most:
        return D.fix_direction_by_table(results, "blocks", words, ctx.written(results), most)
    return D.fix_direction(results, "blocks", D.Judge({r.token: r.freq for r in words.collect()}, segment))


@STAGES.register("postprocessor")
def postprocessor(results: DataFrame, ctx: Context) -> DataFrame:
    """A row per document with its annotated Markdown. Results that are null are left out; so are documents without any.

    A crop's label is its own; with ``positional_labels`` it is looked up by position, with the shifts that this has.
    """
    if ctx.get("postprocessor.positional_labels"):
        results = P.positional_labels(results.withColumn("there", F.col("blocks").isNotNull()), DOC, "big_no", "sub_no", "label", "there")
    else:
        results = results.withColumns({"format_label": F.col("label"), "group_label": F.col("label")})
    there = _turned(results.where(F.col("blocks").isNotNull()), ctx)
    said = F.array_join(F.transform("blocks", lambda b: b["content"]), "\n\n")
    is_title = lambda c: F.coalesce(F.col(c) == "title", F.lit(False))
    pieces = there.withColumn("title", is_title("group_label")).withColumn("text", F.when(is_title("format_label") & (said != ""), T.format_title(said)).otherwise(said))
    pieces = ctx.cut(pieces.select(DOC, "big_no", F.coalesce("sub_no", F.lit(0)).alias("seq"), "title", "text", "bx1", "by1", "bx2", "by2"), "pieces")
    boxes = pieces.select(DOC, "big_no", F.col("bx1").alias("x1"), F.col("by1").alias("y1"), F.col("bx2").alias("x2"), F.col("by2").alias("y2")).distinct()
    return P.add_markers(P.group_crops(pieces, DOC, "big_no", "seq", "title", "text"), boxes, DOC, "big_no")


@STAGES.register("reorder")
def reorder(docs: DataFrame, ctx: Context) -> DataFrame:
    o = ctx.get("reorder")
    docs = ctx.cut(docs, "annotated")
    options = ChainOptions(o["left"], o["diagonal"], o["below"], o["least"], o["decay"])
    load = S.scorer_of(o["model"])
    if o.get("weights"):
        load = partial(load, o["weights"])
    final = S.reorder_markdown(docs, DOC, "markdown", load, o["model"], ctx.scratch, options)
    return docs.join(final, DOC, "left")


@STAGES.register("aggregator")
def aggregator(docs: DataFrame, ctx: Context) -> DataFrame:
    """doc_id and its final text; written below ``aggregator.output`` if that is set.

    Pages of one document (pages with document and page_no) are joined by blank lines in their order, and doc_id is the
    document then. In a permissive run there is also a row for each page or document with an error, which tells it.
    """
    final = F.col("final") if "final" in docs.columns else F.lit(None).cast("string")
    out = docs.select(DOC, F.coalesce(final_text(final, F.col("markdown")), F.lit("")).alias("markdown"))
    if "errors" in ctx.tables:
        failed = ctx.tables["errors"].withColumnRenamed(DOC, "_failed")
        out = out.join(failed, F.col(DOC).eqNullSafe(F.col("_failed")), "full").select(F.coalesce(DOC, "_failed").alias(DOC), F.coalesce("markdown", F.lit("")).alias("markdown"), "error")
    if {"document", "page_no"} <= set(ctx.tables["pages"].columns if "pages" in ctx.tables else ()):
        out = join_pages(out, ctx.tables["pages"])
    if root := ctx.get("aggregator.output"):
        out = ctx.cut(out, "final")
        ctx.values["written"] = write_markdown(out, root, DOC)
    return out


def join_pages(texts: DataFrame, pages: DataFrame) -> DataFrame:
    """A row per document of pages' texts (doc_id, markdown and maybe error); doc_id is the document's. pages: doc_id, document, page_no."""
    of = pages.select(F.col(DOC).alias("_page"), "document", "page_no")
    rows = texts.join(of, F.col(DOC).eqNullSafe(F.col("_page")))
    parts = F.sort_array(F.collect_list(F.when(F.col("markdown") != "", F.struct("page_no", F.col("markdown").alias("t")))))
    errors = F.sort_array(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("page_no", F.col("error").alias("t"))))) if "error" in texts.columns else None
    said = lambda rows, sep: F.array_join(F.transform(rows, lambda r: r["t"]), sep)
    made = [said(parts, "\n\n").alias("markdown"), *([F.nullif(said(errors, "\n"), F.lit("")).alias("error")] if errors is not None else [])]
    return rows.groupBy(F.col("document").alias(DOC)).agg(*made)


#: The stages above, in their order.
ORDER = [n for n in STAGES.names() if getattr(STAGES.get(n), "__module__", None) == __name__]
DEFAULTS["pipeline"]["stages"] = ORDER


def page_pipeline(stages: list[str] | None = None, skip: list[str] | None = None, **config) -> Pipeline:
    """The default pipeline: DEFAULTS, then the environment, then what is given by section."""
    return Pipeline(stages, Config.load(DEFAULTS, path=config.pop("path", None), runtime=config), skip or [])
