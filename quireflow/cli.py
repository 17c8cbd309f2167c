"""Command line: page files in, root/name/name.md out.

python -m quireflow.cli -i PAGES -o ROOT [-c CONFIG] [-d] [-v] [--skip A,B] [--only A,B] [--ignore_labels A,B] [--plugins MODULE,...]
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quireflow.plans.registry import BACKENDS, Config, LayoutError, Pipeline, setup_logging
from quireflow.plans.stages import DEFAULTS
from quireflow.sources.pages import read_pages, write_crop_pictures, write_crop_texts, write_markdown, write_outlines


def listed(raw: str | None) -> list[str] | None:
    """The names of a comma-separated option; None without any."""
    names = [name for part in (raw or "").split(",") if (name := part.strip())]
    return names or None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quireflow", description="Page files to Markdown in reading order")
    p.add_argument("-i", "--img_path", required=True, help="a page file, or a folder of them")
    p.add_argument("-o", "--output_path", required=True, help="root folder of the Markdown files")
    p.add_argument("-c", "--config", help="YAML file")
    p.add_argument("-d", "--debug", action="store_true", help="also write the annotated Markdown, outlines of boxes, and each crop's text")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("--skip", help="stages to pass over")
    p.add_argument("--only", help="stages to run, instead of all")
    p.add_argument("--ignore_labels", default="header,advert", help="labels of regions that are left out")
    p.add_argument("--plugins", help="modules that register models and stages")
    return p


def write_debug(pipeline: Pipeline, root: str) -> None:
    """What stages left, as far as they ran."""
    held, ctx = pipeline.results, pipeline.context
    if "postprocessor" in held:
        write_markdown(held["postprocessor"], root, suffix="_with_bbox")
    if "ocr" in held:
        write_crop_texts(held["ocr"], root)
    if "pages" in ctx.tables:
        decode, thickness = BACKENDS.get(f"decoder:{ctx.get('source.decoder')}")(), int(ctx.get("source.outline", 8))
        if "coarse_detector" in held:
            ranked = held.get("sorter", held["coarse_detector"])
            write_outlines(ctx.tables["pages"], ranked, root, "coarse_detector", decode, thickness=thickness, order="rank" if "rank" in ranked.columns else "region")
        if "fine_detector" in held:
            write_outlines(ctx.tables["pages"], held["fine_detector"], root, "fine_detector", decode, thickness=thickness, edge=(0, 0, 255), ink=(255, 255, 255))
    for stage, suffix in (("fine_detector", ""), ("preprocessor", "_processed")):
        if stage in held and "name" in held[stage].columns:
            write_crop_pictures(held[stage], root, suffix)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 if there is no such path or no page. A document whose models fail has an empty file, and is not counted among those with text."""
    args = parser().parse_args(argv)
    log = setup_logging("DEBUG" if args.verbose else "INFO")
    for module in listed(args.plugins) or []:
        importlib.import_module(module)
    chosen = {"skip_stages": listed(args.skip), "stages": listed(args.only)}
    runtime: dict = {"pipeline": {k: v for k, v in chosen.items() if v}, "crop_filter": {"ignore_labels": listed(args.ignore_labels) or []}}
    own = spark is None
    spark = spark or SparkSession.builder.appName("quireflow").getOrCreate()
    try:
        config = Config.load(DEFAULTS, path=args.config, runtime=runtime)
        pages = read_pages(spark, args.img_path)
        documents = pages.select(F.col("document").alias("doc_id")).distinct()
        n = documents.count()
        if not n:
            log.error("found nothing to read at %s", args.img_path)
            return 1
        pipeline = Pipeline(config=config)
        texts = pipeline.run(pages)
        out = documents.join(texts, "doc_id", "left").withColumn("markdown", F.coalesce("markdown", F.lit("")))
        out = pipeline.context.cut(out, "written")
        write_markdown(out, args.output_path)
        if args.debug:
            write_debug(pipeline, args.output_path)
        done = out.where("markdown <> ''").count()
        log.info("wrote %s: %d documents, of which %d have text", args.output_path, n, done)
        return 0
    except LayoutError as e:
        log.error("%s", e)
        return 1
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
