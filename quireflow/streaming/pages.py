"""Page files as they arrive: the batch stages on each micro-batch, and files that a repeated batch doesn't change."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quireflow.plans.registry import BACKENDS, Pipeline
from quireflow.sources.datasource import SCHEMA, SUFFIXES, Splitter, batch_done, split_pages
from quireflow.sources.pages import write_markdown
from quireflow.tables import ship

FILES = "path string, modificationTime timestamp, length long, content binary"


def process_stream(spark: SparkSession, path: str, schema: str, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies ``plan`` to each micro-batch of Parquet rows that arrive at ``path``; a batch that is run again overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pages_of(files: DataFrame, splitters: dict[str, Splitter] | None = None) -> DataFrame:
    """doc_id, document, page_no, path, content of rows of path and content, as ``read_pages`` has them.

    A stream doesn't know the files that are still to come, so a document is always named by the file's whole name.
    """
    held = dict(splitters or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                name = path.rpartition("/")[2]
                pages = split_pages(bytes(content), name.rpartition(".")[2].lower(), held)
                for k, page in enumerate(pages):
                    yield pd.DataFrame({"doc_id": [name if len(pages) == 1 else f"{name}/{k}"], "document": [name], "page_no": [k], "path": [path], "content": [page]})

    ship(files.sparkSession)
    return files.where(F.col("content").isNotNull()).select("path", "content").mapInPandas(run, SCHEMA)


def process_batch(files: DataFrame, number: int, pipeline: Callable[[], Pipeline], out: str, splitters: dict[str, Splitter] | None = None) -> None:
    """Runs a pipeline over one batch of files and writes out/name/name.md. A batch that has been written before is passed over; its tables in the shared folder go in any case."""
    if batch_done(out, str(number)):
        return
    made = pipeline()
    try:
        # the stages read the pages twice, and a stream's batch may be read from its source anew each time
        pages = made.context.cut(pages_of(files, splitters), "arrived")
        texts = made.run(pages)
        every = pages.select(F.col("document").alias("doc_id")).distinct()
        write_markdown(every.join(texts, "doc_id", "left"), out, batch=str(number))
    finally:
        made.context.close()


def process_pages(spark: SparkSession, path: str, out: str, checkpoint: str, pipeline: Callable[[], Pipeline], splitters: dict[str, Splitter] | None = None, files_per_batch: int = 1000, **trigger) -> StreamingQuery:
    """Reads page files as they arrive in a folder, and writes their Markdown, a micro-batch after the other.

    ``pipeline`` makes a fresh pipeline for each batch. A document without any text gets an empty file. Without a trigger,
    what is there is processed and the query ends.
    """
    known = {n.split(":", 1)[1]: BACKENDS.get(n)() for n in BACKENDS.names() if n.startswith("splitter:")} | dict(splitters or {})
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch).load(path)
    wanted = files.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin([*SUFFIXES, *known]))
    run = lambda batch, number: process_batch(batch, number, pipeline, out, known)
    return wanted.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
