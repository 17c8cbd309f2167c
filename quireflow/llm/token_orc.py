"""Token ids as ORC files.

Documents are range-partitioned and sorted by doc_id, encoded in that order, and written by Spark's ORC writer: ids are
integer columns, which ORC stores run-length encoded in stripes; the row index holds minima and maxima of doc_id for every
``stride`` rows, and Bloom filters on doc_id let a reader skip whole groups of rows. A reader gets a stripe per split, and a
filter on doc_id is pushed down to the stripes' metadata. A document's place in its file is stored with it; the places in
the whole sequence follow from one sum per file.

The number of files follows the bytes of text. Rows that share a doc_id, or have none, are told apart by a hash of their text
and their place, so that no file gets all of them.

Defined cases: a null text is empty; an empty text still has its end id. A null doc_id sorts first; repeated doc_ids sort
by a hash of their text. An empty table gives an empty result. Other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.llm.common import Scratch, numbered, small_batches
from quireflow.llm.tokens import encoder

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
#: A batch that goes back to Spark holds about so many ids.
BATCH_IDS = 1 << 20
#: Bytes of text of a file at most, about, and at least where there are cores to spare.
FILE_BYTES, LEAST_FILE_BYTES = 128 << 20, 8 << 20


def files_for(text_bytes: int, cores: int) -> int:
    """Files of FILE_BYTES; more of them where all cores could not work otherwise, of LEAST_FILE_BYTES then."""
    return max(1, -(-text_bytes // FILE_BYTES), min(4 * cores, -(-text_bytes // LEAST_FILE_BYTES)))


def write_token_orc(docs: DataFrame, path: str, vocabulary: str, *, kind: str = "word", end_id: int = 2, stride: int = 1000, stripe_mb: int = 16, files: int | None = None) -> None:
    """Writes ids of every document in ascending doc_id order to ORC files at ``path``; file k holds smaller ids than file k+1."""
    scratch = Scratch(docs.sparkSession, "orc-input")
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, one = TaskContext.get().partitionId(), 0, encoder(vocabulary, kind).encode
        doc, starts, sizes, held, n = [], [], [], [], 0

        def batch() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(held), "<u4").astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array([part] * len(doc), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), ids], SCHEMA.names)

        for b in small_batches(batches):
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = one(text) + end
                doc.append(i), starts.append(at), sizes.append(len(ids) // 4), held.append(ids)
                at, n = at + sizes[-1], n + sizes[-1]
                if n >= BATCH_IDS:
                    yield batch()
                    doc, starts, sizes, held, n = [], [], [], [], 0
        if doc:
            yield batch()

    lean = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = lean.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0][0]
    parts = files or files_for(size, docs.sparkSession.sparkContext.defaultParallelism)
    keyed = numbered(lean, scratch, "place").withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("place")]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    options = {"compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": str(stride), "orc.stripe.size": str(stripe_mb << 20), "orc.create.index": "true"}
    ordered.mapInArrow(encode, SCHEMA).write.options(**options).orc(path)
    scratch.drop(*list(scratch.held))


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files (doc_id, part, at, n_tokens, ids); with doc_ids, only those, found by pruning stripes and row groups."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(list(doc_ids)))


def token_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows as read_token_orc gives them; start is the place in the whole sequence."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))  # one row per file
    base = totals.select("part", F.coalesce(F.sum("_sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("_base"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n = b.column(3), b.num_rows
            values, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(values[offsets[k] : offsets[k + 1]].tobytes()) for k in range(n)]
            count = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), count, pa.array(crc, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    each = rows.select("doc_id", "part", "at", "ids").mapInArrow(digest, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return each.join(F.broadcast(base), "part").select("doc_id", (F.col("_base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_ids_digest(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Writes the files to scratch, reads them back, and gives their digest; the files go when the digest is there."""
    scratch = Scratch(docs.sparkSession, "token-orc")
    write_token_orc(docs, path := scratch.path("orc"), vocabulary, **options)
    return scratch.finish(token_digest(read_token_orc(docs.sparkSession, path)))
