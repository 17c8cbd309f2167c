"""SentencePiece encoding and decoding by a table of distinct chunks.

A BPE model whose pieces hold the white-space marker at their beginning only never merges across the start of a run of
markers, nor around a character that no longer piece holds. So a text, with the marker that the model puts in front, falls
apart into chunks (a run of spaces and what follows it, or a line break and what follows it) whose ids don't depend on each
other. ``chunk_counts`` counts the distinct chunks, locally first; ``chunk_table`` has the library segment each of them once;
``encode_documents`` puts the ids of a text's chunks together by their position.

The table goes to every task, so it is bounded: the MOST_CHUNKS most frequent chunks of at most LONGEST characters that occur
twice or more. A chunk outside of it (one that occurs once, or beyond the bound, or a longer one) is segmented by the
library where it lies; no text is shuffled. Exact for every text.

``load`` refuses a model that normalises, or has pieces that cross markers, as chunks are not independent then.

Defined cases: a null or empty text has no ids and decodes to the empty text; a marker character in a text is a space to the
model, and is decoded as one. Repeated rows and repeated or null ids are encoded each by itself. Extra columns go through,
except those named like the results, which are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.llm.common import Scratch, ship, small_batches, worker_forget, worker_kept

MARKER = "▁"
#: Distinct chunks that are broadcast at most, the longest of them, and chunks that a worker counts or keeps besides them.
MOST_CHUNKS, LONGEST, KEPT = 500_000, 48, 300_000
#: Rows of texts that a worker handles at once.
ROWS = 64
_CHUNKS = re.compile(r" +[^ \n]*|\n[^ \n]*").findall


def chunks_of(text: str) -> list[str]:
    """The chunks of a text with the space that the model puts in front; they join to it. None of an empty text."""
    return _CHUNKS(" " + text.replace(MARKER, " ")) if text else []


class Segmenter:
    """The library's ids of chunks, and texts of ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        plain = [p for p in range(n) if not (self.library.is_byte(p) or self.library.is_control(p) or self.library.is_unknown(p))]
        names = {p: self.library.id_to_piece(p) for p in plain}
        if any(MARKER in x.lstrip(MARKER) or "\n" in x for x in names.values()):
            raise ValueError("pieces cross white space, so chunks can't be segmented by themselves")
        if any(self.library.decode(self.library.encode(x)) != x for x in ("a  b ", " ａ½　")):
            raise ValueError("the model normalises texts")
        self.space = self.library.piece_to_id(MARKER)
        parts = [b"" if self.library.is_control(p) else bytes([int(self.library.id_to_piece(p)[3:5], 16)]) if self.library.is_byte(p) else names.get(p, "").replace(MARKER, " ").encode() for p in range(n)]
        self.size = np.array([len(x) for x in parts], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        # a space that is spelt as a byte is not the one that the model puts in front
        self.odd = np.array([self.library.is_control(p) or self.library.is_unknown(p) or (self.library.is_byte(p) and parts[p] == b" ") for p in range(n)])

    def ids(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian signed 32-bit integers. The library puts a space in front of what it is given."""
        if chunk[0] == "\n":
            got = self.library.encode(chunk)[1:]
        else:
            got = self.library.encode(chunk[1:]) if len(chunk) > 1 else [self.space]
        return np.array(got, "<i4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The library's text of ids. What is valid UTF-8 is put together from the pieces, anything else is the library's."""
        if not len(ids):
            return ""
        size = self.size[ids]
        first = np.cumsum(size) - size
        body = self.bytes[np.repeat(self.at[ids] - first, size) + np.arange(int(size.sum()))].tobytes()
        if not self.odd[ids].any():
            try:
                return (body[1:] if body[:1] == b" " else body).decode()
            except UnicodeDecodeError:
                pass
        return self.library.decode(ids.tolist())


class Table(dict):
    """Chunks to ids; a chunk that is not there is segmented, and kept while there is room."""

    def __init__(self, held: dict[str, bytes], segmenter: Segmenter) -> None:
        super().__init__(held)
        self.segmenter, self.extra = segmenter, []

    def __missing__(self, chunk: str) -> bytes:
        ids = self.segmenter.ids(chunk)
        if len(chunk) <= LONGEST:
            if len(self.extra) >= KEPT:
                for x in self.extra:
                    del self[x]
                self.extra = []
            self[chunk] = ids
            self.extra.append(chunk)
        return ids


def load(path: str) -> Segmenter:
    """A worker's segmenter of a model file."""
    return worker_kept(f"pieces:{path}", lambda: Segmenter(path))


def chunk_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """chunk, n: how often each distinct chunk of at most LONGEST characters occurs. Each task sums its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_forget()
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            some = [(k, n) for k, n in held.items() if len(k) <= LONGEST]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["chunk", "n"])

        for b in small_batches(batches, ROWS):
            for t in b.column(0).to_pylist():
                held.update(chunks_of(t))
            if len(held) > KEPT:
                yield out()
                held.clear()
        yield out()

    ship(docs.sparkSession)
    local = docs.where(F.length(text) > 0).select(F.col(text).cast("string").alias("text")).mapInArrow(count, "chunk string, n long")
    return local.groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(counts: DataFrame, path: str, scratch: Scratch, most: int = MOST_CHUNKS) -> pa.Table:
    """chunk, ids: at most ``most`` of the chunks that occur twice or more, the most frequent ones. The library sees each of them once.

    Which are the most frequent is told by a histogram of the logarithms of the counts, so chunks are never sorted, and of the
    counts that only fit in part none are taken.
    """
    level = F.floor(F.log2("n") * 8).cast("int")
    counts = scratch.cut(counts.where("n > 1").withColumn("level", level), "chunks")
    room, least = most, None
    for r in sorted(counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r.n
        if room < 0:
            break
        least = r.level
    if least is None:
        return pa.table({"chunk": pa.array([], pa.string()), "ids": pa.array([], pa.binary())})

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([segmenter.ids(x) for x in b.column(0).to_pylist()], pa.binary())], ["chunk", "ids"])

    return counts.where(F.col("level") >= least).select("chunk").mapInArrow(segment, "chunk string, ids binary").toArrow()


def encode_documents(docs: DataFrame, path: str, text: str = "text", most: int = MOST_CHUNKS, ids: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """docs with each text's ids (an array) and, if it is named, the text that the ids decode to."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "pieces")
    table = chunk_table(chunk_counts(docs, text), path, scratch, most)
    scratch.drop(*list(scratch.held))
    packed, key = spark.sparkContext.broadcast(table.to_pydict()), f"chunks:{uuid.uuid4().hex}"
    made = [ids, *([decoded] if decoded else [])]
    # the columns in a struct, so that no name of theirs can clash
    own = [c for c in docs.columns if c not in made]
    whole = docs.select((F.struct(*(F.col(f"`{c}`") for c in own)) if own else F.struct(F.lit(0).alias("none"))).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = worker_kept(key, lambda: Table(dict(zip(packed.value["chunk"], packed.value["ids"], strict=True)), Segmenter(path)))
        for b in small_batches(batches, ROWS):
            parts = [b"".join(map(chunks.__getitem__, chunks_of(t))) for t in b.column(1).to_pylist()]
            flat = np.frombuffer(b"".join(parts), "<i4")
            ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
            out = [b.column(0), pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, pa.int32())).cast(pa.list_(pa.int32()))]
            if decoded:
                out.append(pa.array([chunks.segmenter.decode(flat[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["doc", "ids", "decoded"][: len(out)])

    kind = T.StructType([whole.schema["doc"], T.StructField("ids", T.ArrayType(T.IntegerType())), *([T.StructField("decoded", T.StringType())] if decoded else [])])
    out = whole.mapInArrow(encode, kind)
    return out.select(*(F.col(f"doc.`{c}`") for c in own), F.col("ids").alias(ids), *([F.col("decoded").alias(decoded)] if decoded else []))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """docs with the text that the array ``ids`` decodes to; null stays null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def decode(rows):
        segmenter = load(path)
        return rows.map(lambda x: segmenter.decode(np.asarray(x, np.int64)), na_action="ignore")

    return docs.withColumn(decoded, decode(F.col(ids)))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas), decoded_sha256."""
    out = encode_documents(docs.select("doc_id", "text"), path)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))
