"""Packing documents into fixed-size training sequences by minimum bin slack.

Pieces of one length are interchangeable, so the packing is planned on the histogram of lengths, of at most ``capacity``
entries whatever the corpus holds. For each bin, bitset subset-sum dynamic programming over the lengths still there finds
the fullest combination that holds the longest of them; the combination is removed as often as the counts allow before the
next is sought. The pieces then find their places by their rank among the pieces of their length: a bucketed rank, so that a
length that a third of all pieces share is spread over many tasks.

Defined cases: a null text counts as empty; an empty text still gives one piece (its end id). A null doc_id is a document
like any other, repeated rows are separate documents, and an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, bucket_totals, buckets_for, row_count, small_batches
from quireflow.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _subset(counts: np.ndarray, seed: int, capacity: int) -> dict[int, int]:
    """The fullest combination with one piece of length ``seed``: {length: how many}. counts is left as it is."""
    room = capacity - seed
    if not room:
        return {seed: 1}
    full, mask, reach, steps = 1 << room, (1 << (room + 1)) - 1, 1, []
    for length in map(int, np.flatnonzero(counts[: room + 1])[::-1]):
        left, part = min(int(counts[length]) - (length == seed), room // length), 1
        while left > 0:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach & full:
            break
    out, at = {seed: 1}, reach.bit_length() - 1
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + part
            at -= length * part
    return out


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The bins as (combination, how many bins have it). Each combination is repeated until some length in it gets too rare."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    longest = capacity
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return plan
        combination = _subset(counts, longest, capacity)
        times = min(int(counts[length]) // n for length, n in combination.items())
        for length, n in combination.items():
            counts[length] -= n * times
        plan.append((combination, times))


def _places(plan: list[tuple[dict[int, int], int]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks of a length, sorted by (length, first rank): which bins they go to, how many share a bin, and where they begin in it."""
    taken, rows, base = np.zeros(capacity + 1, np.int64), [], 0
    for combination, times in plan:
        offset = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            rows.append((length, taken[length], base, n, offset))
            taken[length] += n * times
            offset += n * length
        base += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"length": a[:, 0], "rank": a[:, 1], "base": a[:, 2], "each": a[:, 3], "offset": a[:, 4]}


def token_pieces(docs: DataFrame, vocabulary: str, kind: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece with its ids' CRC. A document of more than ``capacity`` ids is cut; its first piece is the short one."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, kind).encode
        for b in small_batches(batches, 2048):
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                n, at, k = len(ids) // 4, 0, 0
                size = n % capacity or min(n, capacity)
                while at < n:
                    doc.append(i), piece.append(k), start.append(at), length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, k, size = at + size, k + 1, capacity
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def place_pieces(pieces: DataFrame, scratch: Scratch, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (a cut table with doc_id, piece, length and any other columns)."""
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan_bins(histogram, capacity), capacity))
    n = buckets_for(sum(histogram.values()))
    # by a row's place, as many rows may be equal
    bucketed = pieces.withColumn("_place", F.monotonically_increasing_id()).withColumn("_bucket", F.pmod(F.xxhash64("_place"), F.lit(n)).cast("int"))
    order = Window.partitionBy("length", "_bucket").orderBy("_place")
    ranked = bucketed.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    ranked = ranked.join(bucket_totals(bucketed, ["length"], "_bucket", F.lit(1), "_before").hint("shuffle_merge"), ["length", "_bucket"])
    ranked = scratch.cut(ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_bucket", "_before", "_place"), "ranked")
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        width = int(p["rank"].max(initial=0)) + 1
        keys = p["length"] * width + p["rank"]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            k = np.searchsorted(keys, length * width + np.minimum(rank, width - 1), side="right") - 1
            into = rank - p["rank"][k]
            sequence, offset = p["base"][k] + into // p["each"][k], p["offset"][k] + into % p["each"][k] * length
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, *, kind: str = "byte", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece. See the module for the rules."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.cut(token_pieces(docs, vocabulary, kind, capacity, end_id), "pieces")
    if not row_count(pieces):
        return scratch.finish(pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}))
    out = place_pieces(pieces, scratch, capacity)
    return scratch.finish(out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
