"""Quality rules: base measures of a text, and cross-document line frequency.

Lines are normalised (A-Z lower-cased, digits to 0, white space collapsed) and hashed. For each host (here: the source) a
line's distinct documents are counted, documents of equal text once. A line found in more than ``max_docs`` of them, and in
more than ``max_share`` of the host's, is boilerplate and removed; a document that keeps less than ``least_left`` of its
words is depleted and rejected. Counting is a partial aggregation, so a line that every document has costs one row per task.

Defined cases: a null or empty text has no words and fails; a null source is a host of its own; repeated rows are judged
each by itself. Blank lines are never boilerplate. Extra columns go through, except those named like the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, numbered, small_batches, worker_forget

MAX_DOCS, MAX_SHARE, LEAST_LEFT = 10, 0.02, 0.2
#: So many boilerplate lines are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_LINES = 2_000_000
_BLANKS, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", b"abcdefghijklmnopqrstuvwxyz0000000000")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of ``width`` words that occur twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = np.zeros(n, np.uint64)
    for k in range(width):
        w += (h[k : k + n] ^ (h[k : k + n] >> np.uint64(29))) * _ODD[k % 5] * np.uint64(2 * (k // 5) + 1)
    s = np.sort(w)
    twice = s[1:] == s[:-1]
    if not twice.any():
        return 0
    hit = np.isin(w, s[1:][twice])
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """Signed 64-bit hash of a normalised line."""
    h = xxhash.xxh3_64_intdigest(b" ".join(words).translate(_NORMAL))
    return h - (1 << 64) if h >> 63 else h


def measure(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, text hash, line hashes, words of each such line."""
    data = text.encode("utf-8", "surrogatepass")
    words, seen, dup, lines = [], set(), 0, {}
    for line in data.split(b"\n"):
        own = line.split()
        if own:
            words += own
            if line in seen:
                dup += 1
            seen.add(line)
            h = line_hash(own)
            lines[h] = lines.get(h, 0) + len(own)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    whole = xxhash.xxh3_64_intdigest(data)
    return len(words), chars, len(data) - len(data.translate(None, _SYMBOLS)), dup, repeated_words(words), whole - (1 << 64) if whole >> 63 else whole, list(lines), list(lines.values())


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, _text long, _lines array<long>, _line_words array<long>"
NAMES = [x.split()[0] for x in MEASURES.split(", ")]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source and a row id with the measures of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_forget()
        for b in small_batches(batches):
            got = list(zip(*[measure(t or "") for t in b.column(3).to_pylist()], strict=True))
            if got:
                arrays = [pa.array(c, pa.int64()) for c in got[:6]] + [pa.array(c, pa.list_(pa.int64())) for c in got[6:]]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *arrays], ["_row", "doc_id", "source", *NAMES])

    lean = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return lean.mapInArrow(run, f"_row long, doc_id long, source string, {MEASURES}")


def boilerplate_lines(rows: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """(source, line) of lines above the limits, of rows as ``measured`` gives them."""
    lines = rows.select("source", "_text", F.explode("_lines").alias("line")).distinct().groupBy("source", "line").agg(F.count(F.lit(1)).alias("docs"))
    hosts = rows.select("source", "_text").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("all_docs"))
    lines, hosts = lines.where(F.col("docs") > max_docs).alias("l"), hosts.alias("h")
    return lines.join(hosts, F.col("l.source").eqNullSafe(F.col("h.source"))).where(F.col("docs") > F.col("all_docs") * F.lit(max_share)).select("l.source", "line")


def _key(source: str | None, line: np.ndarray) -> np.ndarray:
    salt = xxhash.xxh3_64_intdigest(b"\x00" if source is None else b"\x01" + source.encode("utf-8", "surrogatepass"))
    return (line.astype(np.int64).view(np.uint64) ^ np.uint64(salt)) * _ODD[0]


def _listed(found: DataFrame) -> np.ndarray:
    """Sorted keys of (source, line); 8 bytes each."""
    parts = [_key(None if s != s or s is None else s, g["line"].to_numpy()) for s, g in found.toPandas().groupby("source", dropna=False)]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *parts]))


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among sorted keys: a binary search each, whatever the number of keys."""
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def judge_documents(docs: DataFrame, *, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_left, base_failed, kept.

    Up to ``broadcast_lines`` boilerplate lines reach every worker; more are joined on (source, line), with equal results.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rows = scratch.cut(measured(docs), "measures")
    found = scratch.cut(boilerplate_lines(rows, max_docs, max_share), "boilerplate")
    if found.count() <= broadcast_lines:
        held = spark.sparkContext.broadcast(_listed(found))

        def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = held.value
            names = ["doc_id", *NAMES[:5]]
            for b in batches:
                out = []
                for source, lines, words in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    own = _key(source, lines.values.to_numpy(zero_copy_only=False))
                    out.append(int(words.values.to_numpy(zero_copy_only=False)[~_among(own, keys)].sum()) if len(own) else 0)
                yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[4:], pa.array(out, pa.int64())], [*names, "words_left"])

        picked = rows.select("doc_id", "source", "_lines", "_line_words", *NAMES[:5])
        out = picked.mapInArrow(left, "doc_id long, " + ", ".join(MEASURES.split(", ")[:5]) + ", words_left long")
    else:
        each = rows.select("_row", "source", F.explode(F.arrays_zip(F.col("_lines").alias("line"), F.col("_line_words").alias("words"))).alias("x")).select("_row", "source", "x.line", "x.words").alias("e")
        f = found.alias("f")
        gone = each.join(f, F.col("e.source").eqNullSafe(F.col("f.source")) & (F.col("e.line") == F.col("f.line"))).groupBy("e._row").agg(F.sum("e.words").alias("_gone"))
        out = rows.join(gone, "_row", "left").select("doc_id", *NAMES[:5], (F.col("n_words") - F.coalesce("_gone", F.lit(0))).alias("words_left"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("words_left") >= F.lit(least_left) * F.col("n_words")))
    return scratch.finish(out)


def clean_documents(docs: DataFrame, *, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """docs without rejected documents and without boilerplate lines; n_chars, if there, follows the text.

    Up to ``broadcast_lines`` boilerplate lines reach every worker, so each text is judged where it is read. Above that,
    each document's own boilerplate lines are found by a join on (source, line) and handed to the same judgement.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "clean")
    rows = scratch.cut(measured(docs), "measures")
    found = scratch.cut(boilerplate_lines(rows, max_docs, max_share), "boilerplate")
    scratch.drop("measures")
    # the columns in a struct, so that no name of theirs can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    text = F.col("doc.text").cast("string")

    def judged(text: str | None, drop) -> str | None:
        """The text that stays, or None for a rejected document. drop tells of an array of line hashes which ones go."""
        n, _, _, _, repeated, _, lines, words = measure(text or "")
        if n < 10 or 100 * repeated > 20 * n:
            return None
        gone = drop(np.array(lines, np.int64))
        if n - int(np.array(words, np.int64)[gone].sum()) < least_left * n:
            return None
        if not gone.any():
            return text
        out = {h for h, x in zip(lines, gone.tolist(), strict=True) if x}
        return "\n".join(x for x in text.split("\n") if not (own := x.encode("utf-8", "surrogatepass").split()) or line_hash(own) not in out)

    if found.count() <= broadcast_lines:
        held = spark.sparkContext.broadcast(_listed(found))
        scratch.drop("boilerplate")

        @F.pandas_udf("string")
        def cleaned(text, source):
            import pandas as pd

            worker_forget()
            return pd.Series([judged(t, lambda x: _among(_key(s, x), held.value)) for t, s in zip(text, source, strict=True)], dtype=object)  # noqa: B023

        # named nondeterministic, as the filter on its result would otherwise call it a second time, in workers of its own
        out = whole.withColumn("new", cleaned.asNondeterministic()(text, F.col("doc.source").cast("string")))
    else:
        # row ids must be the same when the texts are read again
        kept = numbered(whole, scratch, "row")
        own = measured(kept.select(F.col("row").alias("doc_id"), F.col("doc.source").alias("source"), text.alias("text")))
        each = own.select(F.col("doc_id").alias("at"), "source", F.explode("_lines").alias("line")).alias("e")
        f = found.alias("f")
        gone = each.join(f, F.col("e.source").eqNullSafe(F.col("f.source")) & (F.col("e.line") == F.col("f.line")), "left_semi")
        gone = scratch.cut(gone.groupBy("at").agg(F.sort_array(F.collect_list("line")).alias("gone")), "gone")  # of one document's own lines
        scratch.drop("boilerplate")

        @F.pandas_udf("string")
        def cleaned_by_row(text, gone):
            import pandas as pd

            worker_forget()
            lists = [np.zeros(0, np.int64) if g is None else np.asarray(g, np.int64) for g in gone]
            return pd.Series([judged(t, lambda x: _among(x, g)) for t, g in zip(text, lists, strict=True)], dtype=object)  # noqa: B023

        joined = kept.join(gone, F.col("row") == F.col("at"), "left")
        out = joined.withColumn("new", cleaned_by_row.asNondeterministic()(text, F.col("gone")))
    made = {"text": F.col("new").alias("text"), "n_chars": F.length("new").cast("long").alias("n_chars")}
    return out.where("new IS NOT NULL").select(*(made.get(c, F.col(f"doc.`{c}`")) for c in docs.columns))
