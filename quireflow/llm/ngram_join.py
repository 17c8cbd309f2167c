"""Exact Jaccard join of documents' word n-gram sets by token-combination prefixes.

A token is an n-gram. One pass counts every token's documents; tokens fall into three classes by that count: unique (one
document; such tokens can't be shared), rare (at most ``frequent`` documents) and frequent. Sets are ordered by class, then
by hash. Two sets that are similar enough share a token in their prefixes, so

* a document whose prefix is all unique has no partner and gives no signature;
* rare tokens of the prefix are signatures by themselves;
* where the prefix reaches the frequent class it is extended so far that similar sets without a shared rare token have two
  shared frequent tokens next to each other: each such 2-token combination is a signature.

The last rule needs one more shared token than there are differing ones, and one beyond that. Similar sets of which this
can't be said are small (``short_sets``); they give their frequent prefix tokens one by one too. Below 51 percent there is
no such bound, and a ValueError is raised.

Counting is a shuffle of sorted, truncated hashes, coded as gaps, by parts of the hash range; each chunk of documents gets
back its tokens' classes as bits. Nothing of that is broadcast, and the hash's width and the number of parts follow the
corpus, so the unique class does not fill up with it. A chunk speaks to 1 << LEVEL_BITS parts only. Where there are more,
chunks are first brought together, 1 << LEVEL_BITS of them for one such part, and what they hold together is dealt on, so a
row stands for as many tokens at any size; the classes come back the same way.

Signatures carry a band of the set's size, as similar sets have similar sizes. Documents that share signatures form
candidate clusters (components over one star per signature, so a signature that a third of all documents share costs one
row for each). Inside a cluster, sets are first compared by parity bitmaps: a bit for each bucket of tokens, flipped by
each token. Bits that differ are at most the tokens that differ, so a pair with too many is no link. The pairs that are
left form much smaller clusters, whose sets are compared exactly by counting over an inverted index. Large clusters are
compared in pairs of blocks of bounded size; a block gives back a spanning forest, never all its pairs. Documents of equal
sets are one vertex throughout.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; fewer words than n give
one token. Null or repeated doc_ids are documents of their own; a component's id is its smallest doc_id, or null if it has
none. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, numbered, small_batches, worker_forget
from quireflow.llm.components import connected_components

#: Documents of a block and bytes that it holds of their sets (8 for a token) or bitmaps.
BLOCK, BLOCK_BYTES = 1000, 4 << 20
#: Bytes of text of a chunk of documents, bytes of text taken for one token, tokens of a part of the hash range.
CHUNK_BYTES, TOKEN_BYTES, PART_TOKENS = 3 << 20, 6, 1 << 21
#: Bits of the hash that tell the parts that one chunk, or one group of chunks, speaks to.
LEVEL_BITS = 8
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-grams of words, A-Z lower-cased. Spark fixes PYTHONHASHSEED for its workers."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    one = hash if os.environ.get("PYTHONHASHSEED", "random") != "random" else xxhash.xxh3_64_intdigest
    h = np.fromiter(map(one, words), np.int64 if one is hash else np.uint64, len(words)).view(np.uint64)
    width, out = min(n, len(words)), None
    for k in range(width):
        part = h[k : len(h) - width + 1 + k] * _ODD[k % 8] + np.uint64(k // 8)
        out = part if out is None else (out ^ (out >> np.uint64(29))) * _ODD[7] + part
    return np.unique(_mix(out + np.uint64(width)))


@dataclass(frozen=True)
class Layout:
    """How tokens are counted: bits kept of a hash, bits that tell the part on each level, documents of a chunk (as a power of two), bytes of a coded gap, chunks."""

    bits: int
    levels: tuple[int, ...]
    chunk_shift: int
    width: int
    chunks: int = 1

    @classmethod
    def of(cls, documents: int, text_bytes: int, level_bits: int | None = None, part_tokens: int | None = None) -> Layout:
        """For a corpus of that size. Of hashes that are five bits wider than the number of tokens, one in 32 unique tokens is taken for a rare one, which costs a signature and changes no result."""
        tokens, level_bits = max(1, text_bytes // TOKEN_BYTES), level_bits or LEVEL_BITS
        bits = min(64, max(24, tokens.bit_length() + 5))
        part_bits = min(bits - 1, max(min(6, level_bits), (tokens // (part_tokens or PART_TOKENS)).bit_length()))
        levels = [level_bits] * (part_bits // level_bits) + [part_bits % level_bits] * bool(part_bits % level_bits)
        chunk_shift = max(0, (CHUNK_BYTES * documents // max(1, text_bytes)).bit_length() - 1) if documents else 0
        in_chunk = min(tokens, CHUNK_BYTES // TOKEN_BYTES).bit_length()
        return cls(bits, tuple(levels), min(chunk_shift, 20), min(4, max(1, -(-(bits - in_chunk + 2) // 8))), max(1, text_bytes // CHUNK_BYTES))

    def groups(self, level: int) -> int:
        """Groups that the units of a level are brought together to, so that one holds a chunk's worth of tokens of a part."""
        return max(1, -(-self.chunks >> sum(self.levels[: level + 1])))

    def rows(self) -> int:
        """Rows that all levels send one way: for each unit one a part, where a unit is a chunk or a group's share of a part."""
        units = [self.chunks, *(self.groups(k) << sum(self.levels[: k + 1]) for k in range(len(self.levels) - 1))]
        return sum(n << b for n, b in zip(units, self.levels, strict=True))

    def short(self, tokens: np.ndarray) -> np.ndarray:
        return tokens >> np.uint64(64 - self.bits)

    def base(self, part: int, level: int) -> int:
        """The first short hash of a part of a level."""
        return part << (self.bits - sum(self.levels[: level + 1]))

    def ends(self, sorted_short: np.ndarray, level: int = 0, part: int = 0) -> np.ndarray:
        """Where each part of a level begins in the sorted short hashes of a part of the level above, and their end."""
        n, rest = self.levels[level], self.bits - sum(self.levels[: level + 1])
        starts = (np.arange(1 << n, dtype=np.uint64) + np.uint64(part << n)) << np.uint64(rest)
        return np.append(np.searchsorted(sorted_short, starts), len(sorted_short))


def pack_gaps(values: np.ndarray, base: int, width: int) -> bytes:
    """Sorted values as gaps of ``width`` bytes, from ``base``; the largest number adds itself and stands for no value."""
    most = np.uint64((1 << 8 * width) - 1)
    gap = np.diff(values, prepend=np.uint64(base))
    times = (gap // most).astype(np.int64)
    out = np.full(len(values) + int(times.sum()), most, "<u4")
    out[np.cumsum(times) + np.arange(len(values))] = gap % most
    return out.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpack_gaps(data: bytes, base: int, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 4), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    gap = wide.view("<u4").ravel().astype(np.uint64)
    return (np.cumsum(gap, dtype=np.uint64) + np.uint64(base))[gap != (1 << 8 * width) - 1]


def _sets(texts: list[str | None], n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Each text's tokens, and all of them one after the other."""
    sets = [shingles(t, n) for t in texts]
    return sets, np.concatenate([np.zeros(0, np.uint64), *sets])


def _counted(layout: Layout, level: int, unit: int, part: int, token: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Rows of PIECE for a unit's sorted distinct tokens, one for each part of the level that it has tokens in."""
    ends, rows, again = layout.ends(token, level, part), [], count > 1
    for k in np.flatnonzero(np.diff(ends)).tolist():
        own = slice(ends[k], ends[k + 1])
        m, at = again[own], (part << layout.levels[level]) + k
        rows.append((unit, at, int(len(m)), pack_gaps(token[own], layout.base(at, level), layout.width), np.packbits(m).tobytes(), count[own][m].astype("<u4").tobytes()))
    columns = zip(zip(*rows, strict=True) if rows else [[]] * 6, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], ["unit", "part", "n", "gaps", "again", "counts"])


PIECE, CLASSES = "unit long, part long, n int, gaps binary, again binary, counts binary", "unit long, part long, n int, shared binary, often binary"


def _pieces(layout: Layout, level: int, part: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a part's rows one after the other, their counts, and the rows' sizes."""
    sizes, base = table["n"].to_numpy(), layout.base(part, level)
    token = np.concatenate([np.zeros(0, np.uint64), *(unpack_gaps(x, base, layout.width) for x in table["gaps"].to_pylist())])
    weight = np.ones(len(token), np.int64)
    again = np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(x, np.uint8), count=m) for x, m in zip(table["again"].to_pylist(), sizes.tolist(), strict=True))]).astype(bool)
    weight[again] = np.frombuffer(b"".join(table["counts"].to_pylist()), "<u4")
    return token, weight, sizes


def _bits(flags: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Flags of rows of so many tokens as packed bits, null for none."""
    at = np.append(0, np.cumsum(sizes))
    return pa.array([np.packbits(flags[a:z]).tobytes() if flags[a:z].any() else None for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())


def _unpacked(bits: bytes | None, n: int) -> np.ndarray:
    return np.zeros(n, bool) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def token_classes(docs: DataFrame, n: int, frequent: int, layout: Layout, scratch: Scratch) -> DataFrame:
    """unit (a chunk), part, n, shared, often: for the sorted distinct short hashes of a chunk in a part of the first level, a bit each for two documents or more, and for more than ``frequent`` (null: none). docs: row, text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_forget()
        held: list = []
        now = None

        def flush() -> pa.RecordBatch:
            return _counted(layout, 0, now, 0, *np.unique(layout.short(_sets(held, n)[1]), return_counts=True))

        for b in small_batches(batches):
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if row >> layout.chunk_shift != now:
                    if held:
                        yield flush()
                    held, now = [], row >> layout.chunk_shift
                held.append(text)
        if held:
            yield flush()

    return _classes(docs.select("row", "text").mapInArrow(count, PIECE), 0, frequent, layout, scratch)


def _classes(rows: DataFrame, level: int, frequent: int, layout: Layout, scratch: Scratch) -> DataFrame:
    """The classes of rows of PIECE, whose parts are those of the level: of the last one by counting, else by what groups of units hold together."""

    def merge(key, table):
        worker_forget()
        token, weight, sizes = _pieces(layout, level, key[0].as_py(), table)
        order = np.argsort(token, kind="stable")
        token = token[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        total = np.add.reduceat(weight[order], first)
        total = np.repeat(total, np.diff(np.append(first, len(token))))
        shared, often = np.empty(len(token), bool), np.empty(len(token), bool)
        shared[order], often[order] = total > 1, total > frequent
        return pa.table({"unit": table["unit"], "part": table["part"], "n": table["n"], "shared": _bits(shared, sizes), "often": _bits(often, sizes)})

    if level == len(layout.levels) - 1:
        return rows.groupBy("part").applyInArrow(merge, CLASSES)

    def together(key, table):
        worker_forget()
        group, part = (k.as_py() for k in key)
        token, weight, _ = _pieces(layout, level, part, table)
        distinct, place = np.unique(token, return_inverse=True)
        return pa.Table.from_batches([_counted(layout, level + 1, group, part, distinct, np.bincount(place, weights=weight, minlength=len(distinct)).astype(np.int64))])

    def apart(key, table, answers):
        worker_forget()
        token, _, sizes = _pieces(layout, level, key[1].as_py(), table)
        distinct, place = np.unique(token, return_inverse=True)
        answers = sorted(zip(*(answers[c].to_pylist() for c in ("part", "n", "shared", "often")), strict=True))
        flags = [np.concatenate([np.zeros(0, bool), *(_unpacked(a[k], a[1]) for a in answers)]) for k in (2, 3)]
        if len(flags[0]) != len(distinct):
            raise RuntimeError("the documents were not the same when they were read again")
        return pa.table({"unit": table["unit"], "part": table["part"], "n": table["n"], "shared": _bits(flags[0][place], sizes), "often": _bits(flags[1][place], sizes)})

    rows = scratch.cut(rows, f"pieces{level}")
    held = rows.withColumn("group", F.pmod(F.xxhash64("unit", F.lit(level)), F.lit(layout.groups(level)).cast("long")))
    groups = held.groupBy("group", "part").applyInArrow(together, PIECE)
    answers = _classes(groups, level + 1, frequent, layout, scratch).withColumn("whole", F.shiftright("part", layout.levels[level + 1]))
    return held.groupBy("group", "part").cogroup(answers.groupBy("unit", "whole")).applyInArrow(apart, CLASSES)


def short_sets(percent: int) -> int:
    """Sets of fewer tokens than this may be similar without two shared tokens next to each other."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50")
    # x tokens differ and x * ratio are shared at least: a pair next to each other needs x + 2 shared
    ratio = percent / (100 - percent) if percent < 100 else math.inf
    return 0 if ratio > 2 else math.ceil(4 / (ratio - 1)) + 2


def signatures(tokens: np.ndarray, shared: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set: tokens sorted by hash, with flags for tokens that other documents may hold and for frequent ones."""
    n = len(tokens)
    prefix = n - -(-n * percent // 100) + 1
    need = prefix - (n - int(shared.sum()))
    if need <= 0:
        return np.zeros(0, np.uint64)
    rare, many = tokens[shared & ~often], tokens[shared & often]
    out = rare[:need]
    if len(rare) < need:
        more = many[: need - len(rare) + 2 * (n * (100 - percent) // percent) + 1]
        single = many[: need - len(rare)] if n < short_sets(percent) else many[:0]
        out = np.concatenate([out, single, _mix(more[:-1] * _ODD[0] + more[1:])])
    # sizes of similar sets are in the same band or in the next
    band = int(math.log(n) / (1.001 * math.log(100 / percent))) if percent < 100 else n
    return np.concatenate([_mix(out + np.uint64(b * 0xC2B2AE3D27D4EB4F % 2**64)) for b in (band, band + 1)])


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """64-bit words, a power of two of them and as many bits as tokens at least: each token flips the bit that its hash names."""
    bits = 64 << max(0, (len(tokens) - 1).bit_length() - 6)
    flips = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.uint64)


def document_signatures(docs: DataFrame, n: int, percent: int, classes: DataFrame, layout: Layout) -> DataFrame:
    """A row per document: its id, set size, 128-bit set hash, signatures and, if it has any, its parity bits and the tokens that others may hold. docs: row, doc_id, text."""
    schema = "row long, doc_id long, n long, f1 long, f2 long, sigs array<long>, parity binary, tokens binary"

    def run(key, texts, bits):
        worker_forget()
        sets, every = _sets(texts["text"].to_pylist(), n)
        short, where = np.unique(layout.short(every), return_inverse=True)
        ends, flags = layout.ends(short), np.zeros((2, len(short)), bool)
        for part, size, *packed in zip(*(bits[c].to_pylist() for c in ("part", "n", "shared", "often")), strict=True):
            if size != ends[part + 1] - ends[part]:
                raise RuntimeError("the documents were not the same when they were read again")
            for k, x in enumerate(packed):
                if x is not None:
                    flags[k, ends[part] : ends[part + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=size)
        flags = flags[:, where]
        out, at = [], 0
        for t in sets:
            shared, often = flags[:, at : at + len(t)]
            at += len(t)
            own = signatures(t, shared, often, percent) if shared.any() else np.zeros(0, np.uint64)
            digest = xxhash.xxh3_128_digest(t.tobytes())
            halves = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
            out.append((len(t), *halves, own.view(np.int64), *((parity_bits(t).tobytes(), t[shared].tobytes()) if len(own) else (None, None))))
        size, one, two, sigs, parity, tokens = zip(*out, strict=True) if out else [[]] * 6
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32))
        flat = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *sigs])))
        arrays = [texts["row"], texts["doc_id"], *(pa.array(x, pa.int64()) for x in (size, one, two)), flat, pa.array(parity, pa.binary()), pa.array(tokens, pa.binary())]
        return pa.table(dict(zip(("row", "doc_id", "n", "f1", "f2", "sigs", "parity", "tokens"), arrays, strict=True)))

    lean = docs.select(F.shiftright("row", layout.chunk_shift).alias("at"), "row", "doc_id", "text")
    return lean.groupBy("at").cogroup(classes.groupBy("unit")).applyInArrow(run, schema)


def least_common(a, b, percent: int):
    """Tokens that sets of sizes a and b must share to be linked."""
    return -(-percent * (a + b) // (100 + percent))


def parity_links(n: np.ndarray, words: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """The label of each set of a block: sets that may be linked, by their parity bits, get one label, the first index that has it.

    Pairs of the same nonzero side are left out, as another block has them.
    """
    m, label = len(n), np.arange(len(n))
    order = np.argsort(n, kind="stable")
    n, side, words = n[order], side[order], [words[k] for k in order]
    size = np.array([len(w) for w in words])
    # similar sizes are at most a factor of two apart, so bitmaps of one size or the next meet
    exact = {b: np.stack([words[k] for k in np.flatnonzero(size == b)]) for b in np.unique(size).tolist()}
    first = {b: int(np.searchsorted(size, b)) for b in exact}
    folded = {b // 2: np.bitwise_xor(x[:, : b // 2], x[:, b // 2 :]) for b, x in exact.items() if b > 1}
    last = np.searchsorted(n, n * 100 // percent, side="right")
    for i in range(m):
        b, near = int(size[i]), []
        split = min(int(last[i]), first[b] + len(exact[b]))
        for lo, hi, rows, start in ((i + 1, split, exact[b], first[b]), (split, int(last[i]), folded.get(b), split)):
            if hi > lo and rows is not None:
                j = np.arange(lo, hi)
                apart = np.bitwise_count(rows[lo - start : hi - start] ^ words[i]).sum(1)
                near.append(j[(apart <= n[i] + n[j] - 2 * least_common(n[i], n[j], percent)) & ((side[j] != side[i]) | (side[i] == 0))])
        if near and len(near := np.concatenate(near)):
            labels = np.unique(label[np.append(near, i)])
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]
    out = np.empty(m, np.int64)
    out[order] = order[label]
    # the first index of each label
    _, at, back = np.unique(out, return_index=True, return_inverse=True)
    return at[back]


def block_links(n: np.ndarray, mult: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, links) of each set of a block: the first index of its component, and how many documents it links to.

    Pairs of the same nonzero side are left out, as another block has them. Common tokens are counted for one set after
    the other over an inverted index, so memory stays in proportion to the block.
    """
    m = len(sets)
    root, links = np.arange(m), np.zeros(m, np.int64)

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    token, owner = np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(m, dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(token, kind="stable").astype(np.int32)
    token, owner, back = token[order], owner[order], np.empty(len(order), np.int32)
    if not len(token):
        return root, links
    new = np.concatenate([[True], token[1:] != token[:-1]])
    end = np.append(np.flatnonzero(new)[1:], len(token)).astype(np.int32)
    back[order] = np.arange(len(order), dtype=np.int32)  # where in the index each of a set's tokens is
    group = (np.cumsum(new, dtype=np.int32) - 1)[back]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    for i in range(m):
        mine = slice(first[i], first[i + 1])
        # owners in a token's run are ascending: those after this set's own place are larger
        lo, hi = back[mine] + 1, end[group[mine]]
        count = hi - lo
        total = int(count.sum())
        if not total:
            continue
        runs = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(total)
        common = np.bincount(owner[runs], minlength=m)
        near = np.flatnonzero(common)
        c = common[near]
        near = near[(100 * c >= percent * (n[i] + n[near] - c)) & ((side[near] != side[i]) | (side[i] == 0))]
        if len(near):
            links[i] += mult[near].sum()
            links[near] += mult[i]
            r = find(i)
            for j in near.tolist():
                s = find(j)
                if s != r:
                    r, s = min(r, s), max(r, s)
                    root[s] = r
    return np.array([find(k) for k in range(m)]), links


def in_blocks(clusters: DataFrame, held: DataFrame, column: str, block: int) -> DataFrame:
    """Rows of ``held`` (row, n, mult and the binary ``column``) of clusters (v, root), dealt to blocks (c, i, j): v, mine, n, mult, column.

    Small clusters share a block with others (c is -1); in a large one each block meets every other, and ``mine`` tells the
    block of a row.
    """
    rows = clusters.join(held.select("row", F.octet_length(column).cast("long").alias("bytes")), F.col("v") == F.col("row")).drop("row")
    sizes = rows.groupBy(F.col("root").alias("cluster")).agg((F.count(F.lit(1)) / block).alias("by_docs"), (F.sum("bytes") / BLOCK_BYTES).alias("by_bytes"))
    placed = rows.join(sizes, F.col("root") == F.col("cluster")).withColumn("blocks", F.ceil(F.greatest("by_docs", "by_bytes")).cast("int"))
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    share = rows.agg(F.coalesce(F.greatest(F.count(F.lit(1)) / block, F.sum("bytes") / BLOCK_BYTES), F.lit(0.0))).collect()[0][0]
    together = F.struct(F.lit(-1).cast("long").alias("c"), F.pmod(F.xxhash64("root"), F.lit(max(1, math.ceil(share)))).cast("int").alias("i"), F.lit(0).alias("j"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.col("root").alias("c"), F.least("mine", k).alias("i"), F.greatest("mine", k).alias("j")))
    at = F.explode(F.when(F.greatest("by_docs", "by_bytes") <= 0.25, F.array(together)).otherwise(meets)).alias("at")
    return placed.select("v", at, "mine").select("v", "at.*", "mine").join(held, F.col("v") == F.col("row")).drop("row")


def _block(key, g) -> tuple[pd.DataFrame, np.ndarray]:
    """A block's rows by vertex, and their sides: in a block of two parts, pairs within a part are another block's."""
    worker_forget()
    g = g.sort_values("v", ignore_index=True)
    two = key[0] != -1 and key[1] != key[2]
    return g, (g["mine"] == key[1]).to_numpy().astype(np.int64) + 1 if two else np.zeros(len(g), np.int64)


def linked_rows(docs: DataFrame, scratch: Scratch, *, n: int, percent: int, frequent: int | None, block: int) -> DataFrame:
    """row, doc_id, n, component_id, first, n_links: a row per document. docs: row, doc_id, text. ``first`` is the same vertex for all rows of a component, null for a row without links."""
    short_sets(percent)
    count, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0]
    layout = Layout.of(count, size)
    classes = token_classes(docs, n, max(64, count // 1024) if frequent is None else frequent, layout, scratch)
    rows = scratch.cut(document_signatures(docs, n, percent, classes, layout), "documents")
    # documents of equal sets are one vertex: the first of them
    groups = scratch.cut(rows.where("n > 0").groupBy("f1", "f2").agg(F.min("row").alias("v"), F.count(F.lit(1)).alias("mult"), F.min("doc_id").alias("least")), "groups")
    signed = rows.where("size(sigs) > 0").join(groups.select("v", "mult"), F.col("row") == F.col("v")).drop("v")
    signed = scratch.cut(signed.select("row", "n", "mult", "sigs", "parity"), "signed")
    lean = signed.select("row", F.explode("sigs").alias("sig"))
    stars = lean.groupBy("sig").agg(F.min("row").alias("a"), F.count(F.lit(1)).alias("docs")).where("docs > 1").select(F.col("sig").alias("star"), "a")
    near = lean.join(stars, F.col("sig") == F.col("star")).select("a", F.col("row").alias("b"))
    clusters = connected_components(near, scratch)

    def may_link(key, g):
        g, side = _block(key, g)
        v = g["v"].to_numpy()
        label = parity_links(g["n"].to_numpy(), [np.frombuffer(x, np.uint64) for x in g["parity"]], side, percent)
        moved = label != np.arange(len(v))
        return pd.DataFrame({"a": v[label][moved], "b": v[moved]})

    def compare(key, g):
        g, side = _block(key, g)
        root, links = block_links(g["n"].to_numpy(), g["mult"].to_numpy(), [np.frombuffer(t, np.uint64) for t in g["tokens"]], side, percent)
        v, linked = g["v"].to_numpy(), links > 0
        return pd.DataFrame({"a": v[root][linked], "b": v[linked], "links": links[linked]})

    near = in_blocks(clusters, signed.drop("sigs"), "parity", block).groupBy("c", "i", "j").applyInPandas(may_link, "a long, b long")
    clusters = connected_components(near, scratch)
    sets = rows.select("row", "tokens").where("tokens IS NOT NULL").join(clusters.select(F.col("v").alias("row")), "row", "left_semi")
    sets = scratch.cut(sets.join(signed.select("row", "n", "mult"), "row"), "sets")
    links = in_blocks(clusters, sets, "tokens", block).groupBy("c", "i", "j").applyInPandas(compare, "a long, b long, links long")
    links = scratch.cut(links, "links")
    final = connected_components(links.select("a", "b"), scratch)
    counts = links.groupBy(F.col("b").alias("linked")).agg(F.sum("links").alias("links"))
    joined = final.join(groups.select(F.col("v").alias("gv"), "f1", "f2", "mult", "least"), F.col("v") == F.col("gv")).join(counts, F.col("v") == F.col("linked"), "left")
    least = joined.groupBy("root").agg(F.min("least").alias("component")).withColumnRenamed("root", "r")
    linked = joined.join(least, F.col("root") == F.col("r")).select("f1", "f2", "component", F.col("root").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "mult")
    alone = groups.where("mult > 1").join(final.select(F.col("v").alias("fv")), F.col("v") == F.col("fv"), "left_anti").select("f1", "f2", F.col("least").alias("component"), F.col("v").alias("first"), (F.col("mult") - 1).alias("n_links"), "mult")
    classes = scratch.cut(linked.unionByName(alone), "classes")
    # sets that more than a 200th of all documents have are fewer than 200: they are broadcast, so no join key is that frequent
    hot = classes.where(F.col("mult") > F.lit(count / 200)).drop("mult")
    hot = hot.select(F.col("f1").alias("h1"), F.col("f2").alias("h2"), F.col("component").alias("hc"), F.col("first").alias("hf"), F.col("n_links").alias("hn"))
    slim = rows.select("row", "doc_id", "n", "f1", "f2").join(F.broadcast(hot), (F.col("f1") == F.col("h1")) & (F.col("f2") == F.col("h2")), "left")
    done = slim.where("hn IS NOT NULL").select("row", "doc_id", "n", F.col("hc").alias("component_id"), F.col("hf").alias("first"), F.col("hn").alias("n_links"))
    cold = slim.where("hn IS NULL").select("row", "doc_id", "n", "f1", "f2").join(classes.drop("mult").withColumnsRenamed({"f1": "c1", "f2": "c2"}), (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & (F.col("n") > 0), "left")
    cold = cold.select("row", "doc_id", "n", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), "first", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return done.unionByName(cold)


def _rows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    return numbered(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), scratch, "row")


def jaccard_join(docs: DataFrame, *, n: int = 5, percent: int = 80, frequent: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: a row per document. Sets are linked if 100 * common >= percent * union; percent is above 50."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    out = linked_rows(_rows(docs, scratch), scratch, n=n, percent=percent, frequent=frequent, block=block)
    return scratch.finish(out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"))


def drop_near_duplicates(docs: DataFrame, *, n: int = 5, percent: int = 80, frequent: int | None = None, block: int = BLOCK) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (null ids last), the first such row. Rows are told apart by their place, so equal doc_ids of different texts stay."""
    scratch = Scratch(docs.sparkSession, "near")
    # the columns in a struct, so that no name of theirs can clash
    whole = numbered(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")), scratch, "row")
    lean = whole.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    linked = linked_rows(lean, scratch, n=n, percent=percent, frequent=frequent, block=block).where("first IS NOT NULL")
    linked = scratch.cut(linked.select("row", "first", F.col("doc_id").isNull().alias("lacks"), "doc_id"), "linked")
    kept = linked.groupBy("first").agg(F.min(F.struct("lacks", "doc_id", "row")).alias("kept")).select(F.col("kept.row").alias("row"))
    gone = scratch.cut(linked.join(kept, "row", "left_anti").select(F.col("row").alias("gone")), "gone")
    scratch.drop(*[name for name in list(scratch.held) if name not in ("gone", "row-numbered")])
    return whole.join(gone, F.col("row") == F.col("gone"), "left_anti").select("doc.*")
