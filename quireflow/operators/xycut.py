"""XY-cut reading order, right-most column first: gaps and islands over windows, and cuts of any depth for many pages at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.tables import Tables, ship

#: (x, y) shares by which boxes are shrunk before cutting: whole pages, and crops of a page.
PAGE_SCALE, CROP_SCALE = (0.0667, 0.6667), (0.2, 0.0667)


def shrunk(df: DataFrame, page: str, scale: tuple[float, float]) -> DataFrame:
    """Mirrored and shrunk boxes as lx, ly, hx, hy."""
    s = F.max(F.greatest(F.abs("x1"), F.abs("x2"))).over(Window.partitionBy(page))
    hx = (s - F.col("x1") - (F.col("x2") - F.col("x1")) * F.lit(scale[0])).cast("int")
    return df.withColumns({"lx": s - F.col("x2"), "ly": F.col("y1"), "hx": hx, "hy": (F.col("y2") - (F.col("y2") - F.col("y1")) * F.lit(scale[1])).cast("int")})


def islands(df: DataFrame, group: list[str], lo: str, hi: str, idx: str, name: str) -> DataFrame:
    """Adds ``name``: the run of occupied positions that a box begins in, null for boxes in none.

    Runs but the last of a group end one position early, so a box may begin in the gap this leaves.
    """
    order = Window.partitionBy(*group).orderBy(F.col(lo), F.when(F.col(hi) > F.col(lo), 0).otherwise(1), F.col(idx))
    reach = F.when(F.col(hi) > F.col(lo), F.col(hi))
    before = F.max(reach).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when((F.col(hi) > F.col(lo)) & (before.isNull() | (F.col(lo) > before)), 1).otherwise(0)
    df = df.withColumn("_run", opens).withColumn("_run", F.sum("_run").over(order))
    run = Window.partitionBy(*group, "_run")
    df = df.withColumn("_end", F.max(reach).over(run)).withColumn("_last", F.max("_run").over(Window.partitionBy(*group)))
    inside = (F.col("_run") > 0) & (F.col(lo) < F.when(F.col("_run") == F.col("_last"), F.col("_end")).otherwise(F.col("_end") - 1))
    return df.withColumn(name, F.when(inside, F.col("_run"))).drop("_run", "_end", "_last")


def reading_order(df: DataFrame, page: str, idx: str, scale: tuple[float, float] = PAGE_SCALE, rounds: int = 2, tables: Tables | None = None) -> DataFrame:
    """Adds rank (from 1), for any depth of cuts; boxes that fell out of a run come last, in input order.

    Rows are shuffled and sorted once, by page; each task then orders some ten thousand boxes of whole pages at a time.
    ``rounds`` and ``tables`` are those of callers from before, and change nothing.
    """
    return _ranked(df, page, idx, scale)


def _runs(boxes: list[tuple], lo: int, hi: int) -> list[list[tuple]]:
    """Boxes by the run that they begin in, in the order of runs."""
    ends: list[list[int]] = []
    for b in sorted((b for b in boxes if b[hi] > b[lo]), key=lambda b: b[lo]):
        if ends and b[lo] <= ends[-1][1]:
            ends[-1][1] = max(ends[-1][1], b[hi])
        else:
            ends.append([b[lo], b[hi]])
    for e in ends[:-1]:
        e[1] -= 1
    return [[b for b in boxes if a <= b[lo] < z] for a, z in ends]


def cut_order(boxes: list[tuple]) -> list:
    """Indices of boxes (index, lx, ly, hx, hy) in reading order, to any depth."""

    def cut(now: list[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for column in _runs(now, 1, 3):
            rows = _runs(column, 2, 4)
            if len(rows) == 1:
                out += sorted(rows[0], key=lambda b: (b[2], b[1], b[0]))
            else:
                for r in rows:
                    out += cut(r) if r else []
        return out

    done = cut(boxes)
    seen = {b[0] for b in done}
    return [b[0] for b in done] + [b[0] for b in boxes if b[0] not in seen]


#: Boxes that are ordered at once, if their pages are no larger.
BOXES = 50_000


def _members(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, real: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run of occupied positions that each box begins in, from 1 in its group (0: none), and the number of runs in its group. ``_runs`` for all groups (ascending numbers from 0) at once."""
    base = int(min(lo.min(), hi.min()))
    wide = int(max(lo.max(), hi.max())) - base + 2
    start, stop = group * wide + (lo - base), group * wide + (hi - base)
    own = np.flatnonzero(real)
    own = own[np.argsort(start[own], kind="stable")]
    run, count = np.zeros(len(group), np.int64), np.zeros(int(group.max()) + 1, np.int64)
    if not len(own):
        return run, count[group]
    reach = np.maximum.accumulate(stop[own])
    first = np.concatenate([[True], (start[own][1:] > reach[:-1]) | (group[own][1:] != group[own][:-1])])
    opens = np.flatnonzero(first)
    begin, of = start[own][opens], group[own][opens]
    end = reach[np.append(opens[1:], len(own)) - 1].copy()
    end[:-1] -= of[1:] == of[:-1]  # runs but the last of a group end one position early
    count = np.bincount(of, minlength=len(count))
    before = np.cumsum(count) - count
    at = np.searchsorted(begin, start, "right") - 1
    inside = known & (at >= 0) & (of[at] == group) & (start < end[at])
    run[inside] = (at - before[group])[inside] + 1
    return run, count[group]


def cut_pages(page: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, there: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    """Ranks of boxes with whole coordinates, as ``cut_order`` orders each page's: all pages at once, a round of cuts after the other. page: ascending numbers from 0, in each by index; there (4 rows): whether the coordinate isn't null."""
    n = len(page)
    s = np.zeros(int(page[-1]) + 1, np.int64)
    for v, t in ((x1, there[0]), (x2, there[2])):
        np.maximum.at(s, page[t], np.abs(v[t]))
    s = s[page]
    lx, hx = s - x2, np.trunc((s - x1) - (x2 - x1) * scale[0]).astype(np.int64)
    ly, hy = y1, np.trunc(y2 - (y2 - y1) * scale[1]).astype(np.int64)
    realx, realy = there[0] & there[2] & (hx > lx), there[1] & there[3] & (hy > ly)
    group, gone, now = page.astype(np.int64), np.zeros(n, bool), np.arange(n)
    while len(now):
        _, own = np.unique(group[now], return_inverse=True)
        column, _ = _members(own, lx[now], hx[now], realx[now], there[2][now])
        gone[now[column == 0]] = True
        own, now, column = own[column > 0], now[column > 0], column[column > 0]
        if not len(now):
            break
        _, own = np.unique(own * (int(column.max()) + 1) + column, return_inverse=True)
        row, rows = _members(own, ly[now], hy[now], realy[now], there[1][now])
        gone[now[row == 0]] = True
        # groups that were numbered before, parted by column and row
        part = np.zeros(n, np.int64)
        part[now] = own * (int(row.max()) + 1) + row + 1
        order = np.lexsort((part, group))
        new = (np.diff(group[order], prepend=-1) != 0) | (np.diff(part[order], prepend=-1) != 0)
        group[order] = np.cumsum(new)
        now = now[(row > 0) & (rows > 1)]  # a column of one row is cut no further
    keep = lambda v: np.where(gone, 0, v)
    order = np.lexsort((np.arange(n), keep(lx), keep(ly), keep(group), gone, page))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - np.searchsorted(page, page[order]) + 1
    return rank


def _ranked(df: DataFrame, page: str, idx: str, scale: tuple[float, float]) -> DataFrame:
    """df with rank: sorted by page and index, and ordered in parts of whole pages."""
    ship(df.sparkSession)
    whole = all(isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for c in ("x1", "y1", "x2", "y2"))

    def ranks(part: pa.Table) -> np.ndarray:
        code = part[page].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        number = np.cumsum(np.diff(code, prepend=code[:1]) != 0)
        if whole:
            there = np.array([part[c].is_valid().to_numpy() for c in ("x1", "y1", "x2", "y2")])
            return cut_pages(number, *(part[c].fill_null(0).to_numpy().astype(np.int64) for c in ("x1", "y1", "x2", "y2")), there, scale)
        boxes, out = np.array([part[c].cast(pa.float64()).fill_null(float("nan")).to_numpy() for c in ("x1", "y1", "x2", "y2")]), np.zeros(len(number), np.int64)
        for k in range(int(number[-1]) + 1):
            own = np.flatnonzero(number == k)
            s = np.nanmax(np.abs(boxes[[0, 2]][:, own])) if np.isfinite(boxes[[0, 2]][:, own]).any() else 0.0
            cut = lambda v: v if v != v else int(v)
            rows = [(i, s - x2, y1, cut(s - x1 - (x2 - x1) * scale[0]), cut(y2 - (y2 - y1) * scale[1])) for i, (x1, y1, x2, y2) in enumerate(boxes[:, own].T.tolist())]
            out[own[cut_order(rows)]] = np.arange(1, len(own) + 1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, most = [], 0, BOXES
        for last, b in _with_last(batches):
            held.append(b)
            rows += b.num_rows
            if not rows or (rows < most and not last):
                continue
            part = pa.Table.from_batches(held)
            end = rows
            if not last:  # the last page may go on in the next batch
                code = part[page].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                changes = np.flatnonzero(np.diff(code))
                end = int(changes[-1]) + 1 if len(changes) else 0
            if end:
                done = part.slice(0, end)
                yield from done.append_column("rank", pa.array(ranks(done), pa.int32())).to_batches(max_chunksize=BOXES)
            held, rows = part.slice(end).to_batches(), rows - end
            most = max(BOXES, 2 * rows)  # a large page is looked at again when it has doubled

    kind = T.StructType([*df.schema.fields, T.StructField("rank", T.IntegerType())])
    return df.repartition(F.col(page)).sortWithinPartitions(page, idx).mapInArrow(run, kind)


def _with_last(batches: Iterator) -> Iterator[tuple[bool, object]]:
    """(whether it is the last one, batch)."""
    before = next(batches, None)
    while before is not None:
        after = next(batches, None)
        yield after is None, before
        before = after


def reading_order_grouped(df: DataFrame, page: str, idx: str, scale: tuple[float, float] = PAGE_SCALE) -> DataFrame:
    """page, idx, rank of ``reading_order``."""
    return _ranked(df.select(page, idx, "x1", "y1", "x2", "y2"), page, idx, scale).select(page, idx, "rank")


def order_boxes(boxes: list[list[int]], scale: tuple[float, float]) -> list[int]:
    """Places of boxes (x1, y1, x2, y2) in reading order, as ``reading_order`` has them."""
    s = max((max(abs(b[0]), abs(b[2])) for b in boxes), default=0)
    return cut_order([(k, s - x2, y1, int(s - x1 - (x2 - x1) * scale[0]), int(y2 - (y2 - y1) * scale[1])) for k, (x1, y1, x2, y2) in enumerate(boxes)])
