"""Reading-order chains: neighbour pairs, their strength, greedy links, walk order and composition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.functions import textclean as T
from quireflow.tables import ship


@dataclass(frozen=True)
class ChainOptions:
    left: int = 200
    diagonal: int = 100
    below: int = 1000
    least: float = 0.6
    decay: float = 500.0


def neighbour_pairs(frags: DataFrame, doc: str, block: str, o: ChainOptions = ChainOptions(), seen: int | None = None) -> DataFrame:
    """doc, src, dst with both boxes and texts: dst lies to the left of src at about its end, or right below it.

    A band join: a fragment below another one has its top in the same band of ``below`` pixels as the other's foot, or in a
    band next to it; one beside it lies in the same or a neighbouring cell of ``left`` by ``diagonal`` pixels. So a fragment
    meets those of three bands and nine cells, and a long document is as many join keys as it has bands. A pair that is both
    is found by its band. Fragments of a null document have no neighbours, and a rule
    holds for none that lacks a coordinate it asks for. With ``seen``, of the first text only so many characters at the end
    are carried along, and of the second one so many at the beginning.
    """
    cols = ["x1", "y1", "x2", "y2", "text"]
    band = lambda c, width: F.floor(F.col(c) / F.lit(max(1, width))).cast("long")
    key = lambda kind, y, x: F.struct(F.lit(kind).alias("kind"), y.alias("y"), x.alias("x"))
    none, near = F.lit(0).cast("long"), (-1, 0, 1)
    around = [key(0, band("y2", o.below) + k, none) for k in near] + [key(1, band("y2", o.diagonal) + k, band("x1", o.left) + j) for k in near for j in near]
    own = [key(0, band("y1", o.below), none), key(1, band("y2", o.diagonal), band("x2", o.left))]
    end, start = (F.col("text"), F.col("text")) if seen is None else (F.right("text", F.lit(seen)), F.left("text", F.lit(seen)))
    a = frags.select(doc, F.col(block).alias("src"), *[F.col(c).alias(f"a_{c}") for c in cols[:-1]], end.alias("a_text"), F.explode(F.array(*around)).alias("_at"))
    b = frags.where(~F.startswith(F.col("text"), F.lit("<div"))).select(F.col(doc).alias("_doc"), F.col(block).alias("dst"), *[F.col(c).alias(f"b_{c}") for c in cols[:-1]], start.alias("b_text"), F.explode(F.array(*own)).alias("_in"))
    beside = (F.abs(F.col("b_x2") - F.col("a_x1")) <= o.left) & (F.abs(F.col("b_y2") - F.col("a_y2")) <= o.diagonal)
    under = F.abs(F.col("b_y1") - F.col("a_y2")) <= o.below
    meets = (F.col(doc) == F.col("_doc")) & (F.col("_at.kind") == F.col("_in.kind")) & (F.col("_at.y") == F.col("_in.y")) & (F.col("_at.x") == F.col("_in.x"))
    wanted = F.when(F.col("_at.kind") == 0, under).otherwise(beside & ~F.coalesce(under, F.lit(False)))
    return a.join(b, meets & (F.col("src") != F.col("dst")) & wanted).drop("_doc", "_at", "_in")


def spatial_weight(o: ChainOptions = ChainOptions()) -> Column:
    h, v = F.abs(F.col("b_x2") - F.col("a_x1")), F.abs(F.col("b_y1") - F.col("a_y2"))
    far = F.when(h <= v, h).otherwise(v)
    aside = F.when(h <= v, F.abs(F.col("a_y1") - F.col("b_y1"))).otherwise(F.least(h, F.abs(F.col("b_x1") - F.col("a_x2"))))
    return F.exp(-(far + 0.1 * aside) / F.lit(o.decay))


def mixed_strength(near: Column, goes_on: Column) -> Column:
    return F.when((near > 0.95) & (goes_on > 0.999), goes_on).when((goes_on > 0.1) & (goes_on < 0.2) & (near > 0.95), 0.8 * near).otherwise(near * goes_on)


def best_successor(pairs: DataFrame, doc: str) -> DataFrame:
    w = Window.partitionBy(doc, "src").orderBy(F.desc("mixed"), "dst")
    return pairs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def greedy_links(pairs: DataFrame, frags: DataFrame, doc: str, block: str, o: ChainOptions = ChainOptions()) -> DataFrame:
    """doc, src, dst, mixed: each open fragment in input order grows a chain by its best free neighbour. Scores don't depend on the chain, so all pairs are scored before."""
    ship(frags.sparkSession)
    # only open fragments grow, and only by pairs that are strong enough, so others need no call
    opens = frags.where(T.is_open(F.col("text"))).select(F.col(doc).alias("_d"), F.col(block).alias("_b"))
    strong = pairs.where(F.col("mixed") >= o.least).select(doc, "src", "dst", "goes_on", "mixed")
    types = dict(frags.dtypes)
    met = strong.join(opens, (F.col("_d") == F.col(doc)) & (F.col("_b") == F.col("src")))
    rows = met.select("_d", "_b", F.col("dst").cast(types[block]).alias("dst"), F.coalesce("goes_on", F.lit(0.0)).alias("goes_on"), "mixed")

    def grow(d, near: dict) -> list[tuple]:
        taken, seen, out = set(), set(), []
        for seed in sorted(near):
            now = seed
            while now in near and now not in seen:
                seen.add(now)
                free = [c for c in sorted(near[now]) if c[1] not in taken]
                if not free or free[0][2] < 0:
                    break
                strength, to, _ = free[0]
                taken.add(to)
                out.append((d, now, to, -strength))
                now = to
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, near, kinds = None, {}, None  # the document that is being read, and its pairs
        for b in batches:
            kinds, out = [b.schema.field(c).type for c in ("_d", "_b", "dst", "mixed")], []
            for d, src, dst, goes_on, mixed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if near and d != of:
                    out += grow(of, near)
                    near = {}
                of = d
                near.setdefault(src, []).append((-mixed, dst, goes_on))
            yield made(out, kinds)
        if near:
            yield made(grow(of, near), kinds)

    def made(out: list[tuple], kinds: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [doc, "src", "dst", "mixed"])

    # sorted by document, so that a call takes many documents and holds the pairs of one
    return rows.repartition("_d").sortWithinPartitions("_d").mapInArrow(run, f"`{doc}` {types[doc]}, src {types[block]}, dst {types[block]}, mixed double")


def walk_order(frags: DataFrame, links: DataFrame, doc: str, block: str, text: str | None = None) -> DataFrame:
    """doc, block, seq, and the text if it is named: by the smallest ancestor, then hops from it. Links have one source and one target each; blocks are unique in their doc.

    Each fragment's smallest ancestor is found by doubling: knowing the smallest within 2^k steps back, one lookup gives that
    within 2^(k+1), for chains and rings alike. A document's steps are arrays in one row, so no Python and no join is needed.
    """
    place = Window.partitionBy("_d").orderBy("_b")
    carried = F.col(text) if text is not None else F.lit(None).cast("string")
    rows = frags.select(F.col(doc).alias("_d"), F.col(block).alias("_b"), carried.alias("_t")).withColumn("_i", (F.row_number().over(place) - 1).cast("int"))
    source = rows.select(F.col("_d").alias("_sd"), F.col("_b").alias("_sb"), F.col("_i").alias("_from"))
    into = links.select(F.col(doc).alias("_ld"), F.col("src").alias("_ls"), F.col("dst").alias("_lt"))
    into = into.join(source, (F.col("_ld") == F.col("_sd")) & (F.col("_ls") == F.col("_sb"))).select("_ld", "_lt", "_from")
    met = rows.join(into, (F.col("_d") == F.col("_ld")) & (F.col("_b") == F.col("_lt")), "left")
    nodes = met.groupBy("_d").agg(F.sort_array(F.collect_list(F.struct("_i", "_b", F.coalesce("_from", F.lit(-1)).alias("_from"), "_t"))).alias("nodes"))
    n = F.size("nodes")
    start = F.struct(F.transform("nodes", lambda x: x["_from"]).alias("back"), F.sequence(F.lit(0), n - 1).alias("least"), F.transform("nodes", lambda x: F.lit(0)).alias("hops"), F.lit(1).alias("span"))

    def double(s, _):
        at = lambda values, i: F.get(values, F.get(s["back"], i))  # noqa: E731 - null beyond the first of a chain
        lower = lambda i: F.coalesce(at(s["least"], i) < F.get(s["least"], i), F.lit(False))
        back = F.transform(s["back"], lambda b, i: F.coalesce(F.get(s["back"], b), F.lit(-1)))
        least = F.transform(s["least"], lambda x, i: F.when(lower(i), at(s["least"], i)).otherwise(x))
        hops = F.transform(s["hops"], lambda x, i: F.when(lower(i), s["span"] + at(s["hops"], i)).otherwise(x))
        return F.struct(back.alias("back"), least.alias("least"), hops.alias("hops"), (s["span"] * 2).alias("span"))

    rounds = F.sequence(F.lit(1), F.ceil(F.log2(n.cast("double"))).cast("int") + 1)
    done = nodes.withColumn("s", F.aggregate(rounds, start, double))
    order = F.sort_array(F.transform("nodes", lambda x, i: F.struct(F.get("s.least", i).alias("l"), F.get("s.hops", i).alias("h"), x["_b"].alias("b"), x["_t"].alias("t"))))
    out = done.select("_d", F.posexplode(order).alias("_k", "x"))
    return out.select(F.col("_d").alias(doc), F.col("x.b").alias(block), (F.col("_k") + 1).cast("int").alias("seq"), *([F.col("x.t").alias(text)] if text is not None else []))


def compose(ordered: DataFrame, links: DataFrame, doc: str, block: str, body: Callable[[Column], Column] = T.strip_trailing_bbox) -> DataFrame:
    """doc, markdown. ordered: doc, block, seq, text. A fragment whose predecessor is a link's source follows it without a break, headings and markup apart. ``body`` makes a fragment's part of its text."""
    sources = links.select(F.col(doc).alias("_d"), F.col("src").alias("_s")).distinct().withColumn("_is", F.lit(True))
    w = Window.partitionBy(doc).orderBy("seq")
    df = ordered.withColumn("_body", body(F.col("text"))).withColumn("_pb", F.lag("_body").over(w)).withColumn("_pid", F.lag(block).over(w))
    df = df.join(sources, (F.col(doc) == F.col("_d")) & (F.col("_pid") == F.col("_s")), "left")
    header = F.startswith(F.col("_pb"), F.lit("##")) & ~F.col("_pb").contains("\n")
    starts = F.startswith(F.col("_body"), F.lit("##")) | F.startswith(F.col("_body"), F.lit("<div"))
    glue = F.when(F.col("_pid").isNull(), F.lit("")).when(header | starts | F.col("_is").isNull(), F.lit("\n\n")).otherwise(F.lit(""))
    parts = F.sort_array(F.collect_list(F.struct("seq", F.concat(glue, F.col("_body")).alias("part"))))
    return df.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("markdown"))


def render(ordered: DataFrame, doc: str, block: str, body: Callable[[Column], Column] = T.strip_trailing_bbox, white: str = T.WHITE) -> DataFrame:
    """doc, markdown. ordered: doc, block, seq, text, connected. Like ``compose`` with the flag of each fragment given, and with texts stripped of ``white`` before headings are looked for."""
    w = Window.partitionBy(doc).orderBy("seq")
    df = ordered.withColumn("_body", body(F.col("text"))).withColumn("_pb", F.lag("_body").over(w))
    before = T.strip_of(F.col("_pb"), white)
    alone = F.startswith(before, F.lit("##")) & ~before.contains("\n")
    left = T.lstrip_of(F.col("_body"), white)
    opens = F.startswith(left, F.lit("##")) | F.startswith(left, F.lit("<div"))
    glue = F.when(F.col("_pb").isNull(), F.lit("")).when(~F.coalesce("connected", F.lit(False)) | alone | opens, F.lit("\n\n")).otherwise(F.lit(""))
    parts = F.sort_array(F.collect_list(F.struct("seq", F.concat(glue, F.col("_body")).alias("part"))))
    return df.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("markdown"))
