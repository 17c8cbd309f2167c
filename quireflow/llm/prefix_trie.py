"""Conversation prefix trie: which conversations begin alike, and what a shared cache of prefixes would save.

``rebuild`` makes the conversations: each takes over the first turns of its family's first one. ``trie_nodes`` then goes

1. turns become digests, and each prefix of a conversation a pair of 64-bit exclusive ors of its turns' mixed hashes, so that
   a prefix and its parent are known from one running aggregate (``running``: in blocks, so that a conversation of any length
   is many keys),
2. each task builds partial tries of its rows: a node's smallest member, number of members and list of those that end there,
3. the partial tries are merged FAN at a time by node, until one is left. A node that every task has, such as the root, never
   brings more than FAN rows together. A list of ends that has grown over MOST_ENDS is set aside and not merged on,
4. subtree sums go up along the conversations: each node's own figures stand on its smallest member's path, a running sum
   from the last turn gives what lies below, and one grouped sum by node adds up the members.

No step depends on the depth. Lists of ends are digested where they are whole; those of nodes with a list set aside are sorted by
range and digested as a stream, piece by piece, in constant memory (such a digest is sequential by nature).

Defined cases: null roles and texts are empty; rows without a conversation's id are left out; turns with equal numbers are
ordered by the digest of role and text, null numbers first; repeated rows are turns each. Extra columns are ignored; without
conversations there are no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, ship

#: Conversations of a family, and the most turns that one takes over.
FAMILY, MOST_HEAD = 5, 8
#: Turns of a block, rows of a partial trie, partial tries merged at once, and ends in a list that is still merged.
BLOCK, LOCAL_ROWS, FAN, MOST_ENDS = 512, 200_000, 16, 50_000
NODE = ["hi", "lo", "depth"]


def running(df: DataFrame, key: list[str], block: str, order: list[Column], made: dict[str, tuple], scratch: Scratch, name: str) -> DataFrame:
    """df with, for each name of ``made``, the aggregate over the rows of the same key up to and including the own one.

    made: name -> (aggregate, value, how two of them are joined). ``block`` is an integer that goes up with the order. The
    running part is within a block; what the earlier blocks of a key give is joined, so a long key isn't one task.
    """
    df = scratch.cut(df, name)
    inner = Window.partitionBy(*key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumns({n: agg(value).over(inner) for n, (agg, value, _) in made.items()})
    totals = df.groupBy(*key, block).agg(*(agg(value).alias(n) for n, (agg, value, _) in made.items()))
    before = totals.withColumns({f"_{n}": agg(F.col(n)).over(earlier) if agg is not F.count else F.sum(n).over(earlier) for n, (agg, _, _) in made.items()})
    some = f"_{next(iter(made))}"
    before = before.where(F.col(some).isNotNull()).select(*(F.col(k).alias(f"_{k}") for k in key), F.col(block).alias("_at"), *(f"_{n}" for n in made))
    same = F.col(block) == F.col("_at")
    for k in key:
        same = same & (F.col(k) == F.col(f"_{k}"))
    met = out.join(before, same, "left")
    return met.select(*df.columns, *(F.when(F.col(f"_{n}").isNull(), F.col(n)).otherwise(join(F.col(n), F.col(f"_{n}"))).alias(n) for n, (_, _, join) in made.items()))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def digested(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos (from 1), key (digest of role and text), bytes (of the text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")).cast("binary")))
    number = F.col("turn").cast("long")
    block = F.coalesce(F.floor(number / F.lit(BLOCK)), F.lit(-(2**62))).cast("long")
    lean = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), number.alias("turn"), block.alias("block"), key.alias("key"), F.octet_length(text("text")).cast("long").alias("bytes"))
    rows = running(lean, ["conv_id"], "block", [F.col("turn").asc_nulls_first(), F.col("key")], {"pos": (F.count, F.lit(1), _plus)}, scratch, "turns")
    return rows.select("conv_id", "pos", "key", "bytes")


def rebuild(turns: DataFrame, scratch: Scratch, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each conversation c has taken over the first h turns of c - c % family, and gone on with its own after its first h.

    conversations: conv_id, n_turns; turns: conv_id, depth (from 1), key, bytes.
    """
    rows = scratch.cut(digested(turns, scratch), "positions")
    base = F.col("conv_id") - F.col("conv_id") % F.lit(family)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(MOST_HEAD + 1)
    all_of = rows.groupBy("conv_id").agg(F.max("pos").alias("own")).select("conv_id", "own", base.alias("base"), h.alias("h"))
    # of a family's first conversation, MOST_HEAD turns at most
    heads = rows.where((F.col("conv_id") % F.lit(family) == 0) & (F.col("pos") <= MOST_HEAD)).groupBy(F.col("conv_id").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("pos", "key", "bytes"))).alias("_head"))
    met = all_of.join(heads, F.col("base") == F.col("_base"), "left")
    head = F.filter(F.coalesce("_head", F.array().cast("array<struct<pos: bigint, key: binary, bytes: bigint>>")), lambda t: t["pos"] <= F.col("h"))
    info = scratch.cut(met.select("conv_id", "h", "own", head.alias("head")), "families")
    taken = info.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.key", "t.bytes")
    side = info.select(F.col("conv_id").alias("_conv"), "h", F.size("head").cast("long").alias("n_head"))
    own = rows.join(side, F.col("conv_id") == F.col("_conv")).where(F.col("pos") > F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("depth"), "key", "bytes")
    convs = info.select("conv_id", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n_turns"))
    return convs, taken.unionByName(own)


def members(convs: DataFrame, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, hi, lo, depth, phi, plo, bytes, ends: a row for each conversation and each of its prefixes, the empty one included; phi and plo are the parent's, 0 for the root."""
    mixed = turns.select("conv_id", "depth", "bytes", F.floor((F.col("depth") - 1) / F.lit(BLOCK)).cast("long").alias("block"), F.xxhash64("key", "depth").alias("a"), F.xxhash64(F.lit("second"), "depth", "key").alias("b"))
    rows = running(mixed, ["conv_id"], "block", [F.col("depth")], {"hi": (F.bit_xor, F.col("a"), _xor), "lo": (F.bit_xor, F.col("b"), _xor)}, scratch, "mixed")
    last = convs.select(F.col("conv_id").alias("_conv"), F.col("n_turns").alias("_last"))
    rows = rows.join(last, F.col("conv_id") == F.col("_conv")).select("conv_id", "hi", "lo", "depth", _xor(F.col("hi"), F.col("a")).alias("phi"), _xor(F.col("lo"), F.col("b")).alias("plo"), "bytes", (F.col("depth") == F.col("_last")).alias("ends"))
    roots = convs.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in ("hi", "lo", "depth", "phi", "plo", "bytes")), (F.col("n_turns") == 0).alias("ends"))
    return scratch.cut(rows.unionByName(roots), "members")


PARTIAL = "hi long, lo long, depth long, phi long, plo long, bytes long, conv_id long, n_convs long, ends array<long>, part long"


def partial_tries(rows: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Nodes of partial tries, each of up to about ``local_rows`` rows of one task: with the smallest member, the number of members, the ends in ascending order, and the partition."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def trie() -> pd.DataFrame:
            df = pd.concat(held)
            held.clear()
            nodes = df.groupby(NODE, sort=False).agg(phi=("phi", "first"), plo=("plo", "first"), bytes=("bytes", "first"), conv_id=("conv_id", "min"), n_convs=("conv_id", "size"), part=("part", "first"))
            ends = df[df["ends"]].sort_values("conv_id").groupby(NODE, sort=False)["conv_id"].agg(list)
            nodes["ends"] = ends.reindex(nodes.index)
            nodes["ends"] = nodes["ends"].map(lambda x: x if isinstance(x, list) else [])
            nodes = nodes.reset_index()
            return nodes[[c.split()[0] for c in PARTIAL.split(", ")]]

        n = 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= local_rows:
                yield trie()
                n = 0
        if held:
            yield trie()

    ship(rows.sparkSession)
    return rows.withColumn("part", F.spark_partition_id().cast("long")).mapInPandas(build, PARTIAL)


def merge_tries(partial: DataFrame, parts: int, fan: int = FAN, most_ends: int = MOST_ENDS) -> DataFrame:
    """One trie of all partial ones, merged ``fan`` at a time by node: the columns of PARTIAL without part, and ``run``.

    A row whose run is null is a node; other rows are lists of ends of that node that were set aside, as they were over ``most_ends``.
    """
    out = partial.withColumn("run", F.lit(None).cast("long"))
    first = True
    while first or parts > 1:
        first, parts = False, -(-parts // fan)
        group = F.floor(F.col("part") / F.lit(fan)).cast("long")
        merged = out.groupBy(*NODE, "run", group.alias("_part")).agg(*(F.first(c).alias(c) for c in ("phi", "plo", "bytes")), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sort_array(F.flatten(F.collect_list("ends"))).alias("_ends"))
        aside = F.col("run").isNull() & (F.size("_ends") > most_ends)
        none = F.array().cast("array<bigint>")
        row = lambda run, n, ends: F.struct(run.alias("run"), n.alias("n_convs"), ends.alias("ends"))
        kept = F.array(row(F.col("run"), F.col("n_convs"), F.col("_ends")))
        split = F.array(row(F.lit(None).cast("long"), F.col("n_convs"), none), row(F.get("_ends", F.lit(0)), F.lit(0).cast("long"), F.col("_ends")))
        out = merged.select(*NODE, "phi", "plo", "bytes", "conv_id", F.col("_part").alias("part"), F.explode(F.when(aside, split).otherwise(kept)).alias("r")).select(*NODE, "phi", "plo", "bytes", "conv_id", "part", "r.*")
    return out.drop("part")


def long_digests(runs: DataFrame, piece: int = MOST_ENDS) -> DataFrame:
    """hi, lo, depth, sha: digests of ends too many for one list. runs: hi, lo, depth, ends, several rows a node.

    Ids are dealt by ranges of node and id, so the ids of one node lie in several tasks; each task joins its own to pieces of text
    in ascending order, and a second step reads a node's pieces one after the other.
    """
    ids = runs.select(*NODE, F.explode("ends").alias("id"))
    # the number of partitions is told, as adaptive coalescing would put a large node into one
    dealt = ids.repartitionByRange(max(2, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *NODE, "id").sortWithinPartitions(*NODE, "id")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), piece):
                some = b.iloc[at : at + piece]
                yield some.groupby(NODE, sort=False)["id"].agg(first="first", body=lambda x: ",".join(map(str, x.tolist()))).reset_index()

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha = None, None
        for b in batches:
            out = []
            for *node, _, body in b.itertuples(index=False, name=None):
                if node != now:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(body.encode())
            yield pd.DataFrame(out, columns=[*NODE, "sha"])
        if now is not None:
            yield pd.DataFrame([(*now, sha.hexdigest())], columns=[*NODE, "sha"])

    kind = "hi long, lo long, depth long"
    texts = dealt.mapInPandas(pieces, f"{kind}, first long, body string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(stream, f"{kind}, sha string")


def trie_nodes(turns: DataFrame, family: int = FAMILY, local_rows: int = LOCAL_ROWS, fan: int = FAN, most_ends: int = MOST_ENDS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row per node of the trie of the rebuilt conversations.

    turns: conv_id, turn, role, text. saved_tokens counts the UTF-8 bytes of the text of turns that need not be computed again.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    convs, rebuilt = rebuild(turns, scratch, family)
    convs = scratch.cut(convs, "conversations")
    rows = members(convs, rebuilt, scratch)
    partial = scratch.cut(partial_tries(rows, local_rows), "partial")
    parts = (partial.agg(F.max("part")).collect()[0][0] or 0) + 1
    merged = scratch.cut(merge_tries(partial, parts, fan, most_ends), "merged")
    scratch.drop("partial", "positions", "families", "turns", "mixed")

    nodes = merged.where("run IS NULL").select(*NODE, "phi", "plo", "bytes", "conv_id", "n_convs", "ends")
    children = nodes.where("depth > 0").groupBy(F.col("phi").alias("_hi"), F.col("plo").alias("_lo"), (F.col("depth") - 1).alias("_depth")).agg(F.count(F.lit(1)).alias("n_children"))
    at = (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")) & (F.col("depth") == F.col("_depth"))
    nodes = nodes.join(children, at, "left").drop("_hi", "_lo", "_depth").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.cut(nodes, "nodes")

    # each node's own figures on the path of its smallest member, summed up from the last turn
    own = nodes.select(F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    paths = rows.join(own, (F.col("conv_id") == F.col("_conv")) & (F.col("depth") == F.col("_depth")), "left")
    paths = paths.select("conv_id", *NODE, (-F.floor(F.col("depth") / F.lit(BLOCK))).cast("long").alias("block"), F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved"))
    below = running(paths, ["conv_id"], "block", [F.col("depth").desc()], {"n_leaves": (F.sum, F.col("leaf"), _plus), "saved_tokens": (F.sum, F.col("saved"), _plus)}, scratch, "paths")
    sums = below.groupBy(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.col("depth").alias("_depth")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    out = nodes.join(sums, at).drop("_hi", "_lo", "_depth")

    parents = nodes.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), (F.col("depth") + 1).alias("_depth"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(parents, (F.col("phi") == F.col("_hi")) & (F.col("plo") == F.col("_lo")) & (F.col("depth") == F.col("_depth")), "left").drop("_hi", "_lo", "_depth")
    large = merged.where("run IS NOT NULL").select(*NODE).distinct()
    runs = merged.select(*NODE, "ends").join(large, NODE, "left_semi")
    shas = long_digests(runs, most_ends).select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.col("depth").alias("_depth"), "sha")
    out = out.join(shas, at, "left")
    sha = F.coalesce("sha", F.sha2(F.array_join(F.col("ends").cast("array<string>"), ",").cast("binary"), 256))
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", sha.alias("ends_sha256"))
    return scratch.finish(out)
