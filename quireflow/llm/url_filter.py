"""URL filters by a Bloom filter cascade.

A cascade answers membership exactly for every key of a known universe. Level 0 encodes the listed keys; level 1 encodes
the keys of the universe that level 0 wrongly accepts; level 2 the listed keys that level 1 accepts; and so on until no
key is left. A lookup walks the levels to the first that rejects. Here the universe is every key a corpus's urls can match
(host suffixes with path prefixes, for the suffix and prefix sizes of the rules), so a lookup needs no join.

Level 0 has the more bits a key, the more of the universe it has to keep out: so many that about as many wrongly pass as
are listed. So every level follows the list, and the universe only by a fourth root. Bits are set by a grouped bit_or of
64-bit words, so building is one small shuffle for each level. No level holds more than ``max_bytes``: where one would, the
keys are split by hash into more shards, each with a cascade of its own that is broadcast by itself.

Defined cases: a null url, or one without ``://``, has an empty host and path, matches nothing and is allowed; an empty
path matches no rule, as rules' paths begin with a slash. Repeated rows are judged each by itself; a rule that is listed
both ways blocks. Extra columns go through, except those named like the results, which are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, ascii_lower

BITS_PER_KEY, HASHES, MAX_BYTES, MAX_LEVELS = 10, 4, 64 << 20, 60


@dataclass
class Cascade:
    """levels: bit arrays as 64-bit words. A key is its two 64-bit hashes."""

    levels: list[np.ndarray] = field(default_factory=list)
    shard: int = 0
    shards: int = 1

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found, open_ = np.zeros(len(h1), bool), np.ones(len(h1), bool)
        for k, words in enumerate(self.levels):
            hit = np.ones(len(h1), bool)
            for i in range(HASHES):
                at = _positions(h1, h2, k, i, len(words) * 64)
                hit &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            found[open_ & ~hit] = k % 2 == 1
            open_ &= hit
        found[open_] = len(self.levels) % 2 == 1
        return found


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, i: int, bits: int) -> np.ndarray:
    """Like _position, over arrays."""
    return np.mod(np.bitwise_xor(np.right_shift(h1, level + 1), h2) + (np.right_shift(h2, i + 7) ^ h1) * (2 * i + 1), bits)


def _position(level: int, i: int, bits: int) -> Column:
    mixed = F.shiftright("h1", level + 1).bitwiseXOR(F.col("h2"))
    step = F.shiftright("h2", i + 7).bitwiseXOR(F.col("h1"))
    return F.pmod(mixed + step * F.lit(2 * i + 1), F.lit(bits))


def hashes(key: Column) -> list[Column]:
    # cut by two bits, so that sums of them don't overflow in ANSI mode
    return [F.shiftright(F.xxhash64(key), 6), F.shiftright(F.xxhash64(F.concat(F.lit("\x01"), key)), 6)]


def bits_for(keys: int, others: int = 0) -> int:
    """Bits of a level of so many keys, of which about as many of the others pass as there are keys, and one in 80 at most."""
    each = max(BITS_PER_KEY, HASHES * (others / keys) ** (1 / HASHES)) if keys else BITS_PER_KEY
    return 64 * max(1, -(-int(keys * each) // 64))


def _encode(keys: DataFrame, level: int, bits: int) -> np.ndarray:
    at = F.explode(F.array(*[_position(level, i, bits) for i in range(HASHES)])).alias("at")
    words = keys.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS INT)))").alias("bits"))
    out = np.zeros(bits // 64, np.uint64)
    got = words.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _accepted(keys: DataFrame, cascade: Cascade) -> DataFrame:
    """Keys that the last level accepts."""
    words, level = keys.sparkSession.sparkContext.broadcast(cascade.levels[-1]), len(cascade.levels) - 1

    def test(batches):
        for b in batches:
            h1, h2, w, hit = b["h1"].to_numpy(), b["h2"].to_numpy(), words.value, np.ones(len(b), bool)
            for i in range(HASHES):
                at = _positions(h1, h2, level, i, len(w) * 64)
                hit &= (w[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield b[hit]

    return keys.mapInPandas(test, "h1 long, h2 long")


def build_cascades(universe: DataFrame, listed: DataFrame, scratch: Scratch, max_bytes: int = MAX_BYTES) -> list[Cascade]:
    """Cascades over ``universe`` (key) for ``listed`` (key), one for each shard; listed keys belong to the universe anyway."""
    both = universe.select("key", F.lit(False).alias("on")).unionByName(listed.select("key", F.lit(True).alias("on"))).where("key IS NOT NULL")
    h1, h2 = hashes(F.col("key"))
    keys = scratch.cut(both.select(h1.alias("h1"), h2.alias("h2"), "on").groupBy("h1", "h2").agg(F.max("on").alias("on")), "universe")
    counts = {r.on: r["count"] for r in keys.groupBy("on").count().collect()}
    shards = max(1, -(-bits_for(counts.get(True, 0), counts.get(False, 0)) // (8 * max_bytes)))
    while True:
        out = []
        for shard in range(shards):
            cascade = _cascade(keys.where(F.pmod("h2", F.lit(shards)) == shard), Cascade(shard=shard, shards=shards), scratch, max_bytes)
            if cascade is None:
                break
            out.append(cascade)
        else:
            return out
        shards *= 2


def _cascade(keys: DataFrame, cascade: Cascade, scratch: Scratch, max_bytes: int) -> Cascade | None:
    """The levels for a shard's keys; None if one would hold more than max_bytes, and more than the one word that it has at least."""
    counts = {r.on: r["count"] for r in keys.groupBy("on").count().collect()}
    take, rest = keys.where("on").select("h1", "h2"), keys.where("NOT on").select("h1", "h2")
    n, others = counts.get(True, 0), counts.get(False, 0)
    while n:
        if len(cascade.levels) >= MAX_LEVELS:
            raise ValueError("two keys have equal hashes")
        bits = bits_for(n, others if not cascade.levels else 0)
        if bits > max(64, 8 * max_bytes):
            return None
        cascade.levels.append(_encode(take, len(cascade.levels), bits))
        take, rest = scratch.cut(_accepted(rest, cascade), f"level{cascade.shard}-{len(cascade.levels)}"), take
        n = take.count()
    return cascade


def listed_flags(df: DataFrame, keys_col: str, cascades: list[Cascade], name: str) -> DataFrame:
    """Adds ``name``: for each key of the array ``keys_col``, whether it is listed."""
    h1, h2 = F.transform(keys_col, lambda k: hashes(k)[0]), F.transform(keys_col, lambda k: hashes(k)[1])
    df = df.withColumn(name, F.transform(keys_col, lambda k: F.lit(False)))
    for cascade in cascades:
        held = df.sparkSession.sparkContext.broadcast(cascade)

        @F.pandas_udf("array<boolean>")
        def look(a: pd.Series, b: pd.Series, before: pd.Series) -> pd.Series:
            c, sizes = held.value, [len(x) for x in a]
            if not sum(sizes):
                return before
            x, y = np.concatenate(a.to_numpy()).astype(np.int64), np.concatenate(b.to_numpy()).astype(np.int64)
            on = (np.mod(y, c.shards) == c.shard) & c.contains(x, y)
            on |= np.concatenate(before.to_numpy()).astype(bool)
            return pd.Series([p.tolist() for p in np.split(on, np.cumsum(sizes)[:-1])])

        df = df.withColumn(name, look(h1, h2, F.col(name)))
    return df


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return ascii_lower(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every rule string that could fit, of the given numbers of host labels and path lengths, longest first."""
    parts = F.split(host, r"\.", -1)
    keys = [F.when((F.size(parts) >= m) & (F.length(path) >= n), F.concat(F.array_join(F.slice(parts, F.greatest(F.size(parts) - m + 1, F.lit(1)), F.lit(m)), "."), F.left(path, F.lit(n)))) for m in labels for n in lengths]
    longest = F.array_sort(F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull())), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, F.lit(-1)).otherwise(F.when(a > b, F.lit(1)).otherwise(F.lit(0))))
    return longest


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """pages with host, path, rule (the longest that fits, or null) and verdict. rules: rule (host/path), verdict (allow or block)."""
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "urls")
    rules = scratch.cut(rules.where(F.col("rule").isNotNull()).select(F.regexp_extract("rule", r"^[^/]*", 0).alias("host"), F.col("rule").alias("key"), F.col("verdict")), "rules")
    labels = [r[0] for r in rules.select(F.size(F.split("host", r"\.", -1))).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("key") - F.length("host")).distinct().collect()]
    # the columns in a struct, so that no name of theirs can clash
    made = ["host", "path", "rule", "verdict"]
    names = [c for c in pages.columns if c not in made]
    host, path = split_url(F.col(f"page.`{url_col}`"))
    keyed = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("page")).withColumn("host", host).withColumn("path", path)
    keyed = keyed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), sorted(labels), sorted(lengths)))
    listed = build_cascades(keyed.select(F.explode("keys").alias("key")), rules.select("key"), scratch, max_bytes)
    blocked = build_cascades(rules.select("key"), rules.where("verdict = 'block'").select("key"), scratch, max_bytes)
    scratch.drop(*list(scratch.held))  # what is left is the cascades
    flagged = listed_flags(keyed, "keys", listed, "listed")
    # the keys are sorted, so the first listed one is the longest
    flagged = flagged.withColumn("rule", F.get(F.transform(F.filter(F.arrays_zip("keys", "listed"), lambda x: x["listed"]), lambda x: x["keys"]), F.lit(0)))
    flagged = listed_flags(flagged.withColumn("keys", F.array(F.coalesce("rule", F.lit("")))), "keys", blocked, "block")
    verdict = F.when(F.col("rule").isNotNull() & F.get("block", F.lit(0)), F.lit("block")).otherwise(F.lit("allow")).alias("verdict")
    return flagged.select(*(F.col(f"page.`{c}`") for c in names), "host", "path", "rule", verdict)
