"""Text direction by token statistics: a text is read backwards if its mirror image is likelier under the lexicon."""

from __future__ import annotations

import atexit
import functools
import math
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.functions import textclean as T
from quireflow.tables import Tables, ship


#: Log-likelihoods that are as good as equal, and the least frequency.
TIE, LEAST = 1e-9, 0.01


#: Words of a lexicon, the most frequent ones, that token tables are joined to by broadcast.
HOT_WORDS = 300_000


def _dealt(words: DataFrame, freq: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent words of a written table, ``most`` at the most, and the others: parted between two bins of frequencies, of which only the counts come to the driver."""
    level = F.floor(F.log2(F.greatest(F.col(freq).cast("double"), F.lit(LEAST))) * 8)
    above, held = float("inf"), 0
    for r in sorted(words.groupBy(level.alias("level")).count().where("level IS NOT NULL").collect(), reverse=True):
        if (held := held + r["count"]) > most:
            break
        above = r.level
    hot = F.coalesce(level >= F.lit(above), F.lit(False))
    return words.where(hot), words.where(~hot)


def _tokens(text: str) -> Column:
    return F.filter(F.split(F.col(text), r"(?U)\s+", -1), lambda t: t != "")


def log_likelihood(texts: DataFrame, lexicon: DataFrame, keys: list[str], text: str, name: str, hot_words: int = HOT_WORDS) -> DataFrame:
    """keys with ``name``: the sum of ln(max(freq, 0.01) / total) over white-space tokens; -100 without any. lexicon: token, freq.

    Tokens are joined to the most frequent words where they lie, and only sums by key are shuffled. The other tokens are
    joined to the other words by an equi-join, so neither side's size matters.
    """
    words = Tables(texts.sparkSession, "words").cut(lexicon.select("token", F.col("freq").cast("double").alias("freq")), "lexicon")
    total = words.agg(F.sum("freq")).collect()[0][0]
    hot, cold = _dealt(words, "freq", hot_words)
    tokens = texts.select(*keys, F.explode_outer(_tokens(text)).alias("token"))
    each = F.ln(F.greatest(F.coalesce("freq", F.lit(LEAST)), F.lit(LEAST)) / F.lit(total).cast("double"))
    there = tokens.join(F.broadcast(hot), "token", "left").groupBy(*keys).agg(F.sum(F.when(F.col("freq").isNotNull(), each)).alias("_sum"))
    rest = tokens.where(F.col("token").isNotNull()).join(F.broadcast(hot.select("token")), "token", "left_anti").join(cold, "token", "left").groupBy(*keys).agg(F.sum(each).alias("_sum"))
    return there.unionByName(rest).groupBy(*keys).agg(F.coalesce(F.sum("_sum"), F.lit(-100.0)).alias(name))


def judge_direction(texts: DataFrame, lexicon: DataFrame, keys: list[str], text: str, hot_words: int = HOT_WORDS) -> DataFrame:
    """texts with rtl and fixed: whether the mirrored text is likelier, and the text so read. Texts of fewer than two characters stay; so do ties, to TIE, as sums come in any order.

    The mirror image's tokens are the mirrored tokens, so a text is worth more or less than its image by the sum over its tokens of
    a number that each has, from the frequencies of the token and of its mirror image; total and tokens that are in no lexicon
    cancel out. Sums go by the text's digest, divided by its copies, so rows are told apart by nothing else: ``keys`` may be
    null or repeated. The frequent tokens are joined by broadcast, so texts are shuffled once, to meet the judgement. A null
    text is no text: rtl is false and fixed null.
    """
    tables = Tables(texts.sparkSession, "direction")
    gain = F.ln(F.greatest(F.col("freq").cast("double"), F.lit(LEAST)) / F.lit(LEAST))
    known = lexicon.where(F.col("token").isNotNull() & F.col("freq").isNotNull()).select("token", gain.alias("gain"), F.col("freq").cast("double").alias("freq"))
    sides = F.array(F.struct("token", "gain"), F.struct(T.mirror_reverse(F.col("token")).alias("token"), (-F.col("gain")).alias("gain")))
    worth = tables.cut(known.select("freq", F.explode(sides).alias("s")).groupBy("s.token").agg(F.sum("s.gain").alias("gain"), F.max("freq").alias("freq")), "worth")
    hot, cold = (x.select("token", "gain") for x in _dealt(worth, "freq", hot_words))
    own = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    tokens = texts.where(F.length(text) >= 2).select(own.alias("_key"), F.posexplode(_tokens(text)).alias("_n", "token"))
    there = tokens.join(F.broadcast(hot), "token", "left").groupBy("_key").agg(F.sum(F.coalesce("gain", F.lit(0.0))).alias("gain"), F.sum((F.col("_n") == 0).cast("long")).alias("copies"))
    # a token that is its own mirror image is worth nothing
    rest = tokens.where(F.col("token") != T.mirror_reverse(F.col("token"))).join(F.broadcast(hot.select("token")), "token", "left_anti").join(cold, "token")
    rest = rest.groupBy("_key").agg(F.sum("gain").alias("gain"), F.lit(0).cast("long").alias("copies"))
    turned = there.unionByName(rest).groupBy("_key").agg((F.sum("gain") / F.sum("copies")).alias("gain")).where(F.col("gain") < -TIE).select("_key", F.lit(True).alias("_turned"))
    out = texts.withColumn("_own", own).join(turned, F.col("_own") == F.col("_key"), "left")
    rtl = F.coalesce("_turned", F.lit(False))
    return out.withColumn("rtl", rtl).withColumn("fixed", F.when(rtl, T.mirror_reverse(F.col(text))).otherwise(F.col(text))).drop("_own", "_key", "_turned")


#: Labels of blocks whose lines may be turned round.
TURNED_LABELS = ["text", "paragraph_title", "doc_title"]
#: Words of a lexicon that are broadcast at once, or of a shard of it that is made a trie.
MOST_WORDS = 2_000_000
_MIRROR = str.maketrans(T.OPENING + T.MIRRORED, T.MIRRORED + T.OPENING)


def mirrored(line: str) -> str:
    """``textclean.mirror_reverse`` of one line."""
    body = line.rstrip()
    return body.translate(_MIRROR)[::-1] + line[len(body) :]


def segment_words(text: str, lexicon: dict[str, float], total: float) -> list[str]:
    """White-space tokens."""
    return text.split()


def segment_dictionary(text: str, lexicon: dict[str, float], total: float) -> list[str]:
    """The likeliest split into lexicon words of any length and single characters: for scripts without spaces."""
    return best_splits([text], [Trie.of(lexicon, total)], total, words=True)[1][0]


#: Bits of a character in a trie's keys, and characters that are segmented at once.
_CHAR_BITS, CHARS = 21, 200_000


class Trie:
    """A lexicon as sorted arrays: (node, character), of which the n-th leads to node n, and each node's logarithm of probability, if it is a word. Built and walked a level at a time for all words or places."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray) -> None:
        self.keys, self.logs = keys, logs

    @property
    def nodes(self) -> np.ndarray:
        return np.arange(1, len(self.keys) + 1)

    @classmethod
    def of(cls, lexicon: dict[str, float], total: float) -> Trie:
        words = [w for w in lexicon if w]
        return cls.of_words(words, np.array([lexicon[w] for w in words], float), total)

    @classmethod
    def of_words(cls, words: Sequence[str], freq: np.ndarray, total: float) -> Trie:
        """Of words, none of them empty, and their frequencies."""
        codes, ends = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), np.cumsum([len(w) for w in words], dtype=np.int64)
        starts, size = np.concatenate([[0], ends[:-1]]).astype(np.int64), np.diff(ends, prepend=0)
        value = np.log(np.maximum(freq, LEAST) / total)
        node, active, made = np.zeros(len(words), np.int64), np.arange(len(words)), 1
        keys, ending, level = [], [], 0
        while len(active):
            pair = (node[active] << _CHAR_BITS) | codes[starts[active] + level].astype(np.int64)
            new, back = np.unique(pair, return_inverse=True)
            keys.append(new)
            node[active] = made + back
            made += len(new)
            level += 1
            done = size[active] == level
            ending.append(active[done])
            active = active[~done]
        logs = np.full(made, np.nan)
        for own in ending:
            logs[node[own]] = value[own]
        # in order, as nodes of a level are numbered in the order of their keys, after those of the levels before
        return cls(np.concatenate([np.zeros(0, np.int64), *keys]), logs)

    def matches(self, codes: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, stop, log) of every word in the characters; last tells where each place's text ends."""
        out: list[tuple] = []
        at = np.arange(len(codes))
        node, stop = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(at) and len(self.keys):
            key = (node << _CHAR_BITS) | codes[stop]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[place] == key
            at, node, stop = at[there], place[there] + 1, stop[there] + 1
            log = self.logs[node]
            word = ~np.isnan(log)
            out.append((at[word], stop[word], log[word]))
            more = stop < last[at]
            at, node, stop = at[more], node[more], stop[more]
        return tuple(np.concatenate([np.zeros(0, kind), *(x[k] for x in out)]) for k, kind in enumerate((np.int64, np.int64, float)))


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts one after the other, and where each ends."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return codes, np.cumsum([len(t) for t in texts], dtype=np.int64)


def best_splits(texts: Sequence[str], tries: Sequence[Trie], total: float, words: bool = False) -> tuple[list[float], list[list[str]]]:
    """(log-likelihood, words) of the likeliest split of each text; of equal ones that with the shorter last word. Texts without characters have -100.

    By Viterbi over all texts at once: one step for each length that a text has, whatever the number of texts.
    """
    codes, ends = _codes(texts)
    size = np.diff(ends, prepend=0)
    first = ends - size
    last = np.repeat(ends, size)
    parts = [t.matches(codes, last) for t in tries]
    single = np.arange(len(codes))
    start = np.concatenate([single, *(p[0] for p in parts)])
    stop = np.concatenate([single + 1, *(p[1] for p in parts)])
    log = np.concatenate([np.full(len(codes), np.log(LEAST / total)), *(p[2] for p in parts)])
    # a character that is a word counts as the word
    if len(parts):
        known = np.zeros(len(codes), bool)
        for p in parts:
            known[p[0][p[1] == p[0] + 1]] = True
        keep = np.concatenate([~known, np.ones(len(start) - len(codes), bool)])
        start, stop, log = start[keep], stop[keep], log[keep]
    base = np.repeat(first, size)
    step = stop - base[start] if len(start) else stop
    order = np.lexsort((start, stop, step))
    start, stop, log, step = start[order], stop[order], log[order], step[order]
    # best of the characters before each place of each text; a text's own place 0 is worth 0
    best, back = np.zeros(len(codes) + 1), np.zeros(len(codes) + 1, np.int64)
    bounds = np.searchsorted(step, np.arange(1, (int(size.max()) if len(size) else 0) + 2))
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if a == z:
            continue
        s, e = start[a:z], stop[a:z]
        worth = log[a:z] + np.where(s == base[s], 0.0, best[s])
        runs = np.flatnonzero(np.diff(e, prepend=-1))
        most = np.maximum.reduceat(worth, runs)
        tied = worth == np.repeat(most, np.diff(np.append(runs, len(e))))
        pick = np.maximum.reduceat(np.where(tied, np.arange(len(e)), -1), runs)
        best[e[runs]], back[e[runs]] = most, s[pick]
    scores = [float(best[z]) if n else -100.0 for z, n in zip(ends.tolist(), size.tolist(), strict=True)]
    out: list[list[str]] = []
    if words:
        for text, a, z in zip(texts, first.tolist(), ends.tolist(), strict=True):
            own, at = [], z
            while at > a:
                own.append(text[back[at] - a : at - a])
                at = int(back[at])
            out.append(own[::-1])
    return scores, out


class Judge:
    """Judges lines under a lexicon of word frequencies. An error leaves a text as it is. The split by dictionary is made for all lines of a call at once."""

    def __init__(self, lexicon: dict[str, float], segment: Callable[[str, dict[str, float], float], Iterable[str]] = segment_dictionary) -> None:
        self.lexicon, self.total, self.segment = lexicon, float(sum(lexicon.values())) or 1.0, segment
        self.trie = Trie.of(lexicon, self.total) if segment is segment_dictionary else None

    def __getstate__(self) -> dict:
        # the trie holds all that a worker needs
        return self.__dict__ | ({"lexicon": {}} if self.trie is not None else {})

    def log_likelihoods(self, lines: Sequence[str]) -> list[float]:
        if self.trie is None:
            return [self._one(x) for x in lines]
        out: list[float] = []
        for some in by_characters(lines):
            out += best_splits(some, [self.trie], self.total)[0]
        return out

    def _one(self, text: str) -> float:
        tokens = list(self.segment(text, self.lexicon, self.total))
        return sum(math.log(max(self.lexicon.get(t, LEAST), LEAST) / self.total) for t in tokens) if tokens else -100.0

    def log_likelihood(self, text: str) -> float:
        return self.log_likelihoods([text])[0]

    def is_backwards(self, line: str) -> bool:
        return self.backwards([line])[0]

    def backwards(self, lines: Sequence[str]) -> list[bool]:
        """Whether each line's mirror image is likelier. Lines of one character aren't judged."""
        long = [x for x in lines if len(x) >= 2]
        both = self.log_likelihoods([*long, *map(mirrored, long)])
        turned = iter([a < b - TIE for a, b in zip(both[: len(long)], both[len(long) :], strict=True)])
        return [next(turned) if len(x) >= 2 else False for x in lines]

    def fix_texts(self, texts: Sequence[str]) -> list[str]:
        """Each line of each text the way it is likelier."""
        try:
            lines = list({x: None for t in texts for x in t.split("\n")})
            turned = {x for x, back in zip(lines, self.backwards(lines), strict=True) if back}
        except Exception:
            return [self.fix_text(t) for t in texts] if len(texts) > 1 else list(texts)
        return ["\n".join(mirrored(x) if x in turned else x for x in t.split("\n")) for t in texts]

    def fix_text(self, text: str) -> str:
        return self.fix_texts([text])[0]


def by_characters(lines: Sequence[str], most: int = CHARS) -> Iterator[list[str]]:
    """Lines in parts of about so many characters."""
    held, n = [], 0
    for x in lines:
        if held and n + len(x) > most:
            yield held
            held, n = [], 0
        held.append(x)
        n += len(x)
    if held:
        yield held


def lexicon_rows(spark: SparkSession, path: str) -> DataFrame:
    """token, freq of lines ``word frequency ...``. Of a word that is listed again the later line counts."""
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("p"), F.monotonically_increasing_id().alias("n")).where("size(p) >= 2")
    rows = lines.select(F.get("p", F.lit(0)).alias("token"), F.get("p", F.lit(1)).try_cast("double").alias("freq"), "n").where("freq IS NOT NULL")
    return rows.groupBy("token").agg(F.max_by("freq", "n").alias("freq"))


def read_lexicon(spark: SparkSession, path: str, most: int = MOST_WORDS) -> dict[str, float]:
    """word -> frequency, of a lexicon that may be broadcast. More than ``most`` words raise; ``lexicon_rows`` has them as a table."""
    held = lexicon_rows(spark, path).limit(most + 1).collect()
    if len(held) > most:
        raise ValueError("the lexicon is too large to be broadcast")
    return {r.token: r.freq for r in held}


@functools.lru_cache(64)
def mapped(name: str) -> Trie:
    """A trie of files that Spark has sent to this machine, mapped: its workers share one copy, which is no memory of their own."""
    keys, logs = (np.load(SparkFiles.get(f"{name}-{kind}.npy"), mmap_mode="r") for kind in ("keys", "logs"))
    return Trie(keys, logs)


def send(spark: SparkSession, trie: Trie) -> str:
    """Sends a trie's arrays to the executors as files; gives the name by which ``mapped`` has it."""
    name, folder = f"trie-{uuid.uuid4().hex[:12]}", tempfile.mkdtemp(prefix="quireflow-trie-")
    atexit.register(shutil.rmtree, folder, True)
    for kind, x in (("keys", trie.keys), ("logs", trie.logs)):
        np.save(path := f"{folder}/{name}-{kind}.npy", x)
        spark.sparkContext.addFile(path)
    return name


def segment_lines(lines: DataFrame, text: str, lexicon: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """lines with words (an array) and loglik: the likeliest split of each text under a lexicon (token, freq) of any size. A null text has nulls.

    A lexicon of more than ``most`` words is dealt to shards by hash, of which the driver makes one trie after the other. Tries
    go to the executors as files, where workers map them, so what a worker holds is the matches of some CHARS characters.
    """
    spark = lines.sparkSession
    ship(spark)
    lexicon = Tables(spark, "segments").cut(lexicon.select("token", "freq"), "lexicon")  # read by every shard
    n, total = lexicon.agg(F.count(F.lit(1)), F.sum(F.col("freq").cast("double"))).collect()[0]
    shards, total, names = max(1, -(-n // most)), float(total or 1.0), []
    shard = F.pmod(F.xxhash64("token"), F.lit(shards))
    for k in range(shards):
        # about ``most`` rows, as columns: a row's objects are many times as large
        own = lexicon.where((shard == k) & (F.col("token") != "")).select("token", F.col("freq").cast("double").alias("freq")).toArrow()
        names.append(send(spark, Trie.of_words(own["token"].to_pylist(), own["freq"].to_numpy(), total)))
        del own

    @F.pandas_udf("struct<words: array<string>, loglik: double>")
    def choose(texts: pd.Series) -> pd.DataFrame:
        # texts of about one length together, as a split takes a step for each length
        there = sorted((k for k, t in enumerate(texts) if t is not None), key=lambda k: len(texts.iloc[k]))
        rows: list = [(None, None)] * len(texts)
        tries, at = [mapped(x) for x in names], 0
        for some in by_characters([texts.iloc[k] for k in there]):
            scores, words = best_splits(some, tries, total, words=True)
            for k, w, x in zip(there[at : at + len(some)], words, scores, strict=True):
                rows[k] = (w, x)
            at += len(some)
        return pd.DataFrame({"words": [w for w, _ in rows], "loglik": [x for _, x in rows]}, index=texts.index)

    return lines.withColumn("_s", choose(F.col(text))).select(*lines.columns, F.col("_s.words").alias("words"), F.col("_s.loglik").alias("loglik"))


def _wide(b):
    return F.coalesce(b["label"], F.lit("")).isin(*TURNED_LABELS) & (F.coalesce(b["content"], F.lit("")) != "") & (b["x2"] - b["x1"] > b["y2"] - b["y1"])


def fix_direction_by_table(docs: DataFrame, blocks: str, lexicon: DataFrame, tables: Tables, most: int = MOST_WORDS) -> DataFrame:
    """``fix_direction`` under a lexicon (token, freq) of any size: each distinct line is judged once, as a row, and found again by its digest."""
    rows = tables.cut(docs, "turning").withColumn("_row", F.monotonically_increasing_id())  # of a written table, so always the same
    block = rows.select("_row", F.posexplode(blocks).alias("_b", "_block")).where(_wide(F.col("_block")))
    digest = F.sha2(F.col("_line").cast("binary"), 256)
    lines = tables.cut(block.select("_row", "_b", F.posexplode(F.split(F.col("_block.content"), "\n", -1)).alias("_l", "_line")).withColumn("_key", digest), "lines")
    distinct = lines.where(F.length("_line") >= 2).groupBy("_key").agg(F.first("_line").alias("_line"))
    sides = distinct.select("_key", F.explode(F.array(F.struct(F.lit(False).alias("back"), F.col("_line").alias("t")), F.struct(F.lit(True).alias("back"), T.mirror_reverse(F.col("_line")).alias("t")))).alias("s")).select("_key", "s.back", "s.t")
    worth = segment_lines(sides, "t", lexicon, most)
    judged = worth.groupBy(F.col("_key").alias("_k")).agg((F.max(F.when(~F.col("back"), F.col("loglik"))) < F.max(F.when(F.col("back"), F.col("loglik"))) - TIE).alias("_turned"))
    met = lines.join(judged, F.col("_key") == F.col("_k"), "left")
    line = F.when(F.coalesce("_turned", F.lit(False)), T.mirror_reverse(F.col("_line"))).otherwise(F.col("_line"))
    content = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_l", line.alias("t")))), lambda x: x["t"]), "\n")
    fixed = met.groupBy("_row", "_b").agg(content.alias("_c")).groupBy(F.col("_row").alias("_of")).agg(F.map_from_entries(F.collect_list(F.struct("_b", "_c"))).alias("_held"))
    out = rows.join(fixed, F.col("_row") == F.col("_of"), "left")
    turned = F.transform(blocks, lambda b, i: b.withField("content", F.coalesce(F.try_element_at("_held", i), b["content"])))
    return out.withColumn(blocks, F.when(F.col("_held").isNull(), F.col(blocks)).otherwise(turned)).drop("_row", "_of", "_held")


def fix_direction(docs: DataFrame, blocks: str, judge: Judge | None) -> DataFrame:
    """docs whose ``blocks`` (an array of label, x1, y1, x2, y2, content) have the lines of wide text blocks turned round where that is likelier. Without a judge they stay."""
    if judge is None:
        return docs
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(judge)

    @F.pandas_udf("string")
    def fix(texts: pd.Series) -> pd.Series:
        there = texts[texts.notna()]
        return pd.Series(held.value.fix_texts(there.tolist()), index=there.index, dtype=object).reindex(texts.index)

    # one call for all contents of a row, joined by lines of a character that is taken out of them
    contents = F.transform(F.filter(blocks, _wide), lambda b: F.translate(b["content"], "\x1e", " "))
    out = docs.withColumn("_turned", F.split(fix(F.array_join(contents, "\n\x1e\n")), "\n\x1e\n"))
    before = lambda i: F.size(F.filter(F.slice(blocks, F.lit(1), i), _wide))
    turned = F.transform(blocks, lambda b, i: F.when(_wide(b), b.withField("content", F.get("_turned", before(i)))).otherwise(b))
    return out.withColumn(blocks, turned).drop("_turned")
