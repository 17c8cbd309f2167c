"""A trained continuity scorer: how likely a text goes on another one, from the two-class softmax of a pair's token ids.

A pair is encoded by a supplied vocabulary and cut to the token budget of ``pair_ids``: the end of the first text, the
beginning of the second. Each side gives two vectors, the mean of its tokens' learned vectors and the mean of the EDGE tokens
next to the seam; the vectors of both sides and their products go through one hidden layer to two logits. Class 1 is "goes on".

It learns from turns of conversations: a turn and the one after it, against the turn and one of another conversation, chosen by
hash. One conversation in three is held out by the checksum of its id; all turns of the others are learnt from. They are dealt
by hash to shares of about SHARE turns. A single share is learnt on the driver. Of more, each is learnt by a task of its own,
once a round, from weights that all start the round with; what they have learnt is summed on the executors, so the driver holds
weights and never turns. The weights, of a few megabytes, are saved to a file or broadcast.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.operators.backends import ENDS, MOST_IDS, loaded, pair_ids
from quireflow.operators.continuity import device_of
from quireflow.plans.registry import BACKENDS, ModelError
from quireflow.tables import Tables, ship

DIM, HIDDEN, EDGE = 16, 32, 8
#: Turns that are learnt at once by a task or by the driver.
SHARE = 16_000
#: What is learnt is summed as integers, as then no order of sums matters: units of one, and parts of a vocabulary that are summed each by itself.
UNIT, PARTS = 2.0**24, 64
#: Texts that are encoded at once, and turns whose candidates are scored at once.
TEXTS, TURNS = 256, 64
#: Others that a true next turn is ranked among, and turns that choose them from each other.
OTHERS, BUCKET_ROWS = 7, 200_000


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a supplied vocabulary, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts by the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = max(self.library.get_vocab_size(), ENDS + 1)

    def __call__(self, texts: Sequence[str | None]) -> list[list[int]]:
        """A few texts at a time, as the library holds much more of each than its ids."""
        parts = (texts[at : at + TEXTS] for at in range(0, len(texts), TEXTS))
        return [x.ids for some in parts for x in self.library.encode_batch([t or "" for t in some], add_special_tokens=False)]


def seen(ids: list[int], most: int = MOST_IDS) -> tuple[list[int], list[int]]:
    """The first and the last ids of a text, as many as a pair may take of it."""
    return ids[: most - 3], ids[-(most - 3) :]


def bags(pairs: Sequence[tuple[list[int], list[int]]], most: int = MOST_IDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row, bag) of pairs' tokens: bags 0 and 2 are the two sides, 1 and 3 their tokens at the seam. Ids that open and end a pair belong to no side."""
    ids, row, bag = [], [], []
    for k, (a, b) in enumerate(pairs):
        whole = pair_ids(a, b, most)
        # where the first side ends: what is left of it after the cut
        n = len(a) if len(a) + len(b) + 3 <= most else min(len(a), (most - 3) // 2)
        one, two = whole[1 : n + 1], whole[n + 2 : -1]
        for kind, part in enumerate((one, one[-EDGE:], two, two[:EDGE])):
            ids += part
            row += [k] * len(part)
            bag += [kind] * len(part)
    return np.array(ids, np.int64), np.array(row, np.int64), np.array(bag, np.int64)


@dataclass
class Weights:
    """Weights by name: tokens' vectors, hidden layer, output layer. The arithmetic is in double precision while it learns."""

    w: dict[str, np.ndarray]

    @classmethod
    def new(cls, size: int, seed: int = 1) -> Weights:
        rng = np.random.default_rng(seed)
        x = 6 * DIM
        return cls({"e": 0.3 * rng.standard_normal((size, DIM)), "h": rng.standard_normal((x, HIDDEN)) / np.sqrt(x), "c": np.zeros(HIDDEN), "o": rng.standard_normal((HIDDEN, 2)) / np.sqrt(HIDDEN), "d": np.zeros(2)})

    def forward(self, ids: np.ndarray, row: np.ndarray, bag: np.ndarray, n: int) -> tuple[np.ndarray, tuple]:
        """Logits (n, 2), and what the gradients need."""
        w = self.w
        at = row * 4 + bag
        count = np.maximum(np.bincount(at, minlength=4 * n), 1)
        order = np.argsort(at, kind="stable")
        sums = np.zeros((4 * n, w["e"].shape[1]))
        if len(ids):
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            sums[at[order][first]] = np.add.reduceat(w["e"][ids[order]].astype(float), first, axis=0)
        mean = (sums / count[:, None]).reshape(n, 4, -1)
        x = np.concatenate([mean[:, 0], mean[:, 2], mean[:, 0] * mean[:, 2], mean[:, 1], mean[:, 3], mean[:, 1] * mean[:, 3]], 1)
        hidden = np.tanh(x @ w["h"] + w["c"])
        return hidden @ w["o"] + w["d"], (at, count, mean, x, hidden)

    def gradients(self, ids: np.ndarray, row: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        n, w = len(labels), self.w
        logits, (at, count, mean, x, hidden) = self.forward(ids, row, bag, n)
        d = softmax(logits)
        d[np.arange(n), labels] -= 1
        d /= n
        g = {"o": hidden.T @ d, "d": d.sum(0)}
        dz = (d @ w["o"].T) * (1 - hidden * hidden)
        g["h"], g["c"] = x.T @ dz, dz.sum(0)
        dx = (dz @ w["h"].T).reshape(n, 6, -1)
        dmean = np.stack([dx[:, 0] + dx[:, 2] * mean[:, 2], dx[:, 3] + dx[:, 5] * mean[:, 3], dx[:, 1] + dx[:, 2] * mean[:, 0], dx[:, 4] + dx[:, 5] * mean[:, 1]], 1)
        each = (dmean.reshape(4 * n, -1) / count[:, None])[at]
        g["e"] = np.zeros_like(w["e"])
        np.add.at(g["e"], ids, each)
        return g

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: x.astype(np.float32) for k, x in self.w.items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Weights:
        with np.load(io.BytesIO(data)) as held:
            return cls({k: held[k] for k in held.files})


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def learn(model: Weights, pairs: Sequence[tuple[list[int], list[int]]], labels: np.ndarray, rng: np.random.Generator, moments: tuple, batch: int, rates: Sequence[float], before: int = 0) -> np.ndarray:
    """One round: Adam over shuffled batches, a rate for each, after ``before`` steps on the same moments. Of every other pair only the tokens at the seam are shown, as a pair of short texts would have them. Gives how often each token was shown."""
    order, (m, v), shown = rng.permutation(len(pairs)), moments, np.zeros(len(model.w["e"]), np.int64)
    for step, (at, rate) in enumerate(zip(range(0, len(order), batch), rates, strict=True), before + 1):
        who = order[at : at + batch]
        short = rng.random(len(who)) < 0.5
        some = [(a[-3 * EDGE :], b[: 3 * EDGE]) if s else (a, b) for (a, b), s in zip((pairs[k] for k in who.tolist()), short.tolist(), strict=True)]
        tokens = bags(some)
        shown += np.bincount(tokens[0], minlength=len(shown))
        g = model.gradients(*tokens, labels[who])
        for k, x in g.items():
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            model.w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return shown


def no_moments(model: Weights) -> tuple:
    return tuple({k: np.zeros_like(x) for k, x in model.w.items()} for _ in range(2))


def rounds(pairs: int, epochs: int = 6, batch: int = 256, least_steps: int = 300) -> int:
    return max(epochs, -(-least_steps * batch // pairs)) if pairs else 0


def train(pairs: Sequence[tuple[list[int], list[int]]], labels: Sequence[int], size: int, seed: int = 1, epochs: int = 6, batch: int = 256, rate: float = 0.01, least_steps: int = 300) -> Weights:
    """At least ``epochs`` rounds, and more where the pairs are so few that they are fewer than ``least_steps`` steps."""
    rng, model = np.random.default_rng(seed), Weights.new(size, seed)
    labels, moments = np.asarray(labels, np.int64), no_moments(model)
    epochs = rounds(len(pairs), epochs, batch, least_steps)
    each = -(-len(pairs) // batch)
    for k in range(epochs):
        rates = [rate * min(1.0, step / 20) * (1 - step / (epochs * each + 1)) for step in range(k * each + 1, (k + 1) * each + 1)]
        learn(model, pairs, labels, rng, moments, batch, rates, k * each)
    return model


class Pairs(Sequence):
    """The pairs of a share of turns: each turn with the one after it (label 1), then with one of another conversation (label 0). Ids are held as arrays; a pair's lists are made when it is asked for."""

    def __init__(self, tails: np.ndarray, tail_ends: np.ndarray, nexts: np.ndarray, next_ends: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        self.held = {"tails": tails, "tail_ends": tail_ends, "nexts": nexts, "next_ends": next_ends, "first": first, "second": second}
        self.tails, self.nexts, self.first, self.second = (tails, tail_ends), (nexts, next_ends), first.tolist(), second.tolist()
        self.labels = (first == second).astype(np.int64)

    @classmethod
    def of(cls, rows: pd.DataFrame) -> Pairs:
        """Of conv_id, turn, tail, next. The other conversation's turn is the first one from a place chosen by checksum, in the order of conversations and turns."""
        convs, tails, nexts = rows["conv_id"].tolist(), *([np.asarray(x, np.int32) for x in rows[c]] for c in ("tail", "next"))
        turns = [(False, 0) if pd.isna(t) else (True, t) for t in rows["turn"].tolist()]
        order = sorted(range(len(convs)), key=lambda k: (convs[k], turns[k], tails[k].tobytes(), nexts[k].tobytes()))
        convs, n = [convs[k] for k in order], len(order)
        after = [n] * n  # where the conversation of a row ends
        for k in range(n - 2, -1, -1):
            after[k] = after[k + 1] if convs[k] == convs[k + 1] else k + 1
        first, second = [], []
        for k, conv in enumerate(convs):
            first.append(k)
            second.append(k)
            at = zlib.crc32(f"{conv}:{len(first)}".encode()) % n
            at = after[at] % n if convs[at] == conv else at
            if convs[at] != conv:
                first.append(k)
                second.append(at)
        flat = [y for x in (tails, nexts) for y in (np.concatenate([np.zeros(0, np.int32), *(x[k] for k in order)]), np.cumsum([len(x[k]) for k in order], dtype=np.int64))]
        return cls(*flat, np.array(first, np.int64), np.array(second, np.int64))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.held)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Pairs:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{k: held[k] for k in held.files})

    def __len__(self) -> int:
        return len(self.first)

    def __getitem__(self, k: int) -> tuple[list[int], list[int]]:
        cut = lambda ids, ends, at: ids[ends[at - 1] if at else 0 : ends[at]].tolist()
        return cut(*self.tails, self.first[k]), cut(*self.nexts, self.second[k])


def train_shares(shares: DataFrame, size: int, seed: int = 1, epochs: int = 6, batch: int = 256, rate: float = 0.01) -> Weights:
    """Weights learnt from all shares (share, data), in ``epochs`` rounds.

    In a round each share is learnt by itself, from the same weights on. Then a token's vector moves by the mean of its moves, counted by how often
    a share has shown it, as most shares lack a rare token; all other weights by the mean counted by pairs.
    """
    sc, model = shares.sparkSession.sparkContext, Weights.new(size, seed)
    ship(shares.sparkSession)
    rest = [k for k in model.w if k != "e"]
    cuts = [size * k // PARTS for k in range(PARTS + 1)]
    kind = "part int, moved binary, shown binary"

    for k in range(epochs):
        held = sc.broadcast(model.w)

        def run(batches, held=held, k=k):
            vectors, others, shown, pairs_shown = np.zeros((size, DIM), np.int64), {n: np.zeros(held.value[n].shape, np.int64) for n in rest}, np.zeros(size, np.int64), 0
            for b in batches:
                for share, data in zip(b["share"], b["data"], strict=True):
                    pairs, own = Pairs.load(data), Weights({n: x.copy() for n, x in held.value.items()})
                    each = -(-len(pairs) // batch)
                    rates = [rate * min(1.0, step / 20) * (1 - (k * each + step) / (epochs * each + 1)) for step in range(1, each + 1)]
                    count = learn(own, pairs, pairs.labels, np.random.default_rng([seed, k, share]), no_moments(own), batch, rates)
                    vectors += np.rint((own.w["e"] - held.value["e"]) * count[:, None] * UNIT).astype(np.int64)
                    for n in rest:
                        others[n] += np.rint((own.w[n] - held.value[n]) * len(pairs) * UNIT).astype(np.int64)
                    shown += count
                    pairs_shown += len(pairs)
            if pairs_shown:
                moved = [*(vectors[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)), np.concatenate([others[n].ravel() for n in rest])]
                counts = [*(shown[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)), np.array([pairs_shown])]
                yield pd.DataFrame({"part": range(PARTS + 1), "moved": [x.tobytes() for x in moved], "shown": [x.tobytes() for x in counts]})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            sums = [sum(np.frombuffer(x, np.int64) for x in rows[c]) for c in ("moved", "shown")]
            return pd.DataFrame({"part": rows["part"].iloc[:1], "moved": [sums[0].tobytes()], "shown": [sums[1].tobytes()]})

        for r in shares.mapInPandas(run, kind).groupBy("part").applyInPandas(add, kind).collect():
            moved, shown = np.frombuffer(r.moved, np.int64) / UNIT, np.frombuffer(r.shown, np.int64)
            if r.part < PARTS:
                model.w["e"][cuts[r.part] : cuts[r.part + 1]] += moved.reshape(-1, DIM) / np.maximum(shown, 1)[:, None]
                continue
            at = 0
            for n in rest:
                model.w[n] += (moved[at : at + model.w[n].size] / shown[0]).reshape(model.w[n].shape)
                at += model.w[n].size
        held.destroy()
    return model


class PairScorer:
    """A ``Scorer`` of trained weights: encodes both texts, cuts the pair to the budget, and gives the probability of class 1."""

    def __init__(self, weights: Weights, path: str, device: str | None = None, most: int = MOST_IDS, batch: int = 512) -> None:
        self.weights, self.path, self.most, self.batch = weights, path, most, batch
        self.device, self._encode = device_of(device), None

    @property
    def available(self) -> bool:
        return self._encode is not None

    def initialize(self) -> None:
        if self._encode is None:
            self._encode = Encoder(self.path)

    def warm_up(self) -> None:
        """One pair, so that tables of the vocabulary are built before the first batch."""
        self.initialize()
        self.compute_scores([("a", "b")])

    def compute_scores(self, pairs: Sequence[tuple[str, str]]) -> list[float]:
        if not self.available:
            raise ModelError("the scorer is not initialised")
        out: list[float] = []
        for at in range(0, len(pairs), self.batch):
            some = pairs[at : at + self.batch]
            out += self.of_ids(list(zip(self._encode([a for a, _ in some]), self._encode([b for _, b in some]), strict=True)))
        return out

    def of_ids(self, pairs: Sequence[tuple[list[int], list[int]]]) -> list[float]:
        """Scores of pairs of ids."""
        return softmax(self.weights.forward(*bags(pairs, self.most), len(pairs))[0])[:, 1].tolist() if len(pairs) else []


@BACKENDS.register("scorer:nsp")
def from_weights(weights: str | None = None, path: str | None = None) -> PairScorer:
    """The scorer of a file of weights, which Arrow's file systems read."""
    from quireflow.sources.datasource import arrow_store

    if weights is None:
        raise ModelError("the scorer needs its weights", section="reorder", key="weights")
    store, at = arrow_store(weights)
    with store.open_input_stream(at) as f:
        return PairScorer(Weights.load(f.read()), path or vocabulary())


# --- conversations ---------------------------------------------------------------------------------------------------------


def held_out(conv: Column) -> Column:
    """One conversation in three, whatever the table."""
    return F.coalesce(F.crc32(conv.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def next_turns(turns: DataFrame, path: str, conv: str = "conv_id", turn: str = "turn", text: str = "text", most: int = MOST_IDS) -> DataFrame:
    """conv_id, turn, head, tail, next: a row per turn with the first and the last ids of its text, and the first ids of the turn after it (null for the last one).

    Turns are ordered by number (null first), then by a hash of the text; rows without a conversation are left out, and null texts are empty. Of a text only as many ids are kept as a pair may take, so rows are small whatever the text.
    """
    ship(turns.sparkSession)

    @F.pandas_udf("struct<head: array<int>, tail: array<int>>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = loaded(f"encoder:{path}", lambda: Encoder(path))
        for texts in batches:
            got = [seen(x, most) for x in e(texts.tolist())]
            yield pd.DataFrame({"head": [a for a, _ in got], "tail": [z for _, z in got]}, index=texts.index)

    own = turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(F.col(text).cast("string")).alias("tie"), encode(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("ids"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "tie")
    return own.select("conv_id", "turn", F.col("ids.head").alias("head"), F.col("ids.tail").alias("tail"), F.lead("ids.head").over(order).alias("next"))


def fit(turns: DataFrame, path: str | None = None, seed: int = 1, share: int = SHARE, rows: DataFrame | None = None, tables: Tables | None = None) -> Weights:
    """Weights learnt from turns (conv_id, turn, text), of which ``rows`` may hold the ids (``next_turns``). Conversations that are held out are never learnt from; all others are."""
    path = path or vocabulary()
    size, spark = Encoder(path).size, turns.sparkSession
    tables = tables or Tables(spark, "nsp")
    rows = tables.cut(next_turns(turns, path), "learnt") if rows is None else rows
    rows = rows.where(F.col("next").isNotNull() & ~held_out(F.col("conv_id"))).select("conv_id", "turn", "tail", "next")
    count = rows.count()
    n = max(1, -(-count // share))

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"share": [key[0]], "data": [Pairs.of(own).dump()]})

    number = F.pmod(F.xxhash64("conv_id", "turn", F.lit("shares")), F.lit(n))
    packed = rows.withColumn("share", number).groupBy("share").applyInPandas(pack, "share long, data binary")
    if n == 1:
        held = packed.collect()
        pairs = Pairs.load(held[0].data) if held else []
        return train(pairs, pairs.labels if held else [], size, seed)
    # a file for each share, so that all cores have some
    packed.write.option("maxRecordsPerFile", 1).parquet(at := tables.path("shares"))
    return train_shares(spark.read.schema(packed.schema).parquet(at), size, seed, rounds(2 * count // n))


def rank_next_turns(turns: DataFrame, weights: Weights, path: str | None = None, others: int = OTHERS, tables: Tables | None = None, rows: DataFrame | None = None) -> DataFrame:
    """conv_id, turn, held_out, score, n_others, place: for every turn that another one follows, the score of the true next turn and its place (from 1) among it and ``others`` turns of other conversations.

    The others are those that come next in the order of hashes, within buckets of hashed keys, so no turn is joined with all.
    Ties count against the true one. A conversation of one turn has no row. ``rows`` may hold the turns' ids (``next_turns``) as a written table.
    """
    path = path or vocabulary()
    spark = turns.sparkSession
    rows = (tables or Tables(spark, "nsp")).cut(next_turns(turns, path), "turns") if rows is None else rows
    n = max(1, -(-rows.count() // BUCKET_ROWS))
    key = F.xxhash64("conv_id", "turn", F.lit("others"))
    by_hash = Window.partitionBy("bucket").orderBy("key", "conv_id", "turn")
    # twice as many are looked at, as some are of the same conversation
    near = [F.lead(F.struct("conv_id", "next"), k).over(by_hash) for k in range(1, 2 * others + 1)]
    met = rows.where(F.col("next").isNotNull()).select("conv_id", "turn", "tail", "next", key.alias("key"), F.pmod(key, F.lit(n)).alias("bucket"))
    met = met.withColumn("near", F.array(*near))
    free = F.filter("near", lambda x: x.isNotNull() & ~x["conv_id"].eqNullSafe(F.col("conv_id")))
    met = met.select("conv_id", "turn", "tail", F.concat(F.array("next"), F.transform(F.slice(free, 1, others), lambda x: x["next"])).alias("candidates"))
    held, name = spark.sparkContext.broadcast(weights), f"nsp:{id(weights)}"

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = loaded("scorer:nsp ranks", lambda: PairScorer(held.value, path), name)
        for tails, candidates in batches:
            out: list[list[float]] = []
            for at in range(0, len(tails), TURNS):
                some = candidates.iloc[at : at + TURNS]
                flat, ends = scorer.of_ids([(t.tolist(), c.tolist()) for t, cs in zip(tails.iloc[at : at + TURNS], some, strict=True) for c in cs]), np.cumsum([len(cs) for cs in some])
                out += [flat[z - len(cs) : z] for cs, z in zip(some, ends.tolist(), strict=True)]
            yield pd.Series(out, index=tails.index, dtype=object)

    out = met.withColumn("scores", score("tail", "candidates"))
    mine = F.get("scores", F.lit(0))
    rest = F.slice("scores", F.lit(2), F.greatest(F.size("scores") - 1, F.lit(0)))
    better = F.size(F.filter(rest, lambda s: s >= mine))
    return out.select("conv_id", "turn", held_out(F.col("conv_id")).alias("held_out"), mine.alias("score"), (F.size("scores") - 1).alias("n_others"), (better + 1).alias("place"))

