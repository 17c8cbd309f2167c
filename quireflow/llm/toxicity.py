"""Toxicity by a bidirectional GRU with attention pooling over word and character inputs, trained in numpy.

A text's A-Z are lower-cased, ASCII punctuation is taken out, and the words are cut into windows of WINDOW words that
overlap by half. A word's input is a learned vector (zero for unknown words), its log odds in the training texts, and the
mean of learned vectors of its character trigrams. A window's hidden states are pooled by attention and scored; a text's
score is that of its worst window. All windows of all texts are scored.

Labels are of documents, so the toxic windows of toxic documents are found while training: first by log odds, then by the
model itself. The training sample is bounded by rows: MAX_TOXIC and MAX_OTHER documents with the smallest hashed ids, of
which all windows are used, and all words that two of them hold. The driver trains on it; the model of some hundred KB is
broadcast.

Defined cases: a null or empty text is one window of padding and gets the score of no evidence; repeated rows get equal
scores; without labels of both kinds every score is 0. Null labels and ids are never learned from; an id that is labelled
more than once is toxic if one of its labels says so; documents that share a sampled id are learned from as one. Extra
columns go through drop_toxic, and are ignored otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, ship, small_batches, worker_forget, worker_kept

WINDOW, STEP = 24, 12
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND, TRIGRAMS = 6, 6, 8, 8, 4096
MAX_TOXIC, MAX_OTHER = 1333, 3333
#: Words kept by a worker at most, and windows scored at once.
KEPT, BATCH = 60_000, 512
THRESHOLD = 0.7
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER, _PUNCTUATION).split()


def window_starts(n: int) -> np.ndarray:
    """Starts of windows that cover n words; the last one ends with the text."""
    return np.append(np.arange(0, n - WINDOW, STEP), n - WINDOW) if n > WINDOW else np.zeros(1, np.int64)


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of the words, and where each word's begin."""
    data = np.frombuffer(b"\x00" + b"\x00".join(words) + b"\x00", np.uint8).astype(np.uint32)
    at = np.flatnonzero(data)
    bucket = ((data[at - 1] * np.uint32(0x9E3779B1)) ^ (data[at] * np.uint32(0x85EBCA77)) ^ (data[at + 1] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
    return (bucket >> np.uint32(20)).astype(np.int64) % TRIGRAMS, np.concatenate([[0], np.cumsum([len(w) for w in words])[:-1]]).astype(np.int64)


class Model:
    """Weights by name. ``known`` maps training words to their row; row 0 is for unknown words and padding."""

    def __init__(self, known: dict[bytes, int], odds: np.ndarray, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.known, self.odds = known, odds.astype(np.float32)
        d, h = WORD_DIM + 1 + CHAR_DIM, HIDDEN
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])).astype(np.float32)
        self.w = {"word": 0.1 * init(len(odds), WORD_DIM), "char": 0.3 * rng.standard_normal((TRIGRAMS, CHAR_DIM)).astype(np.float32), "x": init(2, d, 3 * h), "b": np.zeros((2, 1, 3 * h), np.float32), "u": init(2, h, 3 * h), "a": init(2 * h, ATTEND), "v": init(ATTEND), "o": init(2 * h), "c": np.array([-1.0], np.float32)}
        self.w["word"][0] = 0
        self.shift = 0.0

    def inputs(self, words: list[bytes], rows: np.ndarray | None = None) -> np.ndarray:
        """Input vectors of words, of row 0 for padding if words is empty."""
        if not words:
            return np.zeros((0, WORD_DIM + 1 + CHAR_DIM), np.float32)
        bucket, start = trigrams(words)
        size = np.array([len(x) for x in words], np.float32)[:, None]
        char = np.add.reduceat(self.w["char"][bucket], start, axis=0) / size
        rows = np.fromiter((self.known.get(x, 0) for x in words), np.int64, len(words)) if rows is None else rows
        return np.concatenate([self.w["word"][rows], self.odds[rows][:, None], char], 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Both directions' gate inputs: (2, words, 3 * HIDDEN)."""
        return x[None] @ self.w["x"] + self.w["b"]

    def states(self, gates: np.ndarray, keep: list | None = None) -> np.ndarray:
        """gates: (2, time, windows, 3 * HIDDEN), the second direction reversed in time. Hidden states (2, time, windows, HIDDEN)."""
        _, steps, n, _ = gates.shape
        h, u, out = np.zeros((2, n, HIDDEN), np.float32), self.w["u"], np.empty((2, steps, n, HIDDEN), np.float32)
        for t in range(steps):
            g, r = gates[:, t], h @ u
            zr = np.tanh(0.5 * (g[..., : 2 * HIDDEN] + r[..., : 2 * HIDDEN])) * np.float32(0.5) + np.float32(0.5)
            z, reset = zr[..., :HIDDEN], zr[..., HIDDEN:]
            new = np.tanh(g[..., 2 * HIDDEN :] + reset * r[..., 2 * HIDDEN :])
            if keep is not None:
                keep.append((h, z, reset, new, r[..., 2 * HIDDEN :]))
            h = new + z * (h - new)
            out[:, t] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        """Logits of windows. mask: (time, windows), 1 where there is a word."""
        both = np.concatenate([states[0], states[1][::-1]], 2)
        t = np.tanh(both @ self.w["a"])
        e = t @ self.w["v"]
        e = np.where(mask, e, e - 30)
        e = np.exp(e - e.max(0))
        a = e / e.sum(0)
        pooled = (a[..., None] * both).sum(0)
        return pooled @ self.w["o"] + self.w["c"], (both, t, a, pooled)

    def logits(self, projected: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """ids: (time, windows) into projected's words."""
        gates = np.stack([projected[0][ids], projected[1][ids[::-1]]])
        return self.pool(self.states(gates), mask)[0] + np.float32(self.shift)


def _gradients(model: Model, words: list[bytes], ids: np.ndarray, mask: np.ndarray, labels: np.ndarray, weights: np.ndarray, drop: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss. words: the batch's distinct words (row 0: padding); drop: words taken as unknown."""
    w, h = model.w, HIDDEN
    rows = np.fromiter((model.known.get(x, 0) for x in words), np.int64, len(words))
    rows[drop] = 0
    x = np.concatenate([np.zeros((1, WORD_DIM + 1 + CHAR_DIM), np.float32), model.inputs(words, rows)])
    projected, keep = model.project(x), []
    back = ids[::-1]
    states = model.states(np.stack([projected[0][ids], projected[1][back]]), keep)
    logit, (both, t, a, pooled) = model.pool(states, mask)
    p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    d = ((p - labels) * weights / weights.sum()).astype(np.float32)
    g = {"o": pooled.T @ d, "c": np.array([d.sum()], np.float32)}
    dpool = d[:, None] * w["o"]
    da = (dpool[None] * both).sum(2)
    dboth = a[..., None] * dpool[None]
    de = a * (da - (a * da).sum(0))
    dt = de[..., None] * w["v"] * (1 - t * t)
    g["v"] = np.einsum("tn,tnk->k", de, t)
    flat = both.reshape(-1, 2 * h)
    g["a"] = flat.T @ dt.reshape(-1, ATTEND)
    dboth = dboth + dt @ w["a"].T
    dstates = np.stack([dboth[..., :h], dboth[::-1, :, h:]])
    steps, n = ids.shape
    dgates, dh, du = np.empty((2, steps, n, 3 * h), np.float32), np.zeros((2, n, h), np.float32), np.zeros_like(w["u"])
    for k in range(steps - 1, -1, -1):
        before, z, reset, new, rn = keep[k]
        dh = dh + dstates[:, k]
        dnew, dz = dh * (1 - z) * (1 - new * new), dh * (before - new) * z * (1 - z)
        dreset = dnew * rn * reset * (1 - reset)
        dr = np.concatenate([dz, dreset, dnew * reset], 2)
        dgates[:, k] = np.concatenate([dz, dreset, dnew], 2)
        du += before.transpose(0, 2, 1) @ dr
        dh = dh * z + dr @ w["u"].transpose(0, 2, 1)
    g["u"] = du
    dproj = np.zeros_like(projected)
    for side, at in ((0, ids), (1, back)):
        np.add.at(dproj[side], at.ravel(), dgates[side].reshape(-1, 3 * h))
    g["b"], g["x"] = dproj.sum(1, keepdims=True), x.T[None] @ dproj
    dx = (dproj @ w["x"].transpose(0, 2, 1)).sum(0)[1:]
    g["word"] = np.zeros_like(w["word"])
    np.add.at(g["word"], rows, dx[:, :WORD_DIM])
    g["word"][0] = 0
    bucket, _ = trigrams(words)
    size = np.array([len(x) for x in words])
    g["char"] = np.zeros_like(w["char"])
    np.add.at(g["char"], bucket, np.repeat(dx[:, WORD_DIM + 1 :] / size[:, None], size, axis=0))
    return g


@dataclass
class Sample:
    """Training documents: ids, labels, and words as places in ``names``."""

    ids: list[int]
    toxic: list[int]
    words: list[np.ndarray]
    names: list[bytes]

    @classmethod
    def of(cls, rows: list[tuple[int, int, list[bytes]]]) -> Sample:
        """rows: id, label, words; in the order of ids."""
        place: dict[bytes, int] = {}
        rows = sorted(rows, key=lambda r: r[0])
        words = [np.array([place.setdefault(w, len(place)) for w in own], np.int32) for _, _, own in rows]
        return cls([i for i, _, _ in rows], [t for _, t, _ in rows], words, list(place))

    def part(self, which: list[int]) -> Sample:
        return Sample([self.ids[k] for k in which], [self.toxic[k] for k in which], [self.words[k] for k in which], self.names)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """All windows of all documents, words as places from 1 and 0 for padding, and each window's document."""
        ids, owner = [], []
        for k, w in enumerate(self.words):
            starts = window_starts(len(w))
            padded = np.concatenate([w + 1, np.zeros(max(0, WINDOW - len(w)), np.int32)])
            ids.append(padded[starts[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(starts), k))
        return np.concatenate(ids).astype(np.int32), np.concatenate(owner)


def log_odds(sample: Sample) -> tuple[dict[bytes, int], np.ndarray]:
    """Words of two training texts or more, with the log of how much likelier they are in toxic ones."""
    seen, totals = np.zeros((2, len(sample.names)), np.int64), np.bincount(sample.toxic, minlength=2)
    for toxic, words in zip(sample.toxic, sample.words, strict=True):
        seen[toxic, np.unique(words)] += 1
    often = sorted(np.flatnonzero(seen.sum(0) > 1).tolist(), key=lambda k: (-seen[:, k].sum(), sample.names[k]))
    odds = np.log((seen[1, often] + 1) / (totals[1] + 2)) - np.log((seen[0, often] + 1) / (totals[0] + 2))
    return {sample.names[k]: n + 1 for n, k in enumerate(often)}, np.clip(np.concatenate([[0.0], odds]), -2, 7) / 2


def train(sample: Sample, seed: int = 1) -> Model | None:
    """None if a kind is missing.

    The model learns from three quarters of the sample. The others, scored by it as any text is, give the cut with the best
    F1, which the logits are shifted to: a cut holds for the model that it was found with, not for another one that learnt
    from all. Where the others lack a kind, the model learns from all and is not shifted.
    """
    toxic = np.array(sample.toxic)
    if len(np.unique(toxic)) < 2:
        return None
    part = np.zeros(len(toxic), int)
    for kind in (0, 1):
        mine = np.flatnonzero(toxic == kind)
        part[mine] = np.arange(len(mine)) % 4
    rest = np.flatnonzero(part == 3).tolist()
    if len(np.unique(toxic[rest])) < 2:
        return _fit(sample, seed)
    model = _fit(sample.part(np.flatnonzero(part < 3).tolist()), seed)
    scorer = Scorer(model)
    worst = [scorer.worst([sample.names[w] for w in sample.words[k]]) for k in rest]
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - _best_cut(np.array(worst), toxic[rest]))
    return model


def _fit(sample: Sample, seed: int, epochs: int = 8, batch: int = 128, rate: float = 0.01, least_steps: int = 150) -> Model:
    """At least ``epochs`` rounds over the chosen windows, and more of them where a sample is so small that they are fewer than ``least_steps`` steps."""
    rng = np.random.default_rng(seed)
    known, odds = log_odds(sample)
    model = Model(known, odds, seed)
    ids, doc = sample.windows()
    toxic, names = np.array(sample.toxic), sample.names
    word_odds = np.concatenate([[0.0], odds[[known.get(w, 0) for w in names]]])
    score = word_odds[ids].max(1)
    m, v, step = {k: np.zeros_like(x) for k, x in model.w.items()}, {k: np.zeros_like(x) for k, x in model.w.items()}, 0
    negative = np.flatnonzero(toxic[doc] == 0)
    kinds = np.bincount(toxic, minlength=2)
    epochs = max(epochs, -(-least_steps * batch // max(1, min(13 * kinds[1], kinds[1] + len(negative)))))
    for epoch in range(epochs):
        # of a toxic document, the windows that look worst are its toxic ones; of the others, all
        worst = np.full(len(toxic), -np.inf)
        np.maximum.at(worst, doc, score)
        positive = np.flatnonzero((toxic[doc] == 1) & (score >= worst[doc] - 1e-9))
        hard = negative[np.argsort(-score[negative], kind="stable")[: 4 * len(positive)]]
        soft = rng.choice(negative, min(len(negative), 8 * len(positive)), replace=False)
        chosen = rng.permutation(np.unique(np.concatenate([positive, hard, soft])))
        for at in range(0, len(chosen), batch):
            who = chosen[at : at + batch]
            own, local = np.unique(ids[who], return_inverse=True)
            if own[0] != 0:
                own, local = np.concatenate([[0], own]), local + 1
            local = local.reshape(len(who), WINDOW).T
            words = [names[k - 1] for k in own[1:]]
            if not words:
                continue
            label = toxic[doc[who]].astype(np.float32)
            weight = np.where(label == 1, 3.0, 1.0).astype(np.float32)
            g = _gradients(model, words, local, ids[who].T > 0, label, weight, np.flatnonzero(rng.random(len(words)) < 0.25))
            step += 1
            lr = rate * min(1.0, step / 20) * (0.3 if epoch >= epochs - 2 else 1.0)
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                model.w[k] = (model.w[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6) - (lr * 1e-3 * model.w[k] if k in ("word", "char", "o") else 0)).astype(np.float32)
        if epoch < epochs - 1:
            score = _window_scores(model, names, ids)
    return model


def _window_scores(model: Model, names: list[bytes], ids: np.ndarray, rows: int = 1024) -> np.ndarray:
    """Logits of all windows, so many at once."""
    parts = [model.project(np.zeros((1, WORD_DIM + 1 + CHAR_DIM), np.float32))]
    parts += [model.project(model.inputs(names[at : at + 20_000])) for at in range(0, len(names), 20_000)]
    projected = np.concatenate(parts, 1)
    return np.concatenate([model.logits(projected, ids[at : at + rows].T, ids[at : at + rows].T > 0) for at in range(0, len(ids), rows)])


def _best_cut(worst: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F1, in the widest gap if several have it. Scores of clean texts have the longer tail, so the cut lies a quarter of the gap below the toxic ones."""
    order = np.argsort(-worst, kind="stable")
    w = np.append(worst[order], worst.min() - 1)
    f1 = 2 * np.cumsum(toxic[order]) / (np.arange(1, len(order) + 1) + toxic.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = best[np.argmax(w[best] - w[best + 1])]
    return float(w[k] - (w[k] - w[k + 1]) / 4)


class Scorer:
    """Scores texts in a worker; words' gate inputs are kept."""

    def __init__(self, model: Model) -> None:
        self.model, self.index, self.fresh = model, {}, []
        self.reset()

    def reset(self) -> None:
        scorer = self

        class Index(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = k = len(self) + 1
                scorer.fresh.append(word)
                return k

        self.index, self.fresh = Index(), []
        self.table = self.model.project(np.zeros((1, WORD_DIM + 1 + CHAR_DIM), np.float32))

    def worst(self, words: list[bytes]) -> float:
        """The largest logit of a text's windows."""
        p = min(max(self.scores([b" ".join(words).decode("utf-8", "surrogatepass")])[0], 1e-12), 1 - 1e-12)
        return float(np.log(p / (1 - p)))

    def scores(self, texts: list[str | None]) -> list[float]:
        if len(self.index) > KEPT:
            self.reset()
        counts, flat = [], []
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            flat.append(np.fromiter(map(self.index.__getitem__, words), np.int32, len(words)))
        if self.fresh:
            for at in range(0, len(self.fresh), 50_000):
                self.table = np.concatenate([self.table, self.model.project(self.model.inputs(self.fresh[at : at + 50_000]))], 1)
            self.fresh = []
        ids = np.concatenate([*flat, np.zeros(WINDOW, np.int32)])
        base = np.concatenate([[0], np.cumsum(counts)])
        starts = [window_starts(n) for n in counts]
        first = np.concatenate([[0], np.cumsum([len(s) for s in starts])[:-1]]).astype(np.int64)
        at = np.concatenate([s + b for s, b in zip(starts, base, strict=False)]).astype(np.int64)
        length = np.repeat(np.minimum(counts, WINDOW), [len(s) for s in starts])
        out = np.empty(len(at), np.float32)
        for k in range(0, len(at), BATCH):
            where = at[None, k : k + BATCH] + np.arange(WINDOW)[:, None]
            mask = np.arange(WINDOW)[:, None] < length[None, k : k + BATCH]
            out[k : k + BATCH] = self.model.logits(self.table, np.where(mask, ids[where], 0), mask)
        worst = np.maximum.reduceat(out, first).astype(np.float64)
        return (1 / (1 + np.exp(-np.clip(worst, -30, 30)))).tolist()


def held_out_fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 3


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", skip_fold: int | None = 1) -> Sample:
    """The words of a bounded sample of labelled documents: those with the smallest hashed ids of each kind."""
    ship(docs.sparkSession)
    able = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    if skip_fold is not None:
        able = able.where(F.crc32(F.col("id").cast("string").cast("binary")) % 3 != skip_fold)
    chosen = {}
    for kind, most in ((1, MAX_TOXIC), (0, MAX_OTHER)):
        chosen |= {r.id: r.y for r in able.where(F.col("y") == kind).orderBy(F.xxhash64("id"), "id").limit(most).collect()}
    if not chosen:
        return Sample.of([])
    ids = F.broadcast(docs.sparkSession.createDataFrame(sorted(chosen.items()), "id long, y int"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_forget()
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([b" ".join(words_of(t)) for t in b.column(1).to_pylist()], pa.binary())], ["id", "words"])

    lean = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(ids, F.col("doc_id") == F.col("id")).select("id", "text")
    by_doc: dict[int, list[bytes]] = {}
    same: dict[bytes, bytes] = {}  # one object for each distinct word
    for i, words in sorted((r.id, bytes(r.words)) for r in lean.mapInArrow(cut, "id long, words binary").collect()):
        by_doc.setdefault(i, []).extend(same.setdefault(w, w) for w in words.split())
    return Sample.of([(i, chosen[i], xs) for i, xs in by_doc.items()])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    return train(training_sample(docs, labels, label))


def scored(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the score of each text."""
    ship(docs.sparkSession)
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    held = docs.sparkSession.sparkContext.broadcast(model)
    key = f"toxicity:{uuid.uuid4().hex}"

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        scorer, out = worker_kept(key, lambda: Scorer(held.value)), []
        for at in range(0, len(texts), 256):
            out += scorer.scores(texts.iloc[at : at + 256].tolist())
        return pd.Series(out)

    return docs.withColumn(column, score(F.col(text).cast("string")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    out = scored(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    out = out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    return scratch.finish(out)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs whose score is below the threshold."""
    # the columns in a struct, so that no name of theirs can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    return scored(whole, fit(docs, labels), "doc.text").where(F.col("score") < THRESHOLD).select("doc.*")
