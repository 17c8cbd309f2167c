"""Continuity of text pairs by a plugged-in model, wired to neighbour pairs in Arrow batches."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.operators import chain as C
from quireflow.operators.backends import loaded
from quireflow.plans.registry import BACKENDS, ModelError, PipelineError
from quireflow.tables import ship

_LOG = logging.getLogger(__name__)
#: Characters of a pair that the model sees: the end of the first text, the beginning of the second.
SEEN = 100


class Scorer(Protocol):
    """Tells how likely each second text goes on the first, from 0 to 1. ``initialize`` is called once before the first pairs."""

    @property
    def available(self) -> bool: ...

    def initialize(self) -> None: ...

    def compute_scores(self, pairs: Sequence[tuple[str, str]]) -> Sequence[float]: ...


class PlainScorer:
    """A scorer of a function of two texts."""

    def __init__(self, score: Callable[[str, str], float]) -> None:
        self._score, self.available = score, True

    def initialize(self) -> None: ...

    def compute_scores(self, pairs: Sequence[tuple[str, str]]) -> list[float]:
        return [self._score(a, b) for a, b in pairs]


class DeferredScorer:
    """A scorer that is made when it is first initialised; before that it scores nothing."""

    def __init__(self, load: Callable[[], Scorer]) -> None:
        self._load, self._held = load, None

    @property
    def available(self) -> bool:
        return self._held is not None and self._held.available

    def initialize(self) -> None:
        if self._held is None:
            self._held = self._load()
        self._held.initialize()

    def compute_scores(self, pairs: Sequence[tuple[str, str]]) -> Sequence[float]:
        if not self.available:
            raise ModelError("the scorer is not initialised")
        return self._held.compute_scores(pairs)


def scorer_of(kind: str) -> Callable[[], Scorer]:
    """The loader of a registered kind of scorer; an unknown kind raises."""
    try:
        return BACKENDS.get(f"scorer:{kind}")
    except PipelineError as e:
        raise ModelError("unknown kind of scorer", kind=kind) from e


def device_of(name: str | None = None) -> str:
    """The device that a model is told to use: the given one, else an accelerator if the tensor library finds one, else the processor."""
    if name:
        return name
    try:
        import torch

        return "cuda" if torch.cuda.is_available() else "cpu"
    except ImportError:
        return "cpu"


def score_pairs(pairs: DataFrame, load: Callable[[], Scorer], name: str, o: C.ChainOptions = C.ChainOptions()) -> DataFrame:
    """Neighbour pairs with near, goes_on, mixed and failed.

    Texts go to the model a batch at a time; if a batch fails, each pair is tried by itself, and a pair that fails has
    goes_on and mixed of -1 and near of 0, so it is never linked. ``failed`` is set where the model can't be loaded at all.
    """

    ship(pairs.sparkSession)
    plan = uuid.uuid4().hex

    @F.pandas_udf("struct<goes_on: double, failed: boolean>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = None
        try:
            model = loaded(f"scorer:{name}", load, plan)
            model.initialize()
        except Exception:
            _LOG.warning("the scorer can't be loaded", exc_info=True)
            model = None
        for a, b in batches:
            texts = [(x[-SEEN:], y[:SEEN]) for x, y in zip(a, b, strict=True)]
            if model is None:
                yield pd.DataFrame({"goes_on": [-1.0] * len(texts), "failed": [True] * len(texts)})
                continue
            try:
                got = list(map(float, model.compute_scores(texts)))
                if len(got) != len(texts):
                    raise ModelError("a score for each pair is needed", pairs=len(texts), scores=len(got))
            except Exception:
                got = []
                for pair in texts:
                    try:
                        got.append(float(model.compute_scores([pair])[0]))
                    except Exception:
                        _LOG.debug("a pair can't be scored", exc_info=True)
                        got.append(-1.0)
                _LOG.warning("%d of %d pairs can't be scored", got.count(-1.0), len(got))
            yield pd.DataFrame({"goes_on": got, "failed": [False] * len(texts)})

    out = pairs.withColumn("_judged", judge(F.col("a_text"), F.col("b_text")))
    lost = F.col("_judged.goes_on") < 0
    out = out.withColumns({"goes_on": F.col("_judged.goes_on"), "failed": F.col("_judged.failed"), "near": F.when(lost, F.lit(0.0)).otherwise(C.spatial_weight(o))})
    return out.withColumn("mixed", F.when(F.col("goes_on") < 0, F.lit(-1.0)).otherwise(C.mixed_strength(F.col("near"), F.col("goes_on")))).drop("_judged")


def reorder_markdown(docs: DataFrame, doc: str, text: str, load: Callable[[], Scorer], name: str, tables, o: C.ChainOptions = C.ChainOptions()) -> DataFrame:
    """doc, final: each document's fragments in reading order, composed without markers.

    An empty text stays empty; a text without fragments stays as it is, markers included; where scoring fails as a whole,
    marker lines go and the order stays.
    """
    from quireflow.functions import textclean as T
    from quireflow.operators.fragments import parse_lines

    blocks = tables.cut(parse_lines(docs.where(F.col(text) != ""), doc, text), "blocks")
    pairs = C.neighbour_pairs(blocks, doc, "block_id", o, SEEN)
    scored = tables.cut(score_pairs(pairs, load, name, o).select(doc, "src", "dst", "goes_on", "mixed", "failed"), "pairs")
    links = tables.cut(C.greedy_links(scored, blocks, doc, "block_id", o), "links")
    walked = C.walk_order(blocks, links, doc, "block_id", text="text")
    composed = C.compose(walked, links, doc, "block_id")
    failed = scored.where("failed").select(F.col(doc).alias("_failed")).distinct()
    out = docs.join(composed.select(F.col(doc).alias("_done"), F.col("markdown").alias("_composed")), F.col(doc).eqNullSafe(F.col("_done")), "left")
    out = out.join(failed, F.col(doc).eqNullSafe(F.col("_failed")), "left")
    final = F.when(F.coalesce(F.col(text), F.lit("")) == "", F.lit("")).when(F.col("_failed").isNotNull(), T.strip_bbox_lines(F.col(text))).otherwise(F.coalesce("_composed", F.col(text)))
    return out.select(doc, final.alias("final"))
