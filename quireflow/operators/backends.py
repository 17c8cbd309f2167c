"""Plug-in points for models: loaded once in each Python worker, called on batches, with a second model for what the first leaves out."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from quireflow.plans.registry import ModelError
from quireflow.tables import ship

# Ids that open a pair and end its parts, and the most ids a pair may have.
OPENS, ENDS, MOST_IDS = 101, 102, 256
_LOADED: dict[str, tuple[str, object]] = {}
_LOG = logging.getLogger(__name__)

Recognise = Callable[[Sequence], Sequence]


def loaded(name: str, load: Callable[[], object], plan: str = "") -> object:
    """This process's model of that name, loaded and warmed up at its first use, and anew for another ``plan``, which may mean another model by that name."""
    held = _LOADED.get(name)
    if held is None or held[0] != plan:
        try:
            _LOADED[name] = (plan, load())
            warm_up(_LOADED[name][1])
        except Exception as e:
            _LOADED.pop(name, None)
            raise ModelError("model can't be loaded", name=name) from e
    return _LOADED[name][1]


def warm_up(model: object) -> None:
    """Calls a model's ``warm_up``, if it has one, so that the first batch doesn't pay for what is built late."""
    call = getattr(model, "warm_up", None)
    if callable(call):
        call()


def pair_ids(a: list[int], b: list[int], most: int = MOST_IDS) -> list[int]:
    """Ids of a pair of texts for a continuity model. A pair that is too long keeps the end of a and the beginning of b, half the room each."""
    if len(a) + len(b) + 3 > most:
        half = (most - 3) // 2
        a, b = a[max(0, len(a) - half) :], b[:half]
    return [OPENS, *a, ENDS, *b, ENDS]


def _timed(call: Callable, seconds: float | None):
    """The call's result; after ``seconds`` a TimeoutError, while the call itself goes on in its thread."""
    if seconds is None:
        return call()
    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(call).result(timeout=seconds)
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def recognise(items: Sequence, first: Recognise, second: Recognise | None = None, *, threads: int = 1, timeout: float | None = None) -> list[tuple[object, int]]:
    """(result, attempt) of each item. Items for which the first model gives no entry go to the second, ``threads`` at a time; a null entry stands.

    An error of the first model, one that takes longer than ``timeout`` seconds, and too few entries, are such cases; an
    error of the second, or one that takes too long, leaves null.
    """
    try:
        got = list(_timed(lambda: first(items), timeout) or [])[: len(items)]
    except Exception:
        _LOG.warning("the first model failed on %d items", len(items), exc_info=True)
        got = []
    out: list[tuple[object, int]] = [(text, 1) for text in got]

    def one(item):
        if second is None:
            return None
        try:
            return next(iter(_timed(lambda: second([item]), timeout) or []), None)
        except Exception:
            _LOG.warning("the second model failed", exc_info=True)
            return None

    left = items[len(got) :]
    if threads > 1 and len(left) > 1:
        with ThreadPoolExecutor(threads) as pool:
            found = list(pool.map(one, left))
    else:
        found = [one(x) for x in left]
    return out + [(text, 2) for text in found]


def recognise_crops(crops: DataFrame, key: str, pixels: str, first: Callable[[], Recognise], second: Callable[[], Recognise] | None = None, *, threads: int = 1, timeout: float | None = None) -> DataFrame:
    """key, text, attempt of the crops that have pixels. ``first`` and ``second`` load a model; a batch is Spark's Arrow batch."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        models = first(), second() if second is not None else None
        for b in batches:
            got = recognise([bytes(x) for x in b[pixels]], *models, threads=threads, timeout=timeout)
            yield pd.DataFrame({key: b[key], "text": pd.Series([t for t, _ in got], dtype=object, index=b.index), "attempt": pd.Series([k for _, k in got], dtype="int32", index=b.index)})

    ship(crops.sparkSession)
    kept = crops.where(f"`{pixels}` IS NOT NULL").select(key, pixels)
    return kept.mapInPandas(run, f"`{key}` {kept.schema[key].dataType.simpleString()}, text string, attempt int")


BLOCKS = "array<struct<label: string, x1: int, y1: int, x2: int, y2: int, content: string>>"


def as_blocks(result: object) -> list[dict] | None:
    """A recognised crop as blocks: a plain text is one block without label; null stays null."""
    if result is None:
        return None
    if isinstance(result, str):
        return [{"label": None, "x1": 0, "y1": 0, "x2": 0, "y2": 0, "content": result}]
    return [{"label": b.get("label"), **dict(zip(("x1", "y1", "x2", "y2"), map(int, b.get("bbox") or (0, 0, 0, 0)), strict=True)), "content": b.get("content") or ""} for b in result]


def recognise_pictures(crops: DataFrame, first: Callable[[], Recognise], second: Callable[[], Recognise] | None = None, *, threads: int = 1, timeout: float | None = None, names: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """crops that have pixels, without them, with ``blocks`` (null where no model gives a result) and ``attempt``. Models get pictures as arrays and give texts, or lists of blocks (label, bbox, content). With ``names`` a worker loads each once."""
    from quireflow.operators.detect import picture_of

    ship(crops.sparkSession)
    plan = uuid.uuid4().hex
    rest = [f for f in crops.schema if f.name not in ("h", "w", "c", "data")]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        models = [None if load is None else loaded(f"recogniser:{name}", load, plan) if name else load() for name, load in zip(names, (first, second), strict=True)]
        for b in batches:
            got = recognise([picture_of(r) for r in b.itertuples(index=False)], *models, threads=threads, timeout=timeout)
            yield b[[f.name for f in rest]].assign(blocks=pd.Series([as_blocks(x) for x, _ in got], dtype=object, index=b.index), attempt=pd.Series([k for _, k in got], dtype="int32", index=b.index))

    return crops.where("data IS NOT NULL").mapInPandas(run, f"{kind}, blocks {BLOCKS}, attempt int")
