"""Pixel kernels in numpy, run in Arrow batches: grey, ink, gutters, widening, padding."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.tables import ship


@dataclass(frozen=True)
class GutterOptions:
    extra: int = 5
    ink_below: int = 100
    least_depth: float = 0.6
    least_valley: int = 2
    least_column: int = 18
    smooth: int = 4
    jitter: int = 2


def gray(picture: np.ndarray) -> np.ndarray:
    """Luminance; channels are taken in the order blue, green, red, as the source does."""
    if picture.ndim == 2:
        return picture
    if picture.shape[2] == 1:
        return picture[..., 0]
    if picture.shape[2] not in (3, 4):
        raise ValueError("1, 3 or 4 channels are needed")
    return np.rint(picture[..., :3] @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def ink(picture: np.ndarray, below: int) -> np.ndarray:
    return np.where(gray(picture) <= below, 255, 0).astype(np.uint8)


def smooth(profile: np.ndarray, size: int) -> np.ndarray:
    """Box filter, zero-padded; an even window reaches one further back than forward."""
    padded = np.concatenate([np.zeros(size // 2), profile.astype(float), np.zeros(size - size // 2 - 1)])
    return np.convolve(padded, np.full(size, 1 / size), "valid")


def _bases(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest earlier place with a larger value (-1: none), and the last smallest place from there on, up to the place itself.

    A stack of falling values: each place is put on and taken off once, and what is taken off hands on its smallest place.
    """
    x = x.tolist()  # numbers of a list are read several times as fast
    before, base, stack = [-1] * len(x), list(range(len(x))), []
    for k, v in enumerate(x):
        least = k
        while stack and x[stack[-1]] <= v:
            j = base[stack.pop()]
            if x[j] < x[least]:
                least = j
        before[k], base[k] = (stack[-1] if stack else -1), least
        stack.append(k)
    return np.array(before, np.int64), np.array(base, np.int64)


def peaks(x: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """(place, left base, right base, prominence, width at half prominence) of every peak. A flat peak's place is its middle; one at an end is none."""
    out: list[tuple[int, int, int, float, float]] = []
    if len(x) < 3:
        return out
    edges = np.flatnonzero(np.diff(x)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges - 1, [len(x) - 1]])
    _, left = _bases(x)
    right = len(x) - 1 - _bases(x[::-1])[1][::-1]
    x = x.tolist()
    for a, z in zip(starts[1:-1].tolist(), ends[1:-1].tolist(), strict=True):
        if not (x[a - 1] < x[a] > x[z + 1]):
            continue
        mid = (a + z) // 2
        lo, hi = int(left[mid]), int(right[mid])
        prominence = float(x[mid] - max(x[lo], x[hi]))
        half = float(x[mid]) - prominence / 2
        i = mid
        while x[i] > half:
            i -= 1
        j = mid
        while x[j] > half:
            j += 1
        first = i + (half - x[i]) / (x[i + 1] - x[i]) if x[i] < half else float(i)
        last = j - (half - x[j]) / (x[j - 1] - x[j]) if x[j] < half else float(j)
        out.append((mid, lo, hi, prominence, float(last - first)))
    return out


def valleys(profile: np.ndarray, least_width: float) -> list[tuple[int, int, int]]:
    """(place, left base, right base) of peaks of max - profile whose width at half prominence is enough."""
    return [(mid, lo, hi) for mid, lo, hi, _, width in peaks(profile.max() - profile) if width >= least_width]


def depth(profile: np.ndarray, mid: int, left: int, right: int) -> float:
    """How far the profile falls from the lower of both bases, as a share of it, from 0 to 1."""
    dip = lambda ref: 0.0 if ref <= 0 else min(max((ref - profile[mid]) / ref, 0.0), 1.0)
    return float(min(dip(profile[left]), dip(profile[right])))


def spans_between(cuts: list[int], width: int, least: int) -> list[tuple[int, int]]:
    """Columns of at least that width between cuts."""
    return [(a, z) for a, z in zip([0, *cuts], [*cuts, width], strict=True) if z - a >= least]


def column_spans(picture: np.ndarray, o: GutterOptions = GutterOptions()) -> list[tuple[int, int]]:
    """Text columns between deep valleys of the ink profile."""
    h, w = picture.shape[:2]
    if h / w < 0.1:
        return []
    if w < o.smooth:
        return [(0, w)] if w >= o.least_column else []
    profile = smooth(ink(picture, o.ink_below).sum(0, dtype=np.int64), o.smooth)
    cuts = [m for m, a, z in valleys(profile, o.least_valley) if depth(profile, m, a, z) >= o.least_depth]
    return spans_between(cuts, w, o.least_column)


def _edge(picture: np.ndarray, mask: np.ndarray, centre: int) -> np.ndarray:
    part = slice(max(0, centre - 3), min(picture.shape[1], centre + 3))
    pixels, back = picture[:, part].reshape(-1, *picture.shape[2:]), mask[:, part].ravel() == 0
    return (pixels[back] if back.any() else pixels).astype(float).mean(0)


def widen(picture: np.ndarray, o: GutterOptions = GutterOptions(), seed: int = 0) -> np.ndarray:
    """Puts ``extra`` columns before each text column but the first: a cosine blend of the colours beside it, with seeded noise."""
    spans = column_spans(picture, o)
    if len(spans) < 2:
        return picture
    mask, rng, parts, at = ink(picture, o.ink_below), np.random.default_rng(seed), [], 0
    for (_, end), (start, _) in zip(spans, spans[1:], strict=False):
        parts.append(picture[:, at:start])
        a, z = _edge(picture, mask, max(0, end - 3)), _edge(picture, mask, min(picture.shape[1] - 1, start + 3))
        t = (1 - np.cos(np.linspace(0, np.pi, o.extra))) / 2
        ramp = a + t.reshape(-1, *[1] * a.ndim) * (z - a)
        fill = np.broadcast_to(ramp, (picture.shape[0], *ramp.shape)) + rng.integers(1 - o.jitter, o.jitter + 2, (picture.shape[0], *ramp.shape))
        parts.append(np.clip(fill, 0, 255).astype(np.uint8))
        at = start
    return np.concatenate([*parts, picture[:, at:]], 1)


def pad_white(picture: np.ndarray) -> np.ndarray:
    """Centred on a white square; grey becomes RGB, alpha is blended on white."""
    if picture.ndim == 2:
        picture = picture[..., None]
    if picture.shape[2] == 4:
        alpha = picture[..., 3:].astype(float) / 255
        picture = (picture[..., :3] * alpha + 255 * (1 - alpha)).astype(np.uint8)
    h, w = picture.shape[:2]
    side = int(1.5 * max(h, w))
    out = np.full((side, side, 3), 255, np.uint8)
    room = out[(side - h) // 2 : (side - h) // 2 + h, (side - w) // 2 : (side - w) // 2 + w]
    for k in range(3):  # a channel at once, as numpy repeats three values slowly
        room[..., k] = picture[..., k % picture.shape[2]]
    return out


def seed_of(*key) -> int:
    """The same for the same key, wherever it is computed."""
    return zlib.crc32("\x1f".join(map(str, key)).encode())


def solid_sheet(height: int, width: int, like: np.ndarray, colour) -> np.ndarray:
    """A sheet of one colour in the channels and type of ``like``: a number or a colour's first value for grey; missing channels are 0, and a fourth one is 255."""
    values = np.atleast_1d(np.asarray(colour)).astype(int)
    if like.ndim == 2 or like.shape[2] == 1:
        return np.full((height, width, *like.shape[2:]), values[0], like.dtype)
    out = np.zeros((height, width, like.shape[2]), like.dtype)
    n = min(like.shape[2], len(values))
    out[..., :n] = values[:n]
    if like.shape[2] == 4:
        out[..., 3] = 255
    return out


def background_stats(picture: np.ndarray, spans: list[tuple[int, int]], below: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation, by channel, of pixels without ink outside the given columns; of all without ink if there are none."""
    clear = ink(picture, below) == 0
    outside = np.ones(picture.shape[1], bool)
    for a, z in spans:
        outside[a:z] = False
    some = clear & outside
    pixels = picture[some if some.any() else clear].reshape(-1, 1 if picture.ndim == 2 else picture.shape[2]).astype(float)
    return pixels.mean(0), pixels.std(0)


def paint_boxes(picture: np.ndarray, boxes: list[tuple[int, int, int, int]], colour=(255, 0, 0), thickness: int = 8) -> np.ndarray:
    """The picture as RGB with outlines of boxes, which are clamped to it; lines go inwards."""
    out = np.repeat(picture.reshape(*picture.shape[:2], 1), 3, 2) if picture.ndim == 2 or picture.shape[2] == 1 else picture[..., :3].copy()
    h, w = out.shape[:2]
    for x1, y1, x2, y2 in boxes:
        x1, x2 = sorted((min(max(x1, 0), w), min(max(x2, 0), w)))
        y1, y2 = sorted((min(max(y1, 0), h), min(max(y2, 0), h)))
        t = thickness
        for part in (np.s_[y1 : min(y1 + t, y2), x1:x2], np.s_[max(y2 - t, y1) : y2, x1:x2], np.s_[y1:y2, x1 : min(x1 + t, x2)], np.s_[y1:y2, max(x2 - t, x1) : x2]):
            out[part] = colour
    return out


# Room around a caption, where its text begins, and the sizes that a font has for pages of REFERENCE_EDGE pixels.
BADGE_PAD, BADGE_INSET, FONT_RANGE, FONT_BASE, REFERENCE_EDGE = 8, (4, 2), (12, 40), 16, 1920
#: Characters of captions, three columns by five rows, a row after the other from the top. Others are drawn as a box.
GLYPHS = dict(
    pair.split("=", 1) for pair in """
0=111101101101111 1=010110010010111 2=111001111100111 3=111001111001111 4=101101111001001 5=111100111001111 6=111100111101111 7=111001001001001 8=111101111101111 9=111101111001111
a=010101111101101 b=110101110101110 c=011100100100011 d=110101101101110 e=111100110100111 f=111100110100100 g=011100101101011 h=101101111101101 i=111010010010111 j=001001001101010
k=101101110101101 l=100100100100111 m=101111111101101 n=110101101101101 o=010101101101010 p=110101110100100 q=010101101110011 r=110101110101101 s=011100010001110 t=111010010010010
u=101101101101111 v=101101101101010 w=101101111111101 x=101101010101101 y=101101010010010 z=111001010100111 _=000000000000111 -=000000111000000 .=000000000000010 :=000010000010000
""".split()
)
GLYPHS |= {" ": "0" * 15}


def font_scale(height: int, width: int) -> int:
    """Pixels of a caption's dot: a fifth of the font size for the longest edge."""
    return max(1, min(max(max(height, width) * FONT_BASE // REFERENCE_EDGE, FONT_RANGE[0]), FONT_RANGE[1]) // 5)


def caption_mask(text: str, scale: int) -> np.ndarray:
    """A caption as a mask: glyphs one dot apart, each dot ``scale`` pixels wide."""
    rows = [np.array(list(GLYPHS.get(ch, "1" * 15)), int).reshape(5, 3).astype(bool) for ch in text.lower()]
    parts = [np.pad(r, ((0, 0), (0, 1))) for r in rows]
    dots = np.concatenate(parts, 1)[:, :-1] if parts else np.zeros((5, 0), bool)
    return np.repeat(np.repeat(dots, scale, 0), scale, 1)


def paint_captions(picture: np.ndarray, boxes: list[tuple[int, int, int, int]], captions: list[str], edge=(255, 0, 0), ink_colour=(255, 255, 0)) -> np.ndarray:
    """An RGB picture with a badge above each box's left upper corner, as far as there is room: the caption on a ground of the edge's colour."""
    out = picture.copy()
    h, w = out.shape[:2]
    scale = font_scale(h, w)
    for (x1, y1, _, _), text in zip(boxes, captions, strict=True):
        x, y, mask = min(max(x1, 0), w), min(max(y1, 0), h), caption_mask(text, scale)
        top, right = max(0, y - mask.shape[0] - BADGE_PAD), min(w, x + mask.shape[1] + BADGE_PAD)
        out[top : y + 1, x : right + 1] = edge
        a, b = top + BADGE_INSET[1], x + BADGE_INSET[0]
        room = out[a : a + mask.shape[0], b : b + mask.shape[1]]
        room[mask[: room.shape[0], : room.shape[1]]] = ink_colour
    return out


#: Crops that are held at once; an Arrow batch may hold thousands, and padding makes each many times as large.
CROPS = 64


def prepare_crops(crops: DataFrame, options: GutterOptions = GutterOptions(), instead: dict[str, tuple[str, Callable[[np.ndarray], object]]] | None = None, draw: Callable[[tuple], np.ndarray] | None = None) -> DataFrame:
    """crops (key, label, h, w, c, data) with widened gutters (label region only) and padding, in one pass over the pixels.

    With ``instead`` (name: type and function of a picture), its columns stand in place of ``data``, so that what is wanted of
    the pixels is computed where they are made. With ``draw``, a function of a row (key, label, h, w), crops have no ``data``.
    """
    made = instead or {"data": ("binary", lambda p: p.tobytes())}
    names = ["key", "label", "h", "w", "c", *made]

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), CROPS):
                out = []
                for r in whole.iloc[at : at + CROPS].itertuples(index=False):
                    if draw is not None:
                        p = draw(r)
                    elif r.data is None:
                        continue
                    else:
                        p = np.frombuffer(r.data, np.uint8).reshape((r.h, r.w, r.c) if r.c > 1 else (r.h, r.w))
                    if r.label == "region":
                        p = widen(p, options, seed=seed_of(r.key))
                    if 0.1 <= p.shape[1] / p.shape[0] <= 10:
                        p = pad_white(p)
                    out.append((r.key, r.label, p.shape[0], p.shape[1], 1 if p.ndim == 2 else p.shape[2], *(f(p) for _, f in made.values())))
                yield pd.DataFrame(out, columns=names)

    ship(crops.sparkSession)
    types = dict(crops.dtypes)
    kind = ", ".join(f"{name} {of}" for name, (of, _) in made.items())
    return crops.select("key", "label", "h", "w", *([] if draw else ["c", "data"])).mapInPandas(run, f"key {types['key']}, label string, h int, w int, c int, {kind}")


def column_profile(pixels: DataFrame, crop: str, below: int) -> DataFrame:
    """crop, x, profile: ink per column of pixels (crop, x, y, value)."""
    return pixels.groupBy(crop, "x").agg(F.sum(F.when(F.col("value") <= below, 255).otherwise(0)).alias("profile"))


def smooth_profile(profile: DataFrame, crop: str, size: int = 4) -> DataFrame:
    w = Window.partitionBy(crop).orderBy("x").rowsBetween(-(size // 2), size - size // 2 - 1)
    return profile.withColumn("smooth", F.sum("profile").over(w) / F.lit(float(size)))


def profile_arrays(profile: DataFrame, crop: str, width: int) -> DataFrame:
    """crop, profile: the ink of each of ``width`` columns as an array; a column without a row has none."""
    held = profile.where(F.col("x").between(0, width - 1)).groupBy(crop).agg(F.map_from_entries(F.collect_list(F.struct("x", F.col("profile").cast("double")))).alias("_m"))
    return held.select(crop, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda x: F.coalesce(F.element_at("_m", x), F.lit(0.0))).alias("profile"))


VALLEY = "array<struct<place: int, left_base: int, right_base: int, prominence: double, width: double, depth: double>>"


def column_valleys(profiles: DataFrame, crop: str, o: GutterOptions = GutterOptions()) -> DataFrame:
    """crop, place, left_base, right_base, prominence, width, depth, is_cut: the valleys of each smoothed profile (an array) that are wide enough, and whether they are deep enough for a cut."""
    ship(profiles.sparkSession)

    @F.pandas_udf(VALLEY)
    def find(arrays: pd.Series) -> pd.Series:
        def one(a):
            p = smooth(np.asarray(a, float), o.smooth) if len(a) >= o.smooth else np.zeros(0)
            found = peaks(p.max() - p) if len(p) else []
            return [{"place": m, "left_base": lo, "right_base": hi, "prominence": t, "width": w, "depth": depth(p, m, lo, hi)} for m, lo, hi, t, w in found if w >= o.least_valley]

        return arrays.map(one)

    rows = profiles.where(F.col("profile").isNotNull()).select(crop, F.explode(find("profile")).alias("v")).select(crop, "v.*")
    return rows.withColumn("is_cut", F.col("depth") >= o.least_depth)


def cut_spans(valleys_: DataFrame, profiles: DataFrame, crop: str, o: GutterOptions = GutterOptions()) -> DataFrame:
    """crop, start, stop: the text columns between cuts of each profile."""
    cuts = valleys_.where("is_cut").groupBy(F.col(crop).alias("_crop")).agg(F.sort_array(F.collect_list("place")).alias("_cuts"))
    rows = profiles.select(crop, F.size("profile").alias("_w")).join(cuts, F.col(crop).eqNullSafe(F.col("_crop")), "left")
    inner = F.coalesce("_cuts", F.array().cast("array<int>"))
    spans = F.zip_with(F.concat(F.array(F.lit(0)), inner), F.concat(inner, F.array("_w")), lambda a, z: F.struct(a.alias("start"), z.alias("stop")))
    return rows.select(crop, F.explode(F.filter(spans, lambda s: s["stop"] - s["start"] >= o.least_column)).alias("s")).select(crop, "s.*")


def colour_stats(pixels: DataFrame, crop: str, below: int = 100) -> DataFrame:
    """crop, mean, deviation: of the values of pixels (crop, value) without ink, as of a whole population."""
    clear = F.when(F.col("value") > below, F.col("value").cast("double"))
    return pixels.groupBy(crop).agg(F.avg(clear).alias("mean"), F.stddev_pop(clear).alias("deviation"))


def peak_gaps(profile: np.ndarray, least_height: float, least_gap: int, inset: int) -> list[tuple[int, int]]:
    """Gaps wider than ``least_gap`` between peaks of a profile, inset on both sides."""
    peaks = [k for k in range(1, len(profile) - 1) if profile[k] >= least_height and profile[k - 1] < profile[k] >= profile[k + 1]]
    return [(a + inset, z - inset) for a, z in zip(peaks, peaks[1:], strict=False) if z - a > least_gap]
