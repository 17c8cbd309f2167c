"""The page pipeline against a plain program over one document after the other, and its parts by themselves."""

import json
import logging
import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow import cli
from quireflow.functions import textclean as T
from quireflow.operators import backends as B
from quireflow.operators import chain as C
from quireflow.operators import continuity as S
from quireflow.operators import detect as E
from quireflow.operators import direction as D
from quireflow.operators import raster as R
from quireflow.operators import xycut as X
from quireflow.plans import catalogue, fakes
from quireflow.plans.registry import BACKENDS, STAGES, Context, ModelError, Pipeline, PipelineError, Stage, setup_logging
from quireflow.plans.stages import ORDER as DEFAULT_ORDER
from quireflow.plans.stages import page_pipeline
from quireflow.tables import Tables
from tests.test_overlaps import plain_peaks

DATA = "/root/testdata/sf0.001"
ORDER = "coarse_detector sorter cropper crop_filter fine_detector column_expander preprocessor ocr postprocessor reorder aggregator".split()


# --- a plain program -----------------------------------------------------------------------------------------------------


def unit(t):
    n = len(t)
    return next((t[:p] for p in range(1, n // 3 + 1) if n % p == 0 and t[:p] * (n // p) == t), t)


def cleaned(t):
    t = re.sub(r"(?m)^[-=*_○×☐]{3,}\s*$", "", re.sub(r"(\([^)]+\)\s*){5,}", "", t))
    t = unit(t) if unit(t) != t else "\n".join(unit(x) for x in t.split("\n"))
    t = re.sub(r"\n{3,}", "\n\n", t).strip()
    out, last = "", ""
    for x in filter(None, map(str.strip, t.split("\n"))):
        block = [y.startswith(("#", "<div", "<table", "<img", "<tr")) for y in (x, last)]
        glued = last and last[-1] not in "。！？)>|\";.；" and x[0] not in "【(▲" and not any(block)
        out += x if not out or glued else "\n\n" + x
        last = x
    return out


def titled(t):
    first, *rest = t.strip().split("\n")
    head = first if first.startswith("##") else "#" + first if first.startswith("# ") else "## " + first
    rest = [x.strip() for x in rest if x.strip()]
    return " ".join([head, *rest])


def is_open(t):
    t = t.rstrip()
    return bool(t) and t[-1] not in "。！？.)）】【」…\"'"


def runs(spans):
    """Maximal runs of occupied positions, from a list of positions that are marked one by one; all but the last end one early."""
    spans = [(a, z) for a, z in spans if z > a]
    if not spans:
        return []
    low = min(a for a, _ in spans)
    marked = [False] * (max(z for _, z in spans) - low)
    for a, z in spans:
        for k in range(a - low, z - low):
            marked[k] = True
    out, at = [], 0
    while at < len(marked):
        end = at
        while end < len(marked) and marked[end]:
            end += 1
        if end > at:
            out.append([at + low, end + low])
        at = end + 1
    for r in out[:-1]:
        r[1] -= 1
    return out


def plain_order(boxes, scale):
    """Places of boxes by recursive cuts: columns from the right, rows from the top; what falls out of all runs comes last."""
    side = max((max(abs(b[0]), abs(b[2])) for b in boxes), default=0)
    items = [(k, side - x2, y1, int(side - x1 - (x2 - x1) * scale[0]), int(y2 - (y2 - y1) * scale[1])) for k, (x1, y1, x2, y2) in enumerate(boxes)]
    done = []

    def cut(now):
        for a, z in runs([(i[1], i[3]) for i in now]):
            column = [i for i in now if a <= i[1] < z]
            rows = [[i for i in column if p <= i[2] < q] for p, q in runs([(i[2], i[4]) for i in column])]
            if len(rows) == 1:
                done.extend(i[0] for i in sorted(rows[0], key=lambda i: (i[2], i[1], i[0])))
            else:
                for r in rows:
                    cut(r)

    cut(items)
    return done + [k for k in range(len(boxes)) if k not in done]


def plain_subs(result):
    """The second detection's boxes with four corners, in reading order, and their labels."""
    held = [b for b in result["res"]["boxes"] if len(b["coordinate"]) >= 4]
    return [(*map(int, held[k]["coordinate"][:4]), held[k].get("label") or held[k].get("block_label") or "region") for k in plain_order([list(map(int, b["coordinate"][:4])) for b in held], (0.2, 0.0667))]


def plain_cuts(picture):
    """Text columns of a grey picture, by scanning its smoothed ink profile."""
    h, w = picture.shape
    if h / w < 0.1:
        return []
    if w < 4:
        return [(0, w)] if w >= 18 else []
    ink = [sum(255 for y in range(h) if picture[y, x] <= 100) for x in range(w)]
    profile = [sum(ink[k] for k in range(x - 2, x + 2) if 0 <= k < w) / 4 for x in range(w)]
    dip = lambda m, b: 0.0 if profile[b] <= 0 else min(max((profile[b] - profile[m]) / profile[b], 0.0), 1.0)
    cuts = [m for m, a, z, _, width in plain_peaks([max(profile) - v for v in profile]) if width >= 2 and min(dip(m, a), dip(m, z)) >= 0.6]
    return [(a, z) for a, z in zip([0, *cuts], [*cuts, w], strict=True) if z - a >= 18]


def plain_widened(picture, seed):
    """Five columns of blended colours before each text column but the first, pixel by pixel."""
    spans = plain_cuts(picture)
    if len(spans) < 2:
        return picture
    rng, h, out, at = np.random.default_rng(seed), len(picture), [[] for _ in picture], 0

    def beside(centre):
        some = [(int(picture[y, x]), picture[y, x] > 100) for y in range(h) for x in range(max(0, centre - 3), min(picture.shape[1], centre + 3))]
        clear = [v for v, free in some if free] or [v for v, _ in some]
        return sum(clear) / len(clear)

    for (_, end), (start, _) in zip(spans, spans[1:], strict=False):
        a, z = beside(max(0, end - 3)), beside(min(picture.shape[1] - 1, start + 3))
        noise = rng.integers(-1, 4, (h, 5))
        for y in range(h):
            out[y] += picture[y, at:start].tolist() + [int(min(max(a + (1 - math.cos(math.pi * k / 4)) / 2 * (z - a) + noise[y, k], 0), 255)) for k in range(5)]
        at = start
    return np.array([row + picture[y, at:].tolist() for y, row in enumerate(out)], np.uint8)


def plain_padded(picture):
    """A grey picture in the middle of a white square, in three equal channels."""
    h, w = picture.shape
    side = 3 * max(h, w) // 2
    top, left = (side - h) // 2, (side - w) // 2
    return np.array([[[int(picture[y - top, x - left]) if 0 <= y - top < h and 0 <= x - left < w else 255] * 3 for x in range(side)] for y in range(side)], np.uint8)


def annotated(picture):
    """One page to its Markdown with markers, or None without any result."""
    w, h = fakes.WIDTH, fakes.HEIGHT
    boxes = [([int(v) for v in b["coordinate"]], b["label"]) for b in json.loads(fakes.detect([picture])[0])["res"]["boxes"]]
    boxes = [boxes[k] for k in plain_order([b for b, _ in boxes], (0.0667, 0.6667))]
    pieces, seen = [], 0
    for (x1, y1, x2, y2), label in boxes:
        cx1, cy1, cx2, cy2 = max(0, x1), max(0, y1), min(w, x2), min(h, y2)
        if cx2 <= cx1 or cy2 <= cy1 or label in ("header", "advert"):
            continue
        seen += 1
        crop = picture[cy1:cy2, cx1:cx2]
        try:
            subs = plain_subs(fakes.detect_fine([crop])[0])
        except ValueError:
            subs = []
        items = []
        for k, (a, b, c, d, kind) in enumerate(subs, 1):
            a, b, c, d = max(0, a), max(0, b), min(crop.shape[1], c), min(crop.shape[0], d)
            if c > a and d > b:
                items.append((f"crop_{seen}.{k}", kind, crop[b:d, a:c]))
        texts, buffer = [], []
        for name, kind, p in items or [(f"crop_{seen}", label, crop)]:
            if kind == "region":
                p = plain_widened(p, zlib.crc32(f"{key_of[picture.tobytes()]}\x1f{name}".encode()))
            if 0.1 <= p.shape[1] / p.shape[0] <= 10:
                p = plain_padded(p)
            said = fakes.recognise([p])[0]
            if said is None:
                continue
            text = said if isinstance(said, str) else "\n\n".join(b["content"] for b in said)
            if kind == "title":
                texts += [cleaned("\n".join(buffer)), cleaned(titled(text))]
                buffer = []
            else:
                buffer.append(text)
        texts = [t for t in [*texts, cleaned("\n".join(buffer))] if t]
        if texts:
            pieces += [*texts, "bbox:[%d,%d,%d,%d]" % tuple(max(0, v) for v in (x1, y1, x2, y2))]
    return "\n\n".join(pieces) or None


def reordered(markdown):
    frags, lines = [], []
    for line in markdown.split("\n"):
        if m := re.search(r"bbox:\[(\d+),\s*(\d+),\s*(\d+),\s*(\d+)\]", line):
            if body := "\n".join(x.rstrip() for x in lines).strip():
                frags.append((body, *map(int, m.groups())))
            lines = []
        else:
            lines.append(line)
    if body := "\n".join(lines).strip():
        frags.append((body, 0, 0, 1000, 100))

    def strength(a, b):
        h, v = abs(b[3] - a[1]), abs(b[2] - a[4])
        far, aside = (h, abs(a[2] - b[2])) if h <= v else (v, min(h, abs(b[1] - a[3])))
        near = math.exp(-(far + 0.1 * aside) / 500)
        try:
            c = fakes.goes_on(a[0][-100:], b[0][:100])
        except ValueError:
            return -1.0, -1.0
        mixed = c if near > 0.95 and c > 0.999 else 0.8 * near if 0.1 < c < 0.2 and near > 0.95 else near * c
        return mixed, c

    taken, seen, after = set(), set(), {}
    for seed in range(len(frags)):
        now = seed
        while now is not None and is_open(frags[now][0]) and now not in seen:
            seen.add(now)
            a = frags[now]
            near = [k for k, b in enumerate(frags) if k != now and k not in taken and not b[0].startswith("<div") and ((abs(b[3] - a[1]) <= 200 and abs(b[4] - a[4]) <= 100) or abs(b[2] - a[4]) <= 1000)]
            best = sorted(((*strength(a, frags[k]), k) for k in near), key=lambda g: (-g[0], g[2]))
            if not best or best[0][1] < 0 or best[0][0] < 0.6:
                break
            after[now] = best[0][2]
            now = after[now]
            taken.add(now)
    order, done = [], set()
    for k in range(len(frags)):
        while k is not None and k not in done:
            order.append(k)
            done.add(k)
            k = after.get(k)
    out = ""
    for place, k in enumerate(order):
        body = frags[k][0]
        if place:
            before = order[place - 1]
            alone = frags[before][0].startswith("##") and "\n" not in frags[before][0]
            out += "\n\n" if alone or body.startswith(("##", "<div")) or before not in after else ""
        out += body
    return out


key_of = {}


def test_pipeline_equals_a_plain_program(spark):
    pages = fakes.pages(spark, DATA).collect()
    want = {}
    for r in pages:
        picture = E.decode_netpbm(bytes(r.content))
        key_of[picture.tobytes()] = r.doc_id
        if markdown := annotated(picture):
            want[r.doc_id] = reordered(markdown)
    pipeline = page_pipeline(**fakes.CONFIG)
    got = {r.doc_id: r.markdown for r in pipeline.run(fakes.pages(spark, DATA)).collect()}
    assert got == want and len(got) > 50 and list(pipeline.results) == ORDER
    assert any("a second block" in t for t in got.values()) and any("goes onSize" in t for t in got.values())


# --- stages and their framework ------------------------------------------------------------------------------------------


def test_registered_stages_and_skipping(spark):
    assert DEFAULT_ORDER == ORDER and set(ORDER) <= set(STAGES.names())
    pages = fakes.pages(spark, DATA).where("doc_id % 7 = 0")
    some = page_pipeline(skip=["reorder", "fine_detector", "sorter", "column_expander"], **fakes.CONFIG).run(pages).collect()
    assert some and all("bbox:" not in r.markdown for r in some)
    boxes = page_pipeline(["coarse_detector", "sorter"], **fakes.CONFIG).run(pages)
    assert boxes.count() > 0 and "rank" in boxes.columns
    with pytest.raises(PipelineError):
        page_pipeline(["coarse_detector"], skip=["no such stage"])
    with pytest.raises(PipelineError, match="stage=reorder"):
        page_pipeline(["reorder"]).run(spark.range(1))
    assert page_pipeline(**fakes.CONFIG).run(pages.limit(0)).count() == 0


def test_stage_class_has_a_lifecycle(spark):
    seen = []

    class Doubling(Stage):
        def setup(self):
            seen.append("up")

        def apply(self, df):
            return df.withColumn("id", F.col("id") * self.context.get("times", 2))

        def teardown(self):
            seen.append("down")

    STAGES.register("doubling")(Doubling)
    assert [r.id for r in Pipeline(["doubling"], context=Context()).run(spark.range(2)).collect()] == [0, 2] and seen == ["up", "down"]
    STAGES._held.pop("doubling")


def test_logging_is_set_up_once(tmp_path):
    logger = logging.getLogger("quireflow")
    before = list(logger.handlers)
    logger.handlers.clear()
    try:
        assert setup_logging("debug", str(tmp_path / "log")) is setup_logging("INFO") and len(logger.handlers) == 2
        logger.info("hello")
        assert "hello" in (tmp_path / "log").read_text()
    finally:
        logger.handlers[:] = before


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for r in fakes.pages(spark, DATA).orderBy("doc_id").limit(3).collect():
        (tmp_path / "in" / f"p{r.doc_id}.png").write_bytes(bytes(r.content))
    (tmp_path / "c.yaml").write_text(json.dumps(fakes.CONFIG))
    assert cli.main(["-i", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "-c", str(tmp_path / "c.yaml"), "--plugins", "quireflow.plans.fakes", "-d"], spark) == 0
    files = sorted(p.name for p in (tmp_path / "out").rglob("*.md"))
    plain = [n for n in files if not n.endswith("_with_bbox.md")]
    plain = [n for n in plain if not n.startswith("crop_")]
    assert len(plain) == 3 and all((tmp_path / "out" / n[:-3] / n).exists() for n in plain)
    assert any("bbox:" in (tmp_path / "out" / n[:-3] / f"{n[:-3]}_with_bbox.md").read_text() for n in plain)
    crops = list((tmp_path / "out").glob("p*/debug/crop_*/crop_*.md"))
    assert crops and all(p.parent.name == p.stem and p.read_text().startswith("Size") for p in crops)
    for n, colour in (("coarse_detector", (255, 0, 0)), ("fine_detector", (0, 0, 255))):
        drawn = [E.decode_netpbm(p.read_bytes()) for p in (tmp_path / "out").glob(f"p*/debug/{n}.ppm")]
        assert drawn and all((p == colour).all(2).any() for p in drawn)
    pictures = [p for p in (tmp_path / "out").glob("p*/debug/crop_*/*.ppm")]
    assert {p.stem.removeprefix(p.parent.name) for p in pictures} == {"", "_processed"} and all(E.decode_netpbm(p.read_bytes()).size for p in pictures)
    assert cli.main(["-i", str(tmp_path / "none"), "-o", str(tmp_path / "out")], spark) == 1
    (tmp_path / "empty").mkdir()
    assert cli.main(["-i", str(tmp_path / "empty"), "-o", str(tmp_path / "out")], spark) == 1


def test_labels_by_position(spark):
    """Two sub crops of the first crop, a second crop that has none, a third with two; the second result is missing."""
    rows = [("d", 1, 1, "title", True), ("d", 1, 2, "text", False), ("d", 2, None, "region", True), ("d", 3, 1, "title", True), ("d", 3, 3, "table", True)]
    df = spark.createDataFrame(rows, "doc string, big int, sub int, label string, there boolean")
    from quireflow.operators.fragments import positional_labels

    got = {(r.big, r.sub): (r.format_label, r.group_label) for r in positional_labels(df, "doc", "big", "sub", "label", "there").collect()}
    labels, names, there = ["title", "text", "title", "table"], [r[1:3] for r in rows], [r[1:3] for r in rows if r[4]]
    want = {n: (labels[there.index(n)] if n in there and there.index(n) < 4 else None, labels[k] if k < 4 else None) for k, n in enumerate(names)}
    assert got == want


# --- detection -----------------------------------------------------------------------------------------------------------


def test_netpbm_and_resize():
    rng = np.random.default_rng(1)
    p = rng.integers(0, 256, (6, 9, 3), dtype=np.uint8)
    assert (E.decode_picture(b"P6 # a comment\n9 6\n255\n" + p.tobytes()) == p).all()
    assert (E.decode_netpbm(b"P5\n9 6 255\n" + p[..., 0].tobytes()) == p[..., 0]).all()
    with pytest.raises(ValueError):
        E.decode_netpbm(b"P4\n1 1\n")
    flat = np.full((40, 30), 77, np.uint8)
    assert E.resize(flat, (30, 40)) is flat and (E.resize(flat, (7, 90)) == 77).all() and E.resize(p, (18, 3)).shape == (3, 18, 3)
    ramp = np.tile(np.arange(0, 200, 2, dtype=np.uint8), (10, 1))
    assert np.abs(E.resize(ramp, (50, 10)).astype(float)[5, 5:-5] - np.arange(1, 200, 4)[5:-5]).max() <= 1


def test_detection_failures(spark):
    good = b"P5\n4 4\n255\n" + bytes(16)
    pages = spark.createDataFrame([(1, good), (2, b"broken"), (3, None)], "doc_id int, content binary")
    none = lambda: lambda ps: [None] * len(ps)
    rows = {r.doc_id: r for r in E.detect_pages(pages, "doc_id", "content", none, permissive=True).collect()}
    assert set(rows) == {1, 2} and rows[1].error is None and rows[2].error and rows[1].page_w == 4 and rows[2].page_w is None

    def fail(ps):
        raise ValueError("no model")

    lost = E.detect_pages(pages.where("doc_id = 1"), "doc_id", "content", lambda: fail, permissive=True)
    assert [r.error for r in lost.collect()] == ["no model"]
    assert E.normalise_boxes(lost.drop("error"), "result", (4, 4)).count() == 0
    with pytest.raises(Exception, match="no model"):
        E.detect_pages(pages.where("doc_id = 1"), "doc_id", "content", lambda: fail).collect()


def test_sub_boxes_in_reading_order_with_labels():
    boxes = [{"coordinate": [0, 0, 40, 10], "label": "a"}, {"coordinate": [60, 0, 100, 10], "block_label": "b"}, {"coordinate": [1, 2, 3]}, {"coordinate": [60, 50, 100, 60]}]
    assert [x[4] for x in E.sub_boxes({"res": {"boxes": boxes}})] == ["b", "region", "a"]
    assert E.sub_boxes(json.dumps({"res": boxes[:1]})) == [(0, 0, 40, 10, "a")] and E.sub_boxes(None) == []


def test_gutter_widen_query_against_single_pictures(spark, tmp_path):
    """The registered query's pictures, each by itself."""
    import zlib

    got = {r.key: r for r in catalogue.QUERIES["gutter_widen"](spark, DATA).collect()}
    rows = catalogue.layout(spark, DATA).collect()
    widened = 0
    for r in rows:
        h, w = r.y2 - r.y1, r.x2 - r.x1
        p = np.full((h, w), 255, np.uint8)
        p[:, : w // 2 - 8] = p[:, w // 2 + 8 :] = 20 + r.region % 60
        if r.label == "region":
            q = R.widen(p, seed=R.seed_of(r.region))
            widened += q.shape != p.shape
            # a gap of 16 white columns is deep enough for a cut wherever columns of 18 lie on both sides
            assert q.shape == ((h, w + 5) if w // 2 - 8 >= 20 and h / w >= 0.1 else q.shape)
            p = q
        if 0.1 <= p.shape[1] / p.shape[0] <= 10:
            p = R.pad_white(p)
        assert (got[r.region].h, got[r.region].w, got[r.region].crc) == (*p.shape[:2], zlib.crc32(p.tobytes()))
    assert len(got) == len(rows) and widened > 10


def test_sheets_statistics_and_outlines():
    grey, colour = np.zeros((4, 6), np.uint8), np.zeros((4, 6, 4), np.uint8)
    assert (R.solid_sheet(2, 3, grey, 9) == 9).all() and R.solid_sheet(2, 3, grey[..., None], [7, 8]).shape == (2, 3, 1)
    assert R.solid_sheet(1, 1, colour, [1, 2, 3]).tolist() == [[[1, 2, 3, 255]]]
    p = np.full((4, 6), 200, np.uint8)
    p[:, 1] = 10
    p[:, 4:] = 150
    mean, std = R.background_stats(p, [(4, 6)])
    assert mean.tolist() == [200.0] and std.tolist() == [0.0]
    assert R.background_stats(p, [(0, 6)])[0][0] == pytest.approx((200 * 3 + 150 * 2) / 5)
    out = R.paint_boxes(p, [(1, 1, 5, 9)], thickness=1)
    assert out.shape == (4, 6, 3) and (out[1, 1:5] == (255, 0, 0)).all() and (out[2, 2] == p[2, 2]).all()


# --- recognition, continuity, direction ----------------------------------------------------------------------------------


def test_timeout_and_threads():
    def slow(items):
        time.sleep(0.3)
        return [len(x) for x in items]

    assert B.recognise(["a", "bb"], slow, lambda x: ["second"], timeout=0.05) == [("second", 2), ("second", 2)]
    assert B.recognise(["a", "bb"], lambda x: [], slow, timeout=0.05) == [(None, 2), (None, 2)]
    began = time.time()
    assert B.recognise(["a"] * 4, lambda x: [], slow, threads=4) == [(1, 2)] * 4 and time.time() - began < 1
    assert B.as_blocks(None) is None and B.as_blocks([{"label": "x", "bbox": [1, 2, 3, 4]}])[0]["content"] == ""


def test_scorers():
    d = S.DeferredScorer(lambda: S.PlainScorer(lambda a, b: 0.5))
    with pytest.raises(ModelError):
        d.compute_scores([("a", "b")])
    d.initialize()
    assert d.available and d.compute_scores([("a", "b")]) == [0.5] and S.device_of("x:0") == "x:0" and S.device_of() in ("cpu", "cuda")
    with pytest.raises(ModelError):
        S.scorer_of("mlm")


def test_pairs_that_fail_are_never_linked(spark):
    def half(a, b):
        if "bad" in b:
            raise ValueError
        return 0.9

    cols = "a_x1 int, a_y1 int, a_x2 int, a_y2 int, b_x1 int, b_y1 int, b_x2 int, b_y2 int, a_text string, b_text string"
    pairs = spark.createDataFrame([(0, 0, 10, 10, 0, 10, 10, 20, "x", "y"), (0, 0, 10, 10, 0, 10, 10, 20, "x", "bad")], cols)
    got = {r.b_text: (r.goes_on, round(r.near, 3), r.mixed < 0, r.failed) for r in S.score_pairs(pairs, lambda: S.PlainScorer(half), "half").collect()}
    assert got == {"y": (0.9, 0.998, False, False), "bad": (-1.0, 0.0, True, False)}


def test_reorder_rules(spark):
    """No text, no fragments, a scorer that can't be loaded."""
    rows = [(1, ""), (2, None), (3, "bbox:[1,2,3,4]"), (4, "goes\nbbox:[0,0,10,10]\non\nbbox:[0,10,10,20]")]
    docs = spark.createDataFrame(rows, "doc_id int, markdown string")

    def broken():
        raise ValueError("no weights")

    run = lambda load, name: {r.doc_id: r.final for r in S.reorder_markdown(docs, "doc_id", "markdown", load, name, Tables(spark, "test")).collect()}
    assert run(lambda: S.PlainScorer(lambda a, b: 1.0), "one") == {1: "", 2: "", 3: "bbox:[1,2,3,4]", 4: "goeson"}
    assert run(broken, "broken") == {1: "", 2: "", 3: "bbox:[1,2,3,4]", 4: "goes\non"}


def test_render_takes_flags(spark):
    rows = [(1, k, k + 1, t, f) for k, (t, f) in enumerate([("## A", True), ("b bbox:[1,2,3,4]", True), ("c", True), ("d", False), ("  <div>e", True), ("f", None)])]
    df = spark.createDataFrame(rows, "doc int, block int, seq int, text string, connected boolean")
    assert [r.markdown for r in C.render(df, "doc", "block").collect()] == ["## A\n\nbc\n\nd\n\n<div>e\n\nf"]


def test_direction():
    lexicon = {"the": 50.0, "cat": 20.0, "sat": 20.0, "dna": 1.0, "and": 30.0, "(big)": 5.0}
    judge = D.Judge(lexicon, D.segment_words)
    assert judge.fix_text("tac eht tas\nthe cat and") == "sat the cat\nthe cat and" and judge.fix_text("x") == "x" and judge.log_likelihood(" ") == -100.0
    glued = D.Judge(lexicon)
    assert D.segment_dictionary("thecatxsat", lexicon, 126.0) == ["the", "cat", "x", "sat"] and D.segment_dictionary("", lexicon, 126.0) == []
    assert glued.fix_text("taceht") == "thecat"
    assert D.mirrored("ab (c) ") == "(c) ba "

    def fail(text, lexicon, total):
        raise ValueError

    assert D.Judge(lexicon, fail).fix_text("tac eht") == "tac eht"


def test_segmenter_finds_the_likeliest_split():
    from itertools import product

    rng = np.random.default_rng(3)
    lexicon = {"".join(rng.choice(list("ab"), rng.integers(1, 4))): float(rng.integers(1, 9)) for _ in range(8)}
    total = sum(lexicon.values())
    worth = lambda parts: sum(math.log(max(lexicon.get(p, 0.0), 0.01) / total) for p in parts)
    for _ in range(40):
        text = "".join(rng.choice(list("ab"), 7))
        splits = []
        for cuts in product([0, 1], repeat=len(text) - 1):
            parts, at = [], 0
            for k, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(text[at:k])
                    at = k
            if all(len(p) == 1 or p in lexicon for p in parts):
                splits.append(worth(parts))
        assert worth(D.segment_dictionary(text, lexicon, total)) == pytest.approx(max(splits))


def test_direction_of_wide_blocks(spark, tmp_path):
    (tmp_path / "words.txt").write_text("the 50 x\ncat 20\nsat 20\nbroken\n")
    lexicon = D.read_lexicon(spark, str(tmp_path / "words.txt"))
    assert lexicon == {"the": 50.0, "cat": 20.0, "sat": 20.0}
    with pytest.raises(ValueError):
        D.read_lexicon(spark, str(tmp_path / "words.txt"), most=2)
    block = lambda label, w, h, content: {"label": label, "x1": 0, "y1": 0, "x2": w, "y2": h, "content": content}
    rows = [(1, [block("text", 9, 2, "tac eht\nthe cat"), block("table", 9, 2, "tac eht"), block("doc_title", 9, 2, "eht tas"), block("text", 2, 9, "tac eht"), block(None, 9, 2, "tac eht"), block("text", 9, 2, "")]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, f"id int, blocks {B.BLOCKS}")
    got = {r.id: r.blocks and [b.content for b in r.blocks] for r in D.fix_direction(df, "blocks", D.Judge(lexicon, D.segment_words)).collect()}
    assert got == {1: ["the cat\nthe cat", "tac eht", "sat the", "tac eht", "tac eht", ""], 2: [], 3: None}


def test_direction_natively(spark):
    lexicon = spark.createDataFrame([("the", 50), ("cat", 20)], "token string, freq long")
    texts = spark.createDataFrame([(1, "tac eht"), (2, "the cat"), (3, "x"), (4, "")], "id int, text string")
    got = {r.id: (r.rtl, r.fixed) for r in D.judge_direction(texts, lexicon, ["id"], "text").collect()}
    assert got == {1: (True, "the cat"), 2: (False, "the cat"), 3: (False, "x"), 4: (False, "")}


def test_peak_gaps_and_valleys():
    profile = np.array([0, 9, 0, 0, 0, 0, 8, 0, 9, 0])
    assert R.peak_gaps(profile, 5, 3, 1) == [(2, 5)]
    # one valley of width 6 at half prominence between flat shoulders; a shallow notch beside it
    x = np.array([50, 50, 49, 50, 50, 40, 20, 0, 0, 0, 20, 40, 50, 50], float)
    found = R.valleys(x, 2)
    assert [m for m, _, _ in found] == [8] and R.valleys(x, 7) == []


def test_streamed_pages_equal_a_batch(spark, tmp_path):
    from quireflow.streaming.pages import process_stream

    (tmp_path / "in").mkdir()
    rows = spark.createDataFrame([(k, f"text {k}") for k in range(10)], "id long, text string")
    plan = lambda df: df.withColumn("n", F.length("text"))
    for part in range(2):
        rows.where(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        process_stream(spark, str(tmp_path / "in"), "id long, text string", plan, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "text", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plan(rows).collect()))


def test_final_text(spark):
    from quireflow.sources.pages import final_text

    rows = spark.createDataFrame([("a", "b"), ("", "x\nbbox:[1]"), (None, "y")], "f string, m string")
    assert [r[0] for r in rows.select(final_text(F.col("f"), F.col("m"))).collect()] == ["a", "x", "y"]
    assert BACKENDS.get("decoder:picture")() is E.decode_picture and T.MIRRORED
