"""Golden cases, the registered queries against their SQL, and backends' contracts."""

import math
import os
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.functions import textclean as T
from quireflow.operators import chain as C
from quireflow.operators import raster as R
from quireflow.operators import xycut as X
from quireflow.plans import catalogue
from quireflow.plans.registry import STAGES, Config, ConfigError, InputError, Pipeline, PipelineError
from quireflow.sources.pages import read_pages, write_markdown

DATA = "/root/testdata/sf0.001"


def value(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t"))).collect()[0][0]


@pytest.mark.parametrize("text,want", [("abababab", "ab"), ("aaa", "a"), ("aa", "aa"), ("abcabc", "abcabc"), ("xxx\nabcabcabc\nq", "x\nabc\nq")])
def test_collapse(spark, text, want):
    assert value(spark, T.collapse_duplicates, text) == want


@pytest.mark.parametrize("expr,text,want", [
    (T.normalise_markdown, "a\nb.\nc", "ab.\n\nc"), (T.format_title, "T", "## T"), (T.format_title, "# T", "## T"), (T.format_title, "## T", "## T"),
    (T.format_title, "T\nx\ny", "## T x y"), (T.mirror_reverse, "(ab) ", "(ba) "), (T.strip_bbox_lines, "x\n  bbox:[1,2,3,4]\ny", "x\ny"), (T.strip, "\u3000a ", "a"),
])
def test_text_golden(spark, expr, text, want):
    assert value(spark, expr, text) == want


def test_long_runs(spark):
    """Runs of 100,000 groups and repetitions of long texts: no deep stack, no quadratic time."""
    began = time.time()
    assert value(spark, T.remove_paren_runs, "x" + "(ab) " * 100_000 + "y") == "xy"
    assert value(spark, T.remove_paren_runs, "(a)(b) (c)(d)") == "(a)(b) (c)(d)" and value(spark, T.remove_paren_runs, "(a)(b) (c)(d)\n(e) (") == "("
    assert value(spark, T.full_clean, "(ab) " * 100_000 + "q") == "q"
    for text, want in (("a" * 200_000 + "b", None), ("ab" * 100_000, "ab"), ("a" * 199_999, "a"), (("x" * 50_000 + "y") * 3, "x" * 50_000 + "y")):
        assert value(spark, T.collapse_duplicates, text) == (want or text)
    assert time.time() - began < 60


@pytest.mark.parametrize("n", range(1, 40))
def test_shrink_line_finds_the_shortest_unit(n):
    """The divisors that the expression tests, against all prefixes."""
    small = [k for k in range(1, max(1, math.isqrt(n)) + 1) if n % k == 0]
    sizes = small + [n // k for k in small][::-1]
    assert sorted(set(sizes)) == [p for p in range(1, n + 1) if n % p == 0] and sizes == sorted(sizes)


def test_spatial_weight(spark):
    def near(a, b):
        cols = [F.lit(v).alias(n) for n, v in zip(["a_x1", "a_y1", "a_x2", "a_y2", "b_x1", "b_y1", "b_x2", "b_y2"], [*a, *b], strict=True)]
        return round(spark.range(1).select(*cols).select(C.spatial_weight()).collect()[0][0], 6)

    assert near([100, 200, 300, 400], [100, 400, 300, 600]) == 0.960789
    assert near([350, 200, 550, 400], [100, 200, 300, 400]) == 0.904837


def test_xy_cut_native_equals_grouped(spark):
    rng = random.Random(3)
    rows = []
    for page in range(60):
        for k in range(rng.randint(1, 14)):
            x, y = rng.randint(0, 300), rng.randint(0, 300)
            rows.append((page, k, x, y, x + rng.randint(2, 120), y + rng.randint(2, 60)))
    # a page of nested cuts: each box beside or under all that follow
    x1, y1, x2, y2 = 0, 0, 40_000, 40_000
    for k in range(18):
        if k % 2:
            rows.append((100, k, x1, y1, x2, y1 + (y2 - y1) // 3))
            y1 += (y2 - y1) // 2
        else:
            rows.append((100, k, x1, y1, x1 + (x2 - x1) // 3, y2))
            x1 += (x2 - x1) // 2
    df = spark.createDataFrame(rows + [(99, 0, 0, 0, 100, 50), (99, 1, 200, 0, 300, 50)], "page int, idx int, x1 int, y1 int, x2 int, y2 int")
    for scale in (X.PAGE_SCALE, X.CROP_SCALE):
        b = {(r.page, r.idx): r["rank"] for r in X.reading_order_grouped(df, "page", "idx", scale).collect()}
        for rounds in (1, 2):
            assert {(r.page, r.idx): r["rank"] for r in X.reading_order(df, "page", "idx", scale, rounds=rounds).collect()} == b
    assert b[99, 1] == 1 and b[99, 0] == 2


def test_walk_and_links(spark):
    frags = spark.createDataFrame([(1, 0, "B"), (1, 1, "A"), (1, 2, "C")], "d int, b int, text string")
    links = spark.createDataFrame([(1, 1, 0, 1.0), (1, 0, 2, 1.0)], "d int, src int, dst int, mixed double")
    assert [r.b for r in C.walk_order(frags, links, "d", "b").orderBy("seq").collect()] == [0, 2, 1]


def test_raster():
    p = np.full((40, 80), 255, np.uint8)
    p[:, :30] = p[:, 50:] = 10
    assert len(R.column_spans(p)) == 2
    assert R.widen(p, seed=1).shape == (40, 85) and (R.widen(p, seed=1) == R.widen(p, seed=1)).all()
    q = R.pad_white(np.zeros((50, 100), np.uint8))
    assert q.shape == (150, 150, 3) and (q[50:100, 25:125] == 0).all() and q[49].min() == 255


def test_config_and_pipeline(spark):
    c = Config.load({"coarse_detector": {"threshold": 0.5}, "coarse": {"x": 1}}, environ={"QUIREFLOW_COARSE_DETECTOR_THRESHOLD": "0.7"}, runtime={"ocr": {"n": 2}})
    assert c.get("coarse_detector.threshold") == 0.7 and c.get("ocr.n") == 2 and c.get("no.such", 5) == 5
    with pytest.raises(ConfigError):
        Config.load({}, path="/no/such/file")
    with pytest.raises(PipelineError):
        Pipeline(["no such stage"], skip=["no such stage"])
    STAGES.register("twice")(lambda df, config: df.withColumn("id", F.col("id") * 2))
    assert [r.id for r in Pipeline(["twice", "twice"]).run(spark.range(3)).collect()] == [0, 4, 8]
    assert [r.id for r in Pipeline(["twice"], skip=["twice"]).run(spark.range(3)).collect()] == [0, 1, 2]


def test_source_and_sink(spark, tmp_path):
    (tmp_path / "scan.v2").mkdir()
    for n in ("a.PNG", "b.txt", "c.jpg", ".png", "d.e.bmp"):
        (tmp_path / "scan.v2" / n).write_bytes(b"x")
    (tmp_path / "scan.v2" / "sub").mkdir()
    (tmp_path / "scan.v2" / "sub" / "z.png").write_bytes(b"x")
    assert sorted(r.doc_id for r in read_pages(spark, str(tmp_path / "scan.v2")).collect()) == ["a", "c", "d.e"]
    assert [r.doc_id for r in read_pages(spark, str(tmp_path / "scan.v2" / "b.txt")).collect()] == ["b"]
    with pytest.raises(InputError):
        read_pages(spark, str(tmp_path / "none"))
    docs = spark.createDataFrame([("d1", "x\ny é"), ("a/b", None), (None, "q")], "doc_id string, markdown string")
    for _ in range(2):
        assert write_markdown(docs, str(tmp_path / "out")) == 3
    assert sorted(p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a%2Fb/a%2Fb.md", "d1/d1.md", "null/null.md"]
    assert (tmp_path / "out" / "d1" / "d1.md").read_text(encoding="utf-8") == "x\ny é"


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


def compare(spark, queries, sql, name, data=DATA):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    df = queries[name](spark, data)
    cols = sorted(df.columns)
    rel = con.sql(sql[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)
    b = sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=str)
    assert a == b


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    compare(spark, catalogue.QUERIES, catalogue.SQL, name)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
