"""What larger tables brought up: texts, lines and pages that the small ones lack, against the SQL of the queries or plain programs."""

import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.functions import textclean as T
from quireflow.operators import chain as C
from quireflow.operators import detect as E
from quireflow.operators import direction as D
from quireflow.operators import fragments as P
from quireflow.operators import nsp as N
from quireflow.operators import overlaps as O
from quireflow.operators import raster as R
from quireflow.operators import xycut as X
from quireflow.plans import catalogue, fakes


def same_as_sql(spark, name, folder):
    got = sorted(map(tuple, catalogue.QUERIES[name](spark, str(folder)).collect()))
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    want = sorted(con.execute(catalogue.SQL[name]).fetchall())
    assert got == want and got
    return got


@pytest.fixture()
def broken_turns(tmp_path):
    """Turns that have line breaks, spaces and headings where they are halved."""
    texts = ["one.\n two", "a b\n\n\n\ncd", "ab\n ## cd", "x\t", "\n", "", "ab   c ", "abcd\n<div>e", "ab\n## c\nd"]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (conv_id BIGINT, turn INT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, 'user', ?)", [(c, k, texts[(c * 4 + k) % len(texts)]) for c in range(9) for k in range(8)])
    con.execute(f"COPY t TO '{tmp_path}/conversations.parquet'")
    return tmp_path


def test_halves_that_begin_with_line_breaks_are_composed_as_in_sql(spark, broken_turns):
    assert any("\n\n\n" in text for _, text in same_as_sql(spark, "compose_document", broken_turns))


def test_halves_that_begin_with_line_breaks_are_rendered_as_in_sql(spark, broken_turns):
    assert any("\n\n\n" in text for _, text in same_as_sql(spark, "render_flags", broken_turns))


@pytest.mark.parametrize("hot_words", [0, 3, D.HOT_WORDS])
def test_direction_by_frequent_and_rare_words(spark, hot_words):
    """Any number of words by broadcast gives the same; tokens beyond those are joined to the others. Texts themselves are shuffled once."""
    rng = random.Random(4)
    freq = {w: rng.randint(1, 50) for w in ("the", "cat", "sat", "(on)", "a", "mat", "tac", "aba", "level", "x(y")}
    words = [*freq, *(D.mirrored(w) for w in freq), "unknown", "nwonknu", "　", ""]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 7))) + rng.choice(["", " ", "\t"]) for _ in range(150)]
    texts += texts[:40] * 5 + ["x", "", None, "the cat", "tac eht"]
    total = float(sum(freq.values()))
    worth = lambda t: sum(math.log(max(freq.get(w, 0.01), 0.01) / total) for w in t.split()) if t.split() else -100.0
    table = spark.createDataFrame(list(freq.items()), "token string, freq long")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = D.judge_direction(df, table, ["id"], "text", hot_words)
    turned = {k: len(t or "") >= 2 and worth(t) < worth(D.mirrored(t)) - 1e-9 for k, t in enumerate(texts)}
    assert {r.id: (r.rtl, r.fixed) for r in out.collect()} == {k: (turned[k], D.mirrored(t) if turned[k] else t) for k, t in enumerate(texts)} and 10 < sum(turned.values()) < 300
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "first(" not in plan
    got = {r.id: r.ll for r in D.log_likelihood(df, table, ["id"], "text", "ll", hot_words).collect()}
    assert len(got) == len(texts) and all(math.isclose(got[k], worth(t or ""), abs_tol=1e-9) for k, t in enumerate(texts))


def test_log_likelihood_shuffles_no_frequent_tokens(spark):
    """Tokens are shuffled only after the frequent ones were joined or left out where they lie."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, "a b a"), (2, "c")], "id int, text string")
        table = spark.createDataFrame([("a", 5), ("b", 1)], "token string, freq long")
        plan = D.log_likelihood(df, table, ["id"], "text", "ll")._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning(") > 1 and "Generate" in plan
    for part in plan.split("Exchange hashpartitioning(token")[1:]:
        nodes = [n for line in part.split("\n")[1:] for n in ("BroadcastHashJoin", "Generate", "Scan") if n in line]
        assert nodes[0] != "Generate"


def crowded_pages(rng, n):
    """Pages of overlapping, empty and turned boxes."""
    pages = []
    for _ in range(n):
        size, most = rng.choice([30, 300]), rng.choice([3, 40, 150])
        corners = [(rng.randint(-20, size), rng.randint(-20, size)) for _ in range(rng.randint(1, 30))]
        pages.append([[x, y, x + rng.randint(-2, most), y + rng.randint(-2, most)] for x, y in corners])
    return pages


def plain_ranks(boxes, scale):
    return [k + 1 for k, _ in sorted(enumerate(X.order_boxes(boxes, scale)), key=lambda p: p[1])]


@pytest.mark.parametrize("scale", [X.PAGE_SCALE, X.CROP_SCALE])
def test_many_pages_are_cut_at_once_as_one_by_one(scale):
    pages = crowded_pages(random.Random(2), 400)
    number = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    flat = np.array([b for p in pages for b in p], np.int64).T
    assert X.cut_pages(number, *flat, np.ones(flat.shape, bool), scale).tolist() == [k for p in pages for k in plain_ranks(p, scale)]


def test_reading_order_sorts_once(spark):
    """One shuffle and one sort, whatever the depth of cuts: memory is a sort's, and a batch's in Python."""
    boxes = spark.createDataFrame([(1, 1, 0, 0, 5, 5)], "page int, idx int, x1 int, y1 int, x2 int, y2 int")
    plan = X.reading_order(boxes, "page", "idx")._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Window" not in plan


def test_small_reading_order_by_batches(spark, monkeypatch):
    """Pages that begin in one part and end in another one, of null and string keys, and one larger than a part."""
    monkeypatch.setattr(X, "BOXES", 7)
    pages = [*crowded_pages(random.Random(3), 60), [[k * 10 % 400, k * 7 % 300, k * 10 % 400 + 30, k * 7 % 300 + 9] for k in range(90)]]
    rows = [(f"p{k}" if k else None, i, *b) for k, p in enumerate(pages) for i, b in enumerate(p)]
    df = spark.createDataFrame(rows, "page string, idx int, x1 int, y1 int, x2 int, y2 int").repartition(3)
    got = {(r.page, r.idx): r["rank"] for r in X.reading_order(df, "page", "idx", X.CROP_SCALE).collect()}
    assert got == {(f"p{k}" if k else None, i): r for k, p in enumerate(pages) for i, r in enumerate(plain_ranks(p, X.CROP_SCALE))}


def test_selected_stages_write_no_table(spark):
    """The sorter's boxes are passed on as they come, and its columns are kept."""
    out = catalogue.QUERIES["selected_stages"](spark, "/root/testdata/sf0.001")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString() and "ranked" not in str(out.inputFiles())


def test_grouped_reading_order_takes_pages_together(spark):
    """No call a page; coordinates that are null or broken are ordered as before."""
    df = spark.createDataFrame([(1, 0, None, 0, 5, 5), (1, 1, 0, 0, 5, 5), (1, 2, 9, 0, 12, None), (2, 0, None, None, None, None)], "page int, idx int, x1 int, y1 int, x2 int, y2 int")
    out = X.reading_order_grouped(df, "page", "idx")
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.page, r.idx): r["rank"] for r in out.collect()}
    broken = df.select("page", "idx", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))
    assert got == {(r.page, r.idx): r["rank"] for r in X.reading_order(broken, "page", "idx").collect()} and got[2, 0] == 1


def test_crops_are_prepared_by_all_cores_without_their_pixels_coming_back(spark):
    """The checksum is taken where the pixels are made, equal to that of the pixels, and rows of one file go to many tasks."""
    out = catalogue.QUERIES["gutter_widen"](spark, "/root/testdata/sf0.001")
    assert "crc32(" not in out._jdf.queryExecution().optimizedPlan().toString() and out.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    rows = [(k, "region" if k % 2 else "text", 9 + k % 50, 3 + k % 70, 1 + 2 * (k % 2), bytes((k * 7 + j) % 256 for j in range((9 + k % 50) * (3 + k % 70) * (1 + 2 * (k % 2))))) for k in range(200)]
    crops = spark.createDataFrame(rows, "key long, label string, h int, w int, c int, data binary").coalesce(1)
    want = {r.key: (r.h, r.w, r.c, r.crc) for r in R.prepare_crops(crops).withColumn("crc", F.crc32("data")).collect()}
    got = {r.key: (r.h, r.w, r.c, r.crc) for r in R.prepare_crops(crops, instead={"crc": ("long", lambda p: zlib.crc32(p.tobytes()))}).collect()}
    assert got == want and len(got) == 200


def test_trie_of_columns_equals_trie_of_a_dictionary():
    """Words of a shard come to the driver as columns; no dictionary or row is made of them."""
    words = {"ab": 3.0, "abc": 1.0, "b": 2.0, "é x": 0.0, "𝄞": 4.0}
    one, two = D.Trie.of(words | {"": 9.0}, 19.0), D.Trie.of_words(list(words), np.array(list(words.values())), 19.0)
    assert all(np.array_equal(getattr(one, k), getattr(two, k), equal_nan=k == "logs") for k in ("keys", "nodes", "logs"))
    assert len(D.Trie.of_words([], np.zeros(0), 1.0).keys) == 0


@pytest.mark.parametrize("name", ["overlap_containers", "overlap_suppression"])
def test_cells_are_shuffled_once(spark, name):
    """Both sides of the join of cells are one exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = O.overlapping(catalogue.crowd(spark, "/root/testdata/sf0.001"), "page", "region", ["score"] if "sup" in name else [])
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan or plan.count("Exchange") == 1


def test_texts_are_encoded_a_few_at_a_time(monkeypatch):
    """A batch's size is not what the library, or a call of the scorer, must hold."""
    encoder, sizes = N.Encoder(N.vocabulary()), []
    library = encoder.library
    encoder.library = type("L", (), {"encode_batch": staticmethod(lambda some, **o: sizes.append(len(some)) or library.encode_batch(some, **o))})
    texts = [f"text {k}" if k % 7 else None for k in range(1000)]
    assert encoder(texts) == [library.encode(t or "", add_special_tokens=False).ids for t in texts] and max(sizes) <= 256


def test_only_strong_pairs_of_open_fragments_are_linked_in_python(spark):
    """Without a strong pair there is no group to call, and links are those of all pairs tried one after the other."""
    rng = random.Random(5)
    frags = [(d, b, rng.choice(["open", "done."])) for d in range(30) for b in range(8)]
    pairs = [(d, a, b, round(rng.uniform(-1, 1), 1), round(rng.random(), 1)) for d in range(30) for a in range(8) for b in range(8) if a != b and rng.random() < 0.6]
    want = []
    for d in range(30):
        is_open, taken, seen = {b: t == "open" for e, b, t in frags if e == d}, set(), set()
        for now in range(8):
            while is_open[now] and now not in seen:
                seen.add(now)
                free = sorted((-m, b, g) for e, a, b, g, m in pairs if e == d and a == now and b not in taken)
                if not free or free[0][2] < 0 or -free[0][0] < 0.6:
                    break
                taken.add(free[0][1])
                want.append((d, now, free[0][1]))
                now = free[0][1]
    links = C.greedy_links(spark.createDataFrame(pairs, "d int, src int, dst int, goes_on double, mixed double"), spark.createDataFrame(frags, "d int, b int, text string"), "d", "b")
    assert sorted((r.d, r.src, r.dst) for r in links.collect()) == sorted(want) and want
    assert "0.6" in links._jdf.queryExecution().optimizedPlan().toString()


def test_links_take_many_documents_a_call(spark):
    """Documents that begin in one batch and end in another one, and no call a document."""
    rng = random.Random(6)
    frags = spark.createDataFrame([(f"d{d}", b, "open") for d in range(40) for b in range(6)], "d string, b long, text string")
    pairs = spark.createDataFrame([(f"d{d}", a, b, 0.9, round(0.6 + 0.4 * rng.random(), 1)) for d in range(40) for a in range(6) for b in range(6) if a != b], "d string, src long, dst long, goes_on double, mixed double")
    got = []
    for rows in (7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        try:
            links = C.greedy_links(pairs, frags, "d", "b")
            got.append(sorted(map(tuple, links.collect())))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[0] == got[1] and len({r[0] for r in got[0]}) == 40 and all(len({r[2] for r in got[0] if r[0] == f"d{d}"}) == sum(r[0] == f"d{d}" for r in got[0]) for d in range(40))
    assert "FlatMapGroups" not in links._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1, 3000, 4 << 20])
def test_crops_of_many_pages_go_together_and_pages_are_not_sorted(spark, monkeypatch, most):
    monkeypatch.setattr(E, "PIXELS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = fakes.pages(spark, "/root/testdata/sf0.001").limit(20).localCheckpoint()
        held = {r.doc_id: E.decode_picture(bytes(r.content)) for r in pages.collect()}
        rows = [(d, k, 3 * k, 2 * k, 3 * k + 20, 2 * k + 9) for d in [*held, -1, None] for k in range(d % 4 if d else 2)]
        boxes = spark.createDataFrame(rows, "doc_id long, n int, cx1 int, cy1 int, cx2 int, cy2 int")
        out = E.crop_pixels(boxes, pages, "doc_id", "content")
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(tuple(r)[:6] for r in got if r.doc_id is not None) == sorted(r for r in rows if r[0] is not None) and len(got) == len(rows)
    for r in got:
        p = E.picture_of(r)
        assert p is None if r.doc_id in (-1, None) else np.array_equal(p, held[r.doc_id][r.cy1 : r.cy2, r.cx1 : r.cx2])
    assert "ShuffledHashJoin" in plan and "Sort " not in plan


def test_most_boxes_lie_in_one_cell_and_cells_are_not_broadcast(spark):
    """What is shuffled is about a row a box, and a small table's many cells go to no worker whole."""
    boxes = catalogue.crowd(spark, "/root/testdata/sf0.001")
    cells = lambda a, z: F.floor((F.col(z) - 1) / O.CELL) - F.floor(F.col(a) / O.CELL) + 1
    n, rows = boxes.where("x2 > x1 AND y2 > y1").agg(F.count(F.lit(1)), F.sum(cells("x1", "x2") * cells("y1", "y2"))).collect()[0]
    assert n > 1000 and rows < 1.3 * n
    pairs = O.overlapping(boxes, "page", "region", ["score"])
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, O.overlapping(boxes, "page", "region", ["score"], cell=50).collect()))


def test_lines_of_titles_are_stripped(spark, tmp_path):
    """White space around a title's lines goes, and so around lines that are joined."""
    texts = ["a", " a b ", "a\n b", "é 漢\n"]
    spark.createDataFrame([(1, k, t) for k, t in enumerate(texts * 3)], "conv_id long, turn int, text string").coalesce(1).write.parquet(str(tmp_path / "w"))
    next((tmp_path / "w").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    for f in (tmp_path / "w").iterdir():
        f.unlink()
    (tmp_path / "w").rmdir()
    same_as_sql(spark, "format_titles", tmp_path)
    df = spark.createDataFrame([(" T \n  x\t\n \n\u3000y ",)], "t string")
    assert df.select(T.format_title(F.col("t"))).collect()[0][0] == "## T  x y"
    assert df.select(T.normalise_markdown(F.col("t"))).collect()[0][0] == "Txy"


def test_inline_fragments_are_stripped(spark):
    """The text before a marker is a fragment without the white space around it; one of white space only is none."""
    docs = spark.createDataFrame([(1, " a bbox:[1,2, 3,4]\n\t b\n c 　bbox:[5,6,7,8] \n bbox:[9,9,9,9] d ")], "doc int, markdown string")
    got = [tuple(r)[1:] for r in P.parse_inline(docs, "doc").orderBy("block_id").collect()]
    assert got == [(0, "a", 1, 2, 3, 4), (1, "b\n c", 5, 6, 7, 8), (2, "d", 0, 0, 1000, 100)]
    inline, lines = (sorted(map(tuple, catalogue.QUERIES[f"parse_fragments_{kind}"](spark, "/root/testdata/sf0.001").collect())) for kind in ("inline", "lines"))
    assert inline == lines and inline


def test_pictures_are_drawn_where_they_are_prepared(spark):
    """No pixels go from one Python function to another."""
    plan = catalogue.QUERIES["gutter_widen"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "data#" not in plan
