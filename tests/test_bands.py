"""Neighbours by bands and overlaps by cells against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from quireflow.operators import chain as C

SCHEMA = "doc int, block int, x1 int, y1 int, x2 int, y2 int, text string"


def plain_neighbours(rows, o):
    out = set()
    for d, i, x1, y1, _, y2, _ in rows:
        for e, j, u1, v1, u2, v2, text in rows:
            if d is not None and d == e and i != j and not text.startswith("<div"):
                beside = None not in (x1, y2, u2, v2) and abs(u2 - x1) <= o.left and abs(v2 - y2) <= o.diagonal
                if beside or (None not in (y2, v1) and abs(v1 - y2) <= o.below):
                    out.add((d, i, j))
    return out


@pytest.mark.parametrize("o", [C.ChainOptions(), C.ChainOptions(left=7, diagonal=3, below=11), C.ChainOptions(left=50, diagonal=60, below=0), C.ChainOptions(left=0, diagonal=0, below=1)])
def test_neighbours_against_all_pairs(spark, o):
    rng, rows = random.Random(1), []
    for doc in (1, 2, None):
        for k in range(70):
            x, y = rng.randint(-300, 900), rng.randint(-500, 3000)
            rows.append((doc, k, x, y, x + rng.randint(0, 400), y + rng.randint(0, 1500), rng.choice(["a", "<div b", ""])))
    rows += [(3, 0, None, 1, 2, 3, "n"), (3, 2, 5, None, 7, None, "o"), (3, 1, 0, 0, 9, 9, "m"), (4, 0, 0, 0, 9, 9, "alone")]
    got = C.neighbour_pairs(spark.createDataFrame(rows, SCHEMA), "doc", "block", o).collect()
    assert len(got) == len({(r.doc, r.src, r.dst) for r in got}) and {(r.doc, r.src, r.dst) for r in got} == plain_neighbours(rows, o)
    assert all((r.b_x1, r.b_text) == next((x[2], x[6]) for x in rows if (x[0], x[1]) == (r.doc, r.dst)) for r in got)
    assert C.neighbour_pairs(spark.createDataFrame([], SCHEMA), "doc", "block", o).count() == 0


def test_a_long_document_is_many_keys(spark):
    """50,000 fragments of one document, 60 pixels apart: no key has more than those of a band and no pair is formed outside of bands."""
    n, o = 50_000, C.ChainOptions()
    df = spark.range(n).select(F.lit(1).alias("doc"), F.col("id").cast("int").alias("block"), F.lit(0).alias("x1"), (F.col("id") * 60).cast("int").alias("y1"), F.lit(300).alias("x2"), (F.col("id") * 60 + 50).cast("int").alias("y2"), F.lit("t").alias("text"))
    pairs = C.neighbour_pairs(df, "doc", "block", o)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = pairs.groupBy("src").count().agg(F.count("*"), F.max("count"), F.sum("count")).collect()[0]
    foot = lambda k: 60 * k + 50
    want = [sum(1 for j in range(max(0, k - 40), min(n, k + 40)) if j != k and abs(60 * j - foot(k)) <= o.below) for k in range(60)]
    assert got[0] == n and got[1] == max(want) and got[2] == sum(want[:40]) + (n - 80) * want[45] + sum(sum(1 for j in range(k - 40, n) if j != k and abs(60 * j - foot(k)) <= o.below) for k in range(n - 40, n))


# --- walks -----------------------------------------------------------------------------------------------------------------


def plain_walk(blocks, after):
    seen = []
    for b in sorted(blocks):
        while b is not None and b not in seen:
            seen.append(b)
            b = after.get(b)
    return seen


def test_walks_of_chains_and_rings(spark):
    rng, frags, links, want = random.Random(1), [(None, 3, "null"), (None, 1, "null")], [(None, 3, 1)], []
    for d in range(80):
        blocks = rng.sample(range(100), rng.randint(1, 25))
        ends = blocks[:]
        rng.shuffle(ends)
        after = {a: b for a, b in zip(blocks, ends, strict=True) if a != b and rng.random() < rng.choice([0.3, 0.9, 1])}
        frags += [(d, b, f"t{b}") for b in blocks]
        links += [(d, a, b) for a, b in after.items()]
        want += [(d, b, k, f"t{b}") for k, b in enumerate(plain_walk(blocks, after), 1)]
    out = C.walk_order(spark.createDataFrame(frags, "d int, b int, t string"), spark.createDataFrame(links, "d int, src int, dst int"), "d", "b", "t")
    got = [tuple(r) for r in out.collect()]
    assert sorted(r for r in got if r[0] is not None) == sorted(want) and [r[1:] for r in got if r[0] is None] == [(1, 1, "null"), (3, 2, "null")]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and C.walk_order(spark.createDataFrame([], "d int, b int, t string"), spark.createDataFrame([], "d int, src int, dst int"), "d", "b").count() == 0
