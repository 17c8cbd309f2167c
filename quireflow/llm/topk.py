"""Exact top-k by inner product with a pivot-distance index.

Vectors are quantised to integers and lifted by one coordinate, so that all have one norm; the largest inner products of a
query are then its nearest lifted vectors. Pivots come from a bounded sample by farthest-first choice; their number follows
the number of rows up to a bound. Every vector is keyed by its nearest pivot and its distance to it; each pivot's distances
are cut at their quantiles into RINGS annuli at most, and an annulus's rows are dealt to blocks of about BLOCK rows, so that
a cell which holds a third of all rows becomes many blocks. A query first scores one block of the annulus nearest to it, which
gives it a threshold; then it visits only blocks of annuli that the triangle inequality leaves, and inside each its rows in
order of distance, in steps whose bounds are tested until they fall below its k-th best score. Scores are exact integers;
bounds are widened for rounding. Queries travel to blocks in a shuffle. What is broadcast is the pivots and one row per
annulus, both bounded by MOST_PIVOTS whatever the number of rows.

Equal vectors are searched for once, and of rows with equal vectors only the k + 1 smallest ids can be among the best k of
any query, so a vector that a third of all rows share costs no more than another.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows without an id take no part; an
empty vector is the zero vector, and vectors of fewer components are filled up with zeros. Rows that repeat an id and its
vector count once; rows that share an id only are rows of their own, as queries and as candidates. A query with fewer
candidates than k gets all of them. Ties go to the smaller id. Quantised components beyond LARGEST are taken as LARGEST, and
scores beyond a long's range as that range's ends. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch

#: Pivots at least and at most, rows sampled for a pivot, annuli of a pivot at most, rows of a block and of a step in it, queries that visit a block together.
PIVOTS, MOST_PIVOTS, SAMPLE, RINGS, BLOCK, STEP, QUERIES = 64, 2048, 64, 64, 4096, 512, 1024
#: Products of larger numbers than this could be inexact in doubles, and are computed with Python's integers.
EXACT = 2.0**53
LARGEST = 2**53
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def _packed(rows, dims: int) -> list[bytes]:
    """Quantised vectors as 32-bit integers, or as doubles where one is larger."""
    out = []
    for r in rows:
        x = np.zeros(dims)
        x[: len(r)] = r
        out.append((x.astype("<i4") if np.abs(x).max(initial=0) < 2**31 else x).tobytes())
    return out


def _matrix(packed, dims: int) -> np.ndarray:
    """Quantised vectors as doubles, which hold them exactly."""
    packed = list(packed)
    if all(len(x) == 4 * dims for x in packed):
        return np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), dims).astype(float)
    return np.array([np.frombuffer(x, "<i4" if len(x) == 4 * dims else float) for x in packed], float).reshape(len(packed), dims)


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of x and q, as integers within a long's range."""
    if not x.size or not q.size or np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * x.shape[1] < EXACT:
        return (x @ q.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape) @ np.array([[int(v) for v in r] for r in q.tolist()], object).reshape(q.shape).T
    return np.array([[min(max(v, LOWEST), HIGHEST) for v in r] for r in exact.tolist()], np.int64).reshape(exact.shape)


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and q (array of doubles with integer values) of every vector that takes part."""
    most = float(LARGEST)
    x = F.transform(F.col(vector_col), lambda v: F.floor(F.greatest(F.least(v.cast("double") * 256.0, F.lit(most)), F.lit(-most))).cast("double"))
    fine = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), x.alias("q"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sampled row farthest from those chosen."""
    if not len(sample):
        return sample
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def pivots_for(rows: int) -> int:
    """A quarter of the rows' square root, within PIVOTS and MOST_PIVOTS."""
    return min(MOST_PIVOTS, max(PIVOTS, int(rows**0.5) // 4))


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with an id divisible by ``every``, its k best other rows by inner product."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    taking = quantised(vectors, id_col, vector_col)
    n, dims = taking.agg(F.count(F.lit(1)), F.max(F.size("q"))).collect()[0]
    if not n:
        return scratch.finish(spark.createDataFrame([], "query_id long, rank int, vec_id long, score long"))
    padded = F.concat("q", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("q")))
    rows = scratch.cut(taking.select("id", padded.alias("q")).dropDuplicates(["id", "q"]).withColumn("h", F.xxhash64("q")), "rows")
    top = float(rows.agg(F.max(F.aggregate("q", F.lit(0.0), lambda a, v: a + v * v))).collect()[0][0])
    most = k + 1  # the best k, and the query's own row
    of_vector = Window.partitionBy("h", "q").orderBy("id")
    candidates = rows.withColumn("_n", F.row_number().over(of_vector)).where(F.col("_n") <= most).select("id", "q")
    asked = rows.where(F.pmod("id", F.lit(every)) == 0)
    queries = scratch.cut(asked.select("h", "q").dropDuplicates().withColumn("query", F.monotonically_increasing_id()), "queries")
    n_queries = queries.count()
    wanted = pivots_for(n) if pivots is None else pivots
    # the smallest hashes: a fixed, bounded sample
    lift = lambda x: np.concatenate([x, np.sqrt(np.maximum(top - (x**2).sum(1), 0))[:, None]], 1)
    chosen = rows.select("q", F.xxhash64("id", "h").alias("by"), "id").orderBy("by", "id").limit(SAMPLE * wanted).select("q")
    sample = _matrix((p for r in chosen.toLocalIterator() for p in _packed([r.q], dims)), dims)
    shared = spark.sparkContext.broadcast(choose_pivots(lift(sample), wanted))
    slack = 1e-6 * (top**0.5 + 1)

    def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (p**2).sum(1)[None] - 2 * x @ p.T, 0))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            packed = _packed(b.q, dims)
            d = distances(lift(_matrix(packed, dims)), shared.value)
            near = d.argmin(1)
            yield pd.DataFrame({"id": b.id, "vec": packed, "pivot": near.astype(np.int32), "dist": d[np.arange(len(d)), near]})

    keyed = scratch.cut(candidates.mapInPandas(assign, "id long, vec binary, pivot int, dist double"), "keyed")
    # a row per pivot, and then one per annulus: as many annuli as the pivot's rows fill blocks, RINGS at most
    quantiles = F.percentile_approx("dist", F.array(*(F.lit(i / RINGS) for i in range(1, RINGS))), F.lit(1000)).alias("edges")
    edges = keyed.groupBy("pivot").agg(quantiles, F.greatest(F.floor(F.lit(RINGS * BLOCK) / F.count(F.lit(1))), F.lit(1)).alias("every"))
    edges = edges.select("pivot", F.filter("edges", lambda e, i: (i + 1) % F.col("every") == 0).alias("edges"))
    ringed = keyed.join(F.broadcast(edges), "pivot").withColumn("ring", F.size(F.filter(F.array_distinct("edges"), lambda e: e < F.col("dist")))).drop("edges")
    ringed = scratch.cut(ringed, "ringed")
    slots = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("slots")
    directory = ringed.groupBy("pivot", "ring").agg(F.min("dist").alias("near"), F.max("dist").alias("far"), slots)
    listed = directory.toPandas().sort_values(["pivot", "ring"])
    where = spark.sparkContext.broadcast({c: listed[c].to_numpy() for c in listed})
    dealt = ringed.join(F.broadcast(directory.select("pivot", "ring", "slots")), ["pivot", "ring"]).withColumn("slot", F.pmod(F.xxhash64("id", "vec"), F.col("slots")).cast("int"))

    def number(pivot, ring, slot):
        return ((pivot.astype(np.int64) * RINGS + ring) << 24) + slot

    def build(key, g):
        g = g.sort_values(["dist", "id"])
        block = ((int(key[0]) * RINGS + int(key[1])) << 24) + int(key[2])
        return pd.DataFrame({"block": [block], "pivot": [key[0]], "ids": [g["id"].to_numpy(np.int64).tobytes()], "dists": [g["dist"].to_numpy(float).tobytes()], "data": [_matrix(g["vec"], dims).tobytes() if (wide := g["vec"].map(len).max() > 4 * dims) else b"".join(g["vec"])], "wide": [bool(wide)]})

    index = scratch.cut(dealt.drop("slots").groupBy("pivot", "ring", "slot").applyInPandas(build, "block long, pivot int, ids binary, dists binary, data binary, wide boolean"), "index")

    def bounds(q: np.ndarray) -> np.ndarray:
        """For each query and annulus, more than which no score in the annulus can be."""
        at = where.value
        d = distances(np.concatenate([q, np.zeros((len(q), 1))], 1), shared.value)[:, at["pivot"]]
        apart = np.maximum(np.maximum(at["near"][None] - d, d - at["far"][None]), 0) - slack
        return (((q**2).sum(1)[:, None] + top - np.maximum(apart, 0) ** 2) / 2) + slack * (top**0.5 + 1)

    def few(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # so many queries at once that their bounds for all annuli take some MB
        step = max(1, (1 << 20) // len(where.value["pivot"]))
        for b in batches:
            for at in range(0, len(b), step):
                yield b.iloc[at : at + step]

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = where.value
        for b in few(batches):
            packed = _packed(b.q, dims)
            best = bounds(_matrix(packed, dims)).argmax(1)
            block = number(at["pivot"][best], at["ring"][best], b["query"].to_numpy() % at["slots"][best])
            yield pd.DataFrame({"block": block, "query": b["query"].to_numpy(), "vec": packed, "least": LOWEST})

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = where.value
        for b in few(batches):
            packed = np.array(_packed(b.q, dims), object)
            bound, query, least = bounds(_matrix(packed, dims)), b["query"].to_numpy(), b["least"].to_numpy()
            i, j = np.nonzero(bound >= least.astype(float)[:, None])
            times = at["slots"][j]
            i, j = np.repeat(i, times), np.repeat(j, times)
            slot = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
            best = bound.argmax(1)[i]
            rest = (j != best) | (slot != query[i] % at["slots"][best])
            i, j, slot = i[rest], j[rest], slot[rest]
            yield pd.DataFrame({"block": number(at["pivot"][j], at["ring"][j], slot), "query": query[i], "vec": packed[i], "least": least[i]})

    routed = "block long, query long, vec binary, least long"

    def visit(key, queries_of, block):
        out = []
        if len(block) and len(queries_of):
            r = block.iloc[0]
            ids, dist = np.frombuffer(r.ids, np.int64), np.frombuffer(r.dists)
            x = np.frombuffer(r["data"], float if r.wide else "<i4").astype(float).reshape(-1, dims)
            q, names = _matrix(queries_of["vec"], dims), queries_of["query"].tolist()
            d = distances(np.concatenate([q, np.zeros((len(q), 1))], 1), shared.value[[r["pivot"]]])[:, 0]
            least = queries_of["least"].to_numpy().copy()
            got: list[list[tuple[int, int, bool]]] = [[] for _ in names]
            steps = [(dist[a], dist[min(a + STEP, len(dist)) - 1], a) for a in range(0, len(ids), STEP)]
            apart = np.maximum(np.maximum(np.array([g[0] for g in steps])[None] - d[:, None], d[:, None] - np.array([g[1] for g in steps])[None]) - slack, 0)
            bound = ((q**2).sum(1)[:, None] + top - apart**2) / 2 + slack * (top**0.5 + 1)
            order = np.argsort(-bound, 1)
            for turn in range(len(steps)):
                for at in np.unique(order[:, turn]):
                    who = np.flatnonzero((order[:, turn] == at) & (bound[:, at] >= least.astype(float)))
                    if not len(who):
                        continue
                    a = steps[at][2]
                    own, rows_of = ids[a : a + STEP], x[a : a + STEP]
                    for w, line in zip(who, _scores(q[who], rows_of), strict=True):
                        fit = np.flatnonzero(line >= least[w])
                        fit = fit[np.lexsort((own[fit], -line[fit].astype(object) if (line == LOWEST).any() else -line[fit]))[:most]]
                        got[w] = sorted(got[w] + [(-int(line[f]), int(own[f]), bool((rows_of[f] == q[w]).all())) for f in fit])[:most]
                        if len(got[w]) == most:
                            least[w] = max(least[w], -got[w][-1][0])
            out = [(names[w], i, -s, same) for w, g in enumerate(got) for s, i, same in g]
        return pd.DataFrame(out, columns=["query", "vec_id", "score", "same"])

    def run(to: DataFrame, name: str) -> DataFrame:
        # queries for one block go in bounded batches, so that a block which many of them want is not one task's work
        salted = scratch.cut(to.withColumn("batch", F.pmod(F.xxhash64("query"), F.lit(max(1, -(-n_queries // QUERIES)))).cast("int")), name)
        visited = salted.select(F.col("block").alias("to_block"), F.col("batch").alias("to_batch")).distinct()
        visited = visited.join(index, F.col("to_block") == F.col("block")).drop("block")
        return salted.groupBy("block", "batch").cogroup(visited.groupBy("to_block", "to_batch")).applyInPandas(visit, "query long, vec_id long, score long, same boolean")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = scratch.cut(run(queries.select("query", "q").mapInPandas(nearest, routed), "to-first"), "first")
    least = first.withColumn("_rank", F.row_number().over(best)).groupBy("query").agg(F.min(F.when(F.col("_rank") == most, F.col("score"))).alias("least"))
    armed = queries.join(least, "query", "left").select("query", "q", F.coalesce("least", F.lit(LOWEST)).alias("least"))
    rest = run(armed.mapInPandas(further, routed), "to-rest")
    found = scratch.cut(first.unionByName(rest).withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= most).drop("_rank"), "found")
    # equal vectors have one answer, but for their own rows
    each = asked.join(queries, ["h", "q"]).select(F.col("id").alias("query_id"), "query").join(found, "query").where("NOT (same AND vec_id = query_id)")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")).cast("int")
    return scratch.finish(each.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k))
