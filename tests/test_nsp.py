"""The continuity scorer against plain loops and differences, its budget, and what it has learnt."""

import functools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.operators import nsp as N
from quireflow.operators.backends import ENDS, OPENS, pair_ids
from quireflow.operators.continuity import reorder_markdown, scorer_of
from quireflow.plans import catalogue
from quireflow.plans.registry import ModelError
from quireflow.tables import Tables


def some_pairs(n, size, seed):
    rng = np.random.default_rng(seed)
    return [tuple(rng.integers(0, size, rng.integers(0, 40)).tolist() for _ in range(2)) for _ in range(n)]


def plain_logits(model, a, b, most):
    """One pair by loops over ids and dimensions."""
    whole = pair_ids(a, b, most)
    half = (most - 3) // 2
    one, two = (a, b) if len(a) + len(b) + 3 <= most else (a[max(0, len(a) - half) :], b[:half])
    assert whole == [OPENS, *one, ENDS, *two, ENDS]
    w, means = model.w, []
    for part in (one, two, one[-N.EDGE :], two[: N.EDGE]):
        means.append([sum(float(w["e"][i][k]) for i in part) / max(1, len(part)) for k in range(N.DIM)])
    m = means
    x = [*m[0], *m[1], *(p * q for p, q in zip(m[0], m[1], strict=True)), *m[2], *m[3], *(p * q for p, q in zip(m[2], m[3], strict=True))]
    hidden = [math.tanh(w["c"][j] + sum(x[i] * w["h"][i][j] for i in range(len(x)))) for j in range(N.HIDDEN)]
    return [w["d"][c] + sum(hidden[j] * w["o"][j][c] for j in range(N.HIDDEN)) for c in range(2)]


@pytest.mark.parametrize("most", [256, 21])
def test_forward_against_loops(most):
    pairs, model = [([], []), ([5], []), *some_pairs(12, 60, 1)], N.Weights.new(60, 3)
    got = model.forward(*N.bags(pairs, most), len(pairs))[0]
    assert np.allclose(got, [plain_logits(model, a, b, most) for a, b in pairs])
    p = N.softmax(got)
    assert np.allclose(p.sum(1), 1) and np.allclose(p[:, 1], 1 / (1 + np.exp(got[:, 0] - got[:, 1])))


def test_gradients_against_differences():
    pairs, model, labels = some_pairs(6, 30, 2), N.Weights.new(30, 4), np.array([0, 1, 1, 0, 1, 0])
    bags = N.bags(pairs)
    loss = lambda: float(-np.log(N.softmax(model.forward(*bags, 6)[0])[np.arange(6), labels]).mean())
    g, rng = model.gradients(*bags, labels), np.random.default_rng(0)
    for name, x in model.w.items():
        for _ in range(25):
            at = tuple(rng.integers(0, s) for s in x.shape)
            old = x[at]
            x[at] = old + 1e-5
            up = loss()
            x[at] = old - 1e-5
            down = loss()
            x[at] = old
            assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_budget_keeps_the_seam():
    a, b = list(range(1000, 1400)), list(range(2000, 2300))
    ids, row, bag = N.bags([(a, b)], 23)
    assert ids[bag == 0].tolist() == a[-10:] and ids[bag == 2].tolist() == b[:10] and ids[bag == 1].tolist() == a[-N.EDGE :] and ids[bag == 3].tolist() == b[: N.EDGE]
    head, tail = N.seen(a)
    assert pair_ids(tail, head) == pair_ids(a, a) and len(head) == len(tail) == 253


def test_weights_learn_and_are_kept(tmp_path, spark):
    """Two topics; the next turn is of the same one."""
    rng = np.random.default_rng(5)
    words = ["red blue green white black".split(), "bread milk salt rice corn".split()]
    say = lambda topic: " ".join(rng.choice(words[topic], 8))
    encode = N.Encoder(N.vocabulary())
    texts, labels = [], []
    for k in range(400):
        texts.append((say(k % 2), say((k + k // 2) % 2)))
        labels.append(int((k + k // 2) % 2 == k % 2))
    model = N.train(list(zip(encode([a for a, _ in texts]), encode([b for _, b in texts]), strict=True)), labels, encode.size)
    (tmp_path / "w.npz").write_bytes(model.dump())
    scorer = scorer_of("nsp")(str(tmp_path / "w.npz"))
    assert not scorer.available and scorer.device in ("cpu", "cuda") and N.PairScorer(model, N.vocabulary(), "npu:0").device == "npu:0"
    with pytest.raises(ModelError):
        scorer.compute_scores([("a", "b")])
    with pytest.raises(ModelError):
        scorer_of("nsp")()
    scorer.warm_up()
    new = [(say(k % 2), say(k // 2 % 2)) for k in range(200)]
    got = scorer.compute_scores(new)
    assert np.mean([(s > 0.5) == (k % 2 == k // 2 % 2) for k, s in enumerate(got)]) > 0.95 and scorer.compute_scores([]) == [] and 0 < scorer.compute_scores([("", "")])[0] < 1
    # the reorder stage with it
    parts = [say(0), say(1), say(1), say(0)]
    text = "\n".join(f"{p}\nbbox:[0,{20 * k},10,{20 * k + 10}]" for k, p in enumerate(parts))
    docs = spark.createDataFrame([(1, text)], "doc int, markdown string")
    path = str(tmp_path / "w.npz")
    final = reorder_markdown(docs, "doc", "markdown", functools.partial(scorer_of("nsp"), path), "nsp", Tables(spark, "test")).collect()[0].final
    assert final.index(parts[3]) == final.index(parts[0]) + len(parts[0]) and parts[1] + parts[2] in final


def test_ranking_of_all_turns(spark):
    """At a small scale: whole tables, no held-out conversation in the sample, better than chance."""
    data = "/root/testdata/sf0.1"
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    out = catalogue.QUERIES["next_turn_ranking"](spark, data).toPandas()
    follows = turns.groupBy("conv_id").agg((F.count("*") - 1).alias("n")).agg(F.sum("n")).collect()[0][0]
    assert len(out) == follows and out["n_others"].max() == N.OTHERS and out["score"].between(0, 1).all()
    test = out[out["held_out"]]
    assert 0.25 < len(test) / len(out) < 0.42
    chance = ((test["n_others"] + 2) / 2).mean()
    assert test["place"].mean() < 0.75 * chance and (test["place"] == 1).mean() > 2 / (N.OTHERS + 1)


def test_odd_turns(spark):
    schema = "conv_id long, turn long, text string"
    model = N.Weights.new(50_000)
    assert N.rank_next_turns(spark.createDataFrame([], schema), model).count() == 0
    rows = [(None, 1, "a"), (None, 2, "b"), (1, None, "first"), (1, 1, None), (1, 1, "tie"), (2, 0, "long " * 50_000), (2, 1, ""), (3, 0, "alone"), (1, 1, "tie")]
    df = spark.createDataFrame(rows, schema).withColumn("key", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("bucket", F.lit(3))
    got = N.rank_next_turns(df, model, others=3).collect()
    assert sorted((r.conv_id, r.turn is None) for r in got) == [(1, False), (1, False), (1, True), (2, False)] and all(1 <= r.place <= r.n_others + 1 for r in got)
    assert N.fit(spark.createDataFrame([], schema)).w["e"].shape[1] == N.DIM


def test_all_turns_are_learnt_in_shares(spark, monkeypatch):
    """However many conversations: each turn that another follows is in one share, once right and once against another conversation's turn."""
    n = 4200
    rows = spark.range(2 * n).select(F.floor(F.col("id") / 2).alias("conv_id"), (F.col("id") % 2).alias("turn"), F.concat(F.lit("turn "), F.col("id")).alias("text"))
    learnt = rows.where(~N.held_out(F.col("conv_id"))).select("conv_id").distinct().count()
    packed = []
    monkeypatch.setattr(N, "train_shares", lambda shares, *_: packed.extend(N.Pairs.load(r.data) for r in shares.collect()))
    N.fit(rows, share=900)
    assert len(packed) > 2 and sum(int(p.labels.sum()) for p in packed) == learnt and all(p.labels.sum() * 2 == len(p) <= 2200 for p in packed)
    every = {tuple(p[k][0]) for p in packed for k in range(len(p))}
    assert len(every) == learnt and all(p[k][1] != p[k + 1][1] for p in packed for k in range(0, len(p), 2))
    alone = []
    monkeypatch.setattr(N, "train", lambda pairs, labels, *_: alone.append((len(pairs), sum(labels))))
    N.fit(rows)
    assert alone == [(2 * learnt, learnt)]


def test_what_shares_learn_is_summed(spark):
    """Two topics again, in shares; the weights don't depend on how shares are dealt to tasks."""
    rng = np.random.default_rng(6)
    shares, frames = [], []
    for k in range(4):
        rows = []
        for j in range(300):
            topic = int(rng.integers(0, 2))
            say = lambda: (10 + 20 * topic + rng.integers(0, 20, 8)).tolist()  # noqa: E731, B023
            rows.append((j, 0, say(), say()))
        own = N.Pairs.of(N.pd.DataFrame(rows, columns=["conv_id", "turn", "tail", "next"]))
        shares.append((k, own.dump()))
        frames.append(own)
    assert len(frames[0]) == 600 and frames[0][1] == N.Pairs.load(shares[0][1])[1]
    df = spark.createDataFrame(shares, "share long, data binary")
    one, two = (N.train_shares(df.repartition(p), 60, epochs=12, batch=32) for p in (1, 3))
    assert all(np.array_equal(one.w[k], two.w[k]) for k in one.w)
    # half of the others are of the other topic
    same = [[(list(range(a, a + 8)), list(range(b, b + 8)))] for a in (12, 33) for b in (20, 41)]
    score = lambda pair: N.softmax(one.forward(*N.bags(pair), 1)[0])[0, 1]
    assert min(score(same[0]), score(same[3])) > 0.5 > 0.3 > max(score(same[1]), score(same[2]))
    lone = N.Pairs.of(N.pd.DataFrame([(5, None, [1], [2]), (5, 1, [3], [])], columns=["conv_id", "turn", "tail", "next"]))
    assert lone.labels.tolist() == [1, 1] and lone[1] == ([3], []) and lone[0] == ([1], [2])
    assert N.train_shares(df.limit(0), 60, epochs=1).w["e"].shape == (60, N.DIM)
