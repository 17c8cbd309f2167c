"""The two trained models against plain versions: recurrent network by loops, gradients by differences, windows, and best paths by trying all."""

import itertools
import math

import numpy as np
import pytest

from quireflow.llm import html_main as H
from quireflow.llm import toxicity as X

WORDS = "the cat sat on a mat and then it went away from there to some other place without a word of thanks or so they say in town".split()


def some_model(seed=3, known=WORDS[:15]):
    rng = np.random.default_rng(seed)
    model = X.Model({w.encode(): k + 1 for k, w in enumerate(known)}, np.concatenate([[0.0], rng.normal(size=len(known))]), seed)
    for k, w in model.w.items():
        if k != "word":
            model.w[k] = w + 0.1 * rng.standard_normal(w.shape).astype(np.float32)
    return model


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_bucket(a, b, c):
    m = 0xFFFFFFFF
    x = ((((a * 0x9E3779B1) & m) ^ ((b * 0x85EBCA77) & m) ^ ((c * 0xC2B2AE3D) & m)) * 0x27D4EB2F) & m
    return (x >> 20) % X.TRIGRAMS


def plain_logit(model, window):
    """One window, one number at a time."""
    w, h = model.w, X.HIDDEN
    inputs = []
    for word in window:
        row = model.known.get(word, 0)
        padded = b"\x00" + word + b"\x00"
        buckets = [plain_bucket(*padded[k - 1 : k + 2]) for k in range(1, len(padded) - 1)]
        chars = [sum(float(w["char"][b][j]) for b in buckets) / len(word) for j in range(X.CHAR_DIM)]
        inputs.append([*map(float, w["word"][row]), float(model.odds[row]), *chars])
    padding = X.WINDOW - len(window)
    inputs += [[0.0] * (X.WORD_DIM + 1 + X.CHAR_DIM)] * padding
    states = []
    for side in (0, 1):
        now, out = [0.0] * h, []
        for x in inputs if side == 0 else inputs[::-1]:
            g = [sum(a * float(w["x"][side][i][j]) for i, a in enumerate(x)) + float(w["b"][side][0][j]) for j in range(3 * h)]
            r = [sum(a * float(w["u"][side][i][j]) for i, a in enumerate(now)) for j in range(3 * h)]
            z = [sigmoid(g[j] + r[j]) for j in range(h)]
            reset = [sigmoid(g[h + j] + r[h + j]) for j in range(h)]
            new = [math.tanh(g[2 * h + j] + reset[j] * r[2 * h + j]) for j in range(h)]
            now = [(1 - z[j]) * new[j] + z[j] * now[j] for j in range(h)]
            out.append(now)
        states.append(out if side == 0 else out[::-1])
    both = [a + b for a, b in zip(*states, strict=True)]
    e = []
    for k, s in enumerate(both):
        t = [math.tanh(sum(a * float(w["a"][i][j]) for i, a in enumerate(s))) for j in range(X.ATTEND)]
        e.append(sum(a * float(b) for a, b in zip(t, w["v"], strict=True)) - (30 if k >= len(window) else 0))
    weights = [math.exp(x - max(e)) for x in e]
    pooled = [sum(a * s[j] for a, s in zip(weights, both, strict=True)) / sum(weights) for j in range(2 * h)]
    return sum(a * float(b) for a, b in zip(pooled, w["o"], strict=True)) + float(w["c"][0]) + model.shift


@pytest.mark.parametrize("text", ["", "x", "the cat sat", " ".join(WORDS[:24]), " ".join(WORDS), " ".join(WORDS * 3) + " Été, naïve!"])
def test_score_is_that_of_the_worst_of_all_windows(text):
    model = some_model()
    model.shift = 0.3
    words = X.words_of(text)
    n = len(words)
    windows = [words[s : s + X.WINDOW] for s in range(0, max(1, n - X.WINDOW + X.STEP), X.STEP) if s + X.WINDOW <= n or n <= X.WINDOW]
    if n > X.WINDOW:
        windows.append(words[n - X.WINDOW :])
    want = sigmoid(max(plain_logit(model, x) for x in windows or [[]]))
    assert X.Scorer(model).scores([text])[0] == pytest.approx(want, abs=2e-5)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 36, 37, 48, 100, 1001])
def test_windows_cover_every_word(n):
    starts = X.window_starts(n)
    covered = np.zeros(max(n, X.WINDOW), int)
    for s in starts:
        covered[s : s + X.WINDOW] += 1
    assert covered.min() >= 1 and (n <= X.WINDOW or starts.max() == n - X.WINDOW) and (np.diff(starts) <= X.STEP).all()
    sample = X.Sample.of([(1, 0, [b"w%d" % k for k in range(n)])])
    ids, owner = sample.windows()
    assert set(ids.ravel().tolist()) - {0} == set(range(1, n + 1)) and len(owner) == len(starts)


def test_scores_do_not_depend_on_the_batch():
    model = some_model()
    texts = [" ".join(WORDS[k:]) * (1 + k % 3) for k in range(12)] + ["", None]
    together = X.Scorer(model).scores(texts)
    assert together == pytest.approx([X.Scorer(model).scores([t])[0] for t in texts], abs=1e-6)


def test_gradients_against_differences():
    model = some_model(5)
    for k, w in model.w.items():
        model.w[k] = w.astype(np.float64)
    model.odds = model.odds.astype(np.float64)
    words = [w.encode() for w in dict.fromkeys(WORDS)][:20]
    rng = np.random.default_rng(2)
    ids = rng.integers(0, len(words) + 1, (X.WINDOW, 5))
    ids[0] = np.maximum(ids[0], 1)
    mask, labels, weights, drop = ids > 0, np.array([0, 1, 1, 0, 1.0]), np.array([1, 3, 3, 1, 3.0]), np.array([2, 7])

    def loss():
        rows = np.array([0 if k in drop else model.known.get(w, 0) for k, w in enumerate(words)])
        x = np.concatenate([np.zeros((1, X.WORD_DIM + 1 + X.CHAR_DIM)), model.inputs(words, rows)])
        projected = model.project(x)
        states = np.zeros((2, X.WINDOW, 5, X.HIDDEN))
        h = np.zeros((2, 5, X.HIDDEN))
        gates = np.stack([projected[0][ids], projected[1][ids[::-1]]])
        for t in range(X.WINDOW):
            g, r = gates[:, t], h @ model.w["u"]
            z, reset = (1 / (1 + np.exp(-(g + r)[..., k * X.HIDDEN : (k + 1) * X.HIDDEN])) for k in (0, 1))
            new = np.tanh(g[..., 2 * X.HIDDEN :] + reset * r[..., 2 * X.HIDDEN :])
            h = (1 - z) * new + z * h
            states[:, t] = h
        logit = model.pool(states, mask)[0]
        return float((weights * (np.logaddexp(0, logit) - labels * logit)).sum() / weights.sum())

    found = X._gradients(model, words, ids, mask, labels, weights, drop)
    for name, w in model.w.items():
        flat = w.reshape(-1)
        moving = np.flatnonzero(np.abs(found[name].reshape(-1)) > 1e-7)
        for k in rng.choice(moving, min(12, len(moving)), replace=False):
            keep, step = flat[k], 1e-4
            flat[k] = keep + step
            up = loss()
            flat[k] = keep - step
            slope = (up - loss()) / (2 * step)
            flat[k] = keep
            assert found[name].reshape(-1)[k] == pytest.approx(slope, rel=2e-2, abs=2e-5), name
        assert len(moving)


def test_conflicting_labels_and_repeated_ids(spark):
    docs = spark.createDataFrame([(2, "one two"), (2, "three"), (3, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (2, 1), (3, 0), (3, 0), (None, 1), (4, None), (5, 7)], "doc_id long, toxic int")
    sample = X.training_sample(docs, labels, skip_fold=None)
    assert sample.ids == [2, 3] and sample.toxic == [1, 0] and sorted(sample.names[k] for k in sample.words[0]) == [b"one", b"three", b"two"] and len(sample.words[1]) == 0


# --- conditional random field ----------------------------------------------------------------------------------------------


def path_score(model, page, labels):
    out = model.edge[0][labels[0]] + model.edge[1][labels[-1]]
    out += sum(model.scores(b)[y] for b, y in zip(page, labels, strict=True))
    return out + sum(model.step[a][b] for a, b in zip(labels, labels[1:], strict=False))


def test_viterbi_against_all_paths():
    model, rng = H.default_model(), np.random.default_rng(4)
    for page, _ in H.training_pages(25, seed=77):
        found = H.blocks(page)[:9]
        if found:
            noisy = H.Crf(model.index, model.node + rng.normal(size=model.node.shape), model.step + rng.normal(size=(2, 2)), model.edge + rng.normal(size=(2, 2)))
            best = max(itertools.product((0, 1), repeat=len(found)), key=lambda y: path_score(noisy, found, y))
            got = noisy.decode(found)
            assert path_score(noisy, found, got) == pytest.approx(path_score(noisy, found, best))
    assert model.decode([]) == []


def test_crf_training_follows_the_likelihood():
    """Expected counts by trying all paths: at the trained weights the likelihood's slope is that of the prior."""
    pages = [x for x in (H.labelled_blocks(*p) for p in H.training_pages(6, seed=9)) if x[0]]
    pages = [(b[:6], y[:6]) for b, y in pages]
    model = H.train_crf(pages, steps=600, rate=0.05, decay=0.05)

    def worth():
        out = 0.0
        for page, own in pages:
            model.kept.clear()
            all_paths = [path_score(model, page, y) for y in itertools.product((0, 1), repeat=len(page))]
            out += path_score(model, page, own) - float(np.logaddexp.reduce(all_paths))
        return out - 0.5 * 0.05 * len(pages) * float((model.node**2).sum() + (model.step**2).sum() + (model.edge**2).sum())

    rng = np.random.default_rng(1)
    for weights in (model.node, model.step, model.edge):
        for k in rng.choice(weights.size, 4, replace=False):
            flat, step = weights.reshape(-1), 1e-4
            keep = flat[k]
            flat[k] = keep + step
            up = worth()
            flat[k] = keep - step
            slope = (up - worth()) / (2 * step)
            flat[k] = keep
            assert abs(slope) < 0.03


# fixed values: pages written by hand, with the text that a reader would call the article
HAND = [
    ("<html><head><title>t</title></head><body><div id='top' class='site-header'><h1>My Site</h1><ul class='menu'><li><a href='/'>Home</a></li><li><a href='/a'>About</a></li></ul></div>"
     "<div class='post'><h1>On rivers</h1><p>Rivers carry water to the sea, and have done so for a long time.</p><p>They also carry <b>sand</b> &amp; stones.</p></div>"
     "<div class='sidebar'><h3>Popular</h3><ul><li><a href='/1'>Ten best boats</a></li></ul></div><div id='footer'>Copyright 2020 My Site</div></body></html>",
     "On rivers\nRivers carry water to the sea, and have done so for a long time.\nThey also carry sand & stones."),
    ("<body><header><p>Daily News</p></header><nav><a href='/'>Home</a> <a href='/s'>Sport</a></nav><main><article><h2>Short note</h2><p>It rained.</p><ul><li>first point of the list</li><li>second</li></ul></article></main>"
     "<section class='comments'><p>I liked this piece a lot, thanks for writing it.</p></section><footer><p>Contact us</p></footer></body>",
     "Short note\nIt rained.\nfirst point of the list\nsecond"),
    ("<body><div class='cookie-banner'>We use cookies to improve your visit. <button>Accept</button></div><form class='search'><label>Search</label><input name='q'></form>"
     "<article class='entry-content'><p>Only one paragraph here, but it is the text of the page.</p><script>var x = '<p>no</p>';</script><aside class='ad'>Buy our shoes now</aside><p>And a second one.</p></article></body>",
     "Only one paragraph here, but it is the text of the page.\nAnd a second one."),
    ("<div><div><nav><ul><li><a href='#'>A</a></li></ul></nav></div></div>", ""),
]


@pytest.mark.parametrize("page,text", HAND)
def test_pages_written_by_hand(page, text):
    assert H.main_text(page, H.default_model()) == text
