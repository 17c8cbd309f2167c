"""Each operator against a brute-force version or its SQL, and on odd tables: nulls, empties, repeats, clashing columns."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quireflow.llm import html_main, ngram_join, packing, quality, queries, token_orc, topk, toxicity, url_filter
from quireflow.llm.common import Scratch
from quireflow.llm.components import connected_components
from quireflow.llm.mixing import mix_documents, mix_plan
from quireflow.llm.token_counts import RollupStore, refuse_replacing
from quireflow.llm.tokens import CachedEncoder, vocabulary

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, taken string"
LONG = " ".join(f"w{k % 977}x{k}" for k in range(6000))
ODD = [(1, "a b c d e f g h i j k l", "en", "s", 1, 5, "x"), (1, "a b c d e f g h i j k l", "en", "s", 1, 5, "x"), (None, "a b c d e f g h i j k l", None, None, None, None, None), (2, None, "en", "s", 0, 0, ""), (3, "", "en", None, 0, 0, ""), (4, LONG, "en", "t", 1, 1, ""), (5, " \n\t ", "", "", 0, 0, ""), (6, "é<|endoftext|>\u3000漢字 \U0001f600", "x", "s", 0, 0, "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    from tests.test_layout import compare

    compare(spark, queries.QUERIES, queries.SQL, name, DATA)


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_encoder(name, kind):
    e, rng = CachedEncoder(vocabulary(name), kind), np.random.default_rng(1)
    letters = list(" \n\t'abstTÉßœ12.,!?«–") + ["漢", "\u00a0", "<|endoftext|>", "I'm", "ﬁ", "İ"]
    for _ in range(500):
        text = "".join(rng.choice(letters, 12))
        assert e.encode(text) == np.array(e.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check_packing(rows, texts, capacity=2048):
    e = CachedEncoder(vocabulary("byte_bpe_50k.json"), "byte")
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in texts.items():
        ids, at = e.encode(text) + b"\0\0\0\0", 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            assert k == 0 or r.length == capacity
            at += r.length
        assert at == len(ids) // 4
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, docs):
    rows = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json")).collect()
    n = check_packing(rows, {r.doc_id: r.text for r in docs.collect()})
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_packing_odd(spark, odd, none):
    assert packing.pack_documents(none, vocabulary("byte_bpe_50k.json")).count() == 0
    rows = packing.pack_documents(odd, vocabulary("byte_bpe_50k.json")).collect()
    assert len(rows) >= len(ODD)
    check_packing(rows, {2: "", 3: "", 4: LONG, 6: ODD[7][1]})


def test_plan_bins():
    plan = packing.plan_bins({5: 3, 4: 2, 3: 1, 1: 2}, 8)
    left = {5: 3, 4: 2, 3: 1, 1: 2}
    for combination, times in plan:
        assert sum(a * b for a, b in combination.items()) <= 8
        for a, b in combination.items():
            left[a] -= b * times
    assert not any(left.values()) and sum(t for _, t in plan) == 4


def test_token_orc(spark, docs, odd, none, tmp_path):
    e = CachedEncoder(vocabulary("word_bpe_49k.json"), "word")
    at = 0
    got = {r.doc_id: r for r in token_orc.token_ids_digest(docs, vocabulary("word_bpe_49k.json")).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = e.encode(r.text) + np.array([2], "<u4").tobytes()
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    token_orc.write_token_orc(docs, f"file://{tmp_path}/t", vocabulary("word_bpe_49k.json"))
    few = token_orc.read_token_orc(spark, f"file://{tmp_path}/t", [3, 7])
    assert sorted(r.doc_id for r in few.collect()) == [3, 7] and "PushedFilters: [In(doc_id" in few._jdf.queryExecution().toString()
    assert token_orc.token_ids_digest(odd, vocabulary("word_bpe_49k.json")).count() == len(ODD)
    assert token_orc.token_ids_digest(none, vocabulary("word_bpe_49k.json")).count() == 0


def test_quality(spark, odd, none):
    got = quality.judge_documents(odd).collect()
    assert len(got) == len(ODD) and {r.doc_id: r.kept for r in got}[1] and not {r.doc_id: r.kept for r in got}[2]
    assert quality.judge_documents(none).count() == 0 and quality.clean_documents(none).columns == none.columns
    words = "a b c d e a b c d e z".encode().split()
    assert quality.repeated_words(words) == 10
    body = [(k, f"common line of the site\n{' '.join(chr(97 + k % 26) * (2 + k // 26) + chr(97 + j % 26) * (1 + j // 26) for j in range(30))}", "en", "s", 0) for k in range(30)] + [(99, "Common   LINE of the site\nx y z", "en", "s", 0), (100, "\n".join(["common line of the site"] * 3 + [f"q{k}" for k in range(2)]), "en", "s", 0)]
    df = spark.createDataFrame(body, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in quality.clean_documents(df).collect()}
    assert set(range(30)) <= set(kept) and 100 not in kept and not any("common line" in t for t in kept.values())


def brute_components(texts, n, percent):
    sets = {}
    for i, t in texts.items():
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = {i: i for i in texts}
    links = {i: 0 for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


@pytest.mark.parametrize("n,percent,frequent,block", [(4, 85, None, 1000), (5, 80, 3, 8), (3, 80, 1, 5), (2, 60, 2, 7), (1, 70, 1, 1000)])
def test_jaccard(spark, n, percent, frequent, block):
    rng = np.random.default_rng(n)
    texts, number = {}, 0
    for family in range(12):
        base = [f"f{family}w{k}" for k in range(int(rng.integers(1, 90)))]
        for _ in range(int(rng.integers(1, 16))):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(10**6)}"
            if rng.random() < 0.3:
                w += "this passage is found in a great many of the documents".split()
            texts[number] = " ".join(w)
            number += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.jaccard_join(df, n=n, percent=percent, frequent=frequent, block=block).collect()}
    assert got == brute_components(texts, n, percent)


def linked_pairs(sets, percent):
    ids = range(len(sets))
    return [(a, b) for a in ids for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


@pytest.mark.parametrize("percent", [55, 60, 66, 67, 70, 80, 85, 88])
def test_linked_sets_share_a_signature(percent):
    """Small sets of frequent, rare and unique tokens: every linked pair of different sets has a signature in common, and passes the parity bits."""
    rng = np.random.default_rng(percent)
    pool = rng.integers(0, 2**63, 30).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    sets = {frozenset(pool[rng.permutation(30)[: rng.integers(1, 12)]].tolist()) for _ in range(200)}
    for base in list(sets)[:60]:  # neighbours of a set, so that many pairs are linked
        for _ in range(3):
            s = set(base)
            s.symmetric_difference_update(rng.choice(pool, int(rng.integers(1, 4))).tolist())
            sets |= {frozenset(s)} if s else set()
    sets = sorted(sets, key=sorted)
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    count = {t: sum(t in s for s in sets) for t in pool.tolist()}
    pairs = linked_pairs(sets, percent)
    assert len(pairs) > 5
    for frequent in (0, 20, 10**6):
        sigs = [set(ngram_join.signatures(a, np.array([count[t] > 1 for t in a.tolist()], bool), np.array([count[t] > frequent for t in a.tolist()], bool), percent).tolist()) for a in arrays]
        assert all(sigs[a] & sigs[b] for a, b in pairs)
    n = np.array([len(s) for s in sets])
    label = ngram_join.parity_links(n, [ngram_join.parity_bits(a) for a in arrays], np.zeros(len(n), int), percent)
    assert all(label[a] == label[b] for a, b in pairs)


def test_percent_without_a_bound_is_refused(docs):
    with pytest.raises(ValueError, match="above 50"):
        ngram_join.jaccard_join(docs, percent=50)


def test_parity_bits_never_pass_over_a_link():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(1, 400))).astype(np.uint64)
        for _ in range(4):
            own = base[rng.random(len(base)) > rng.random() * 0.08]
            sets.append(frozenset([*own.tolist(), *rng.integers(0, 2**63, int(rng.integers(0, 1 + len(base) // 20))).tolist()]) or frozenset([7]))
    words = [ngram_join.parity_bits(np.array(sorted(s), np.uint64)) for s in sets]
    n, side = np.array([len(s) for s in sets]), np.arange(len(sets)) % 2 + 1
    pairs = linked_pairs(sets, 85)
    label = ngram_join.parity_links(n, words, np.zeros(len(n), int), 85)
    assert len(pairs) > 50 and all(label[a] == label[b] for a, b in pairs) and len(set(label.tolist())) > 50 and (label <= np.arange(len(n))).all()
    label = ngram_join.parity_links(n, words, side, 85)
    assert all(label[a] == label[b] for a, b in pairs if side[a] != side[b])


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_gaps_round_trip(width):
    rng = np.random.default_rng(width)
    for spread in (3, 300, 70_000, 2**33):
        values = np.unique(rng.integers(0, spread * 50, 40).astype(np.uint64)) + np.uint64(5 << 40)
        if spread * 60 // ((1 << 8 * width) - 1) < 10**6:
            assert (ngram_join.unpack_gaps(ngram_join.pack_gaps(values, 5 << 40, width), 5 << 40, width) == values).all()


def test_jaccard_hot_token(spark):
    """A third of all documents share most of their tokens, in different sets; the others are alone."""
    rng = np.random.default_rng(2)
    body = [f"s{k}" for k in range(60)]
    texts = {k: " ".join([*body[: 50 + k % 10], f"own{k}"] if k % 3 == 0 else [f"r{x}" for x in rng.integers(0, 10**9, 30)]) for k in range(600)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.jaccard_join(df, n=1, percent=85, block=50).collect()}
    assert got == brute_components(texts, 1, 85)


def test_near_duplicates_by_row(spark):
    a, b = ("the quick brown fox jumps over the lazy dog and runs away " * 2).strip(), "an entirely different text that no other row of this table has at all"
    rows = [(1, a, "x", 1), (5, a, "y", 2), (5, b, "z", 3), (None, a, "n", 4), (None, None, "n", 5), (7, "", "e", 6), (7, "", "e", 6), (5, b, "z", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string, row long")
    got = ngram_join.drop_near_duplicates(df)
    assert got.columns == df.columns
    kept = sorted((r["row"] for r in got.collect()))
    assert kept in ([1, 3, 5, 6, 6], [1, 5, 6, 6, 7])
    alone = spark.createDataFrame([(None, a, "x", 1), (None, a, "y", 2)], df.schema)
    assert ngram_join.drop_near_duplicates(alone).count() == 1 and ngram_join.drop_near_duplicates(df.limit(0)).count() == 0


def test_jaccard_odd(spark, odd, none):
    got = ngram_join.jaccard_join(odd).collect()
    assert len(got) == len(ODD) and sum(r.component_id == 1 for r in got) == 3
    assert ngram_join.jaccard_join(none).count() == 0
    assert sorted(r.doc_id for r in ngram_join.drop_near_duplicates(odd).collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6]


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 101), (7, 7)], "a long, b long")
    got = {r.v: r.root for r in connected_components(edges, Scratch(spark, "test")).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[103] == got[101] == 100


def test_mixing_odd(spark, odd, none):
    got = mix_plan(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert mix_plan(none).count() == 0 and mix_documents(odd).columns == odd.columns
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) < 4


def brute_top(rows, k, every):
    """(query_id, rank, vec_id, score), sorted: rows are (id, vector), repeated ones once."""
    dims = max([len(v) for _, v in rows], default=0)
    clamp = lambda x, low, high: min(max(x, low), high)
    rows = sorted({(i, tuple(clamp(math.floor(256 * x), -(2**53), 2**53) for x in [*v, *[0.0] * (dims - len(v))])) for i, v in rows})
    out = []
    for i, q in rows:
        if i % every == 0:
            found = sorted((-clamp(sum(a * b for a, b in zip(q, v, strict=True)), -(2**63), 2**63 - 1), j) for j, v in rows if (j, v) != (i, q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def top(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("query", F.lit(1))
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, **options).collect())


def test_topk_odd(spark):
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, []), (5, [0.25]), (5, [0.25]), (None, [1.0, 1.0]), (6, [-1.0, -1.0]), (100, [0.25, 0.0]), (100, [3.0, -1.0]), (7, [float("inf"), 0.0]), (8, [2.0, 1.0]), (8, [2.0, 1.5])]
    clean = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = top(spark, rows)
    assert got == brute_top(clean, 5, 50) and len([g for g in got if g[0] == 100]) == 10
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk.top_k(df.where("vec_id < 0")).count() == 0 and topk.top_k(df.where("embedding is null")).count() == 0
    assert top(spark, [(0, [1.0])]) == []


def test_topk_large_numbers(spark):
    rows = [(k, [3e7 * (k + 1), -3e7, 3e7, 1.0 * k]) for k in range(4)] + [(50, [1e300, 0.0, 0.0, 0.0]), (51, [1e-300, -1e300, 5e7, 1.0])]
    assert top(spark, rows, k=2) == brute_top(rows, 2, 50)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((5, 6)) * 2
    rows = [(k, np.round(centres[k % 5] + rng.standard_normal(6) * 0.3, 2).tolist()) for k in range(1500)]
    rows += [(2000 + k, [1.0, 1.0, 0.5, 0.0, 0.0, 0.25]) for k in range(800)]  # one vector of a third of all rows
    rows += [(k, rng.standard_normal(6).tolist()) for k in range(0, 200, 50)]  # ids that two rows have
    before = topk.BLOCK, topk.STEP, topk.QUERIES
    try:
        topk.BLOCK, topk.STEP, topk.QUERIES = 40, 8, 16
        assert top(spark, rows, pivots=7) == brute_top(rows, 5, 50)
    finally:
        topk.BLOCK, topk.STEP, topk.QUERIES = before


CHANGE = "op string, source string, lang string, tokenizer string, version string, n_tokens long, old_n_tokens long"


def test_token_counts(spark, tmp_path):
    store = RollupStore(spark, f"file://{tmp_path}/s")
    make = lambda *rows: spark.createDataFrame(list(rows), CHANGE).withColumn("docs", F.lit("x"))
    assert store.totals().count() == 0
    assert store.commit("a", make(("insert", "s", None, "t", "1", 5, None), ("insert", "s", None, "t", "1", None, None)))
    assert not store.commit("a", make(("insert", "s", None, "t", "1", 5, None)))
    assert store.commit("b", make(("revise", "s", None, "t", "1", 9, 5), ("delete", "s", None, "t", "1", 0, None)))
    assert store.compact()
    assert store.commit("c", make().limit(0)) and not store.commit("b", make())
    assert [tuple(r) for r in store.totals().collect()] == [("s", None, "t", "1", 1, 9)]
    with pytest.raises(Exception, match="unknown op"):
        store.commit("d", make(("no", "s", None, "t", "1", 5, None)))
    # to another language and version
    assert store.commit("e", make(("revise", "s", "en", "t", "2", 7, 9)).withColumn("old_lang", F.lit(None).cast("string")).withColumn("old_version", F.lit("1")))
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "t", "2", 1, 7)]
    assert store.vacuum(older_than_s=3600) == 0 and store.vacuum(older_than_s=-5) > 0 and store.vacuum(older_than_s=-5) == 0
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "t", "2", 1, 7)] and not store.commit("a", make())
    with pytest.raises(ValueError, match="rename"):
        refuse_replacing("s3a")


def test_rollups_against_plain_sums(spark, tmp_path, monkeypatch):
    """Random batches, some sent twice, against a dictionary; whole states come often."""
    from quireflow.llm import token_counts

    monkeypatch.setattr(token_counts, "STATE_EVERY", 3)
    rng, store, want, held = np.random.default_rng(5), RollupStore(spark, f"file://{tmp_path}/s"), {}, []
    for batch in range(8):
        rows = []
        for _ in range(int(rng.integers(0, 6))):
            g, n = ("s", str(rng.choice(["en", "de"])), "t", str(rng.integers(2))), int(rng.integers(1, 50))
            op = str(rng.choice(["insert", "delete", "revise"])) if held else "insert"
            if op == "insert":
                held.append((g, n))
                rows.append((op, *g, n, None, *g))
            else:
                was, old = held.pop(int(rng.integers(len(held))))
                if op == "delete":
                    rows.append((op, *was, old, None, *was))
                else:
                    held.append((g, n))
                    rows.append((op, *g, n, old, *was))
        df = spark.createDataFrame(rows, CHANGE + ", old_source string, old_lang string, old_tokenizer string, old_version string")
        assert store.commit(f"b{batch}", df) and not store.commit(f"b{batch}", df)
    for g, n in held:
        docs, tokens = want.get(g, (0, 0))
        want[g] = docs + 1, tokens + n
    assert {tuple(r)[:4]: tuple(r)[4:] for r in store.totals().collect()} == want


def test_token_counts_against_the_library(spark, docs):
    """The query's totals against the tokenizers library called on every text."""
    from tokenizers import Tokenizer

    want = {}
    for name, _, file in queries.TOKENIZERS:
        library = Tokenizer.from_file(vocabulary(file))
        for r in docs.collect():
            n, tokens = want.get((r.source, r.lang, name), (0, 0))
            want[r.source, r.lang, name] = n + 1, tokens + len(library.encode(r.text or "", add_special_tokens=False).ids)
    got = queries.op2_token_counts(spark, DATA).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in got} == want and len({r.version for r in got}) == 2


def test_count_tokens_odd(spark, odd, none):
    from quireflow.llm.token_counts import count_tokens

    three = [(n, k, vocabulary(f)) for n, k, f in queries.TOKENIZERS]
    got = count_tokens(odd.withColumn("counts", F.lit(1)), three).collect()
    e = [CachedEncoder(path, kind) for _, kind, path in three]
    assert [[c.n_tokens for c in r.counts] for r in got] == [[len(x.encode(r.text)) // 4 for x in e] for r in got] and len(got) == len(ODD)
    assert count_tokens(none, three).count() == 0


def test_urls(spark):
    urls = [None, "", "x", "http://", "http://A.Com/x?y", "http://com", "http://example.com/en/", "http://www.example.com/en/a", "http://a.www.example.com/en/", "http://notexample.com/en/", "ftp://x.net/es/#f", "http://x.net/fr", "http://x.org/a://b.net/es/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    want = [None, None, None, None, "com/", None, "example.com/en/", "www.example.com/en/", "www.example.com/en/", "com/", "net/es/", None, None]
    for most in (url_filter.MAX_BYTES, 1):  # one shard, and one for each few keys
        got = {r.page_id: r for r in url_filter.judge_urls(df, rules, max_bytes=most).collect()}
        assert [got[k].rule for k in range(len(urls))] == want
        assert [got[k].verdict for k in (6, 7, 10, 0)] == ["block", "allow", "block", "allow"]


def test_cascade_exact(spark):
    keys = spark.range(20000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = keys.where(F.crc32(F.col("key").cast("binary")) % 7 == 0)
    cascades = url_filter.build_cascades(keys, listed, Scratch(spark, "test"), max_bytes=1500)
    assert len(cascades) > 1 and max(len(c.levels) for c in cascades) > 1
    flagged = url_filter.listed_flags(keys.select("key", F.array("key").alias("ks")), "ks", cascades, "on")
    assert flagged.where(F.col("on")[0] != (F.crc32(F.col("key").cast("binary")) % 7 == 0)).count() == 0


def test_html(spark):
    model = html_main.default_model()
    wrong = total = 0
    for page, truth in html_main.training_pages(60, seed=321):
        found, own = html_main.labelled_blocks(page, truth)
        wrong, total = wrong + sum(a != b for a, b in zip(model.decode(found), own, strict=True)), total + len(own)
    assert wrong < 0.01 * total
    page = '<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></ul></nav><script>var a="<p>no</p>"</script><article><h1>A &amp; B</h1><p>One\n  two<br>three.<p>Four &copy; five.</article><div class="comments"><p>Nice one!</p></div><footer>&copy; x</footer>'
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p"), (5, "<" * 2000)], "page_id long, html string").withColumn("text", F.lit(0))
    got = {r.page_id: r for r in html_main.extract_pages(df, model=model).collect()}
    assert got[1].text == "A & B\nOne two three.\nFour © five." and got[1].n_chars == len(got[1].text) and got[2].text == got[3].text == "" and got[2].n_chars == 0


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = [(k, " ".join([*(word() for _ in range(40)), *(["vile", "rotten"][k % 2 :][:1] if k % 3 == 0 else []), *(word() for _ in range(20))])) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(df, labels).collect()}
    test = [k for k in got if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in got)
    assert sum(got[k].predicted == (k % 3 == 0) for k in test) >= 0.9 * len(test)
    assert {r.score for r in toxicity.score_documents(odd, labels.where("toxic = 0")).collect()} == {0.0} and toxicity.score_documents(none, labels).count() == 0


def test_pipeline(spark):
    docs, seen = spark.read.parquet(f"{DATA}/documents.parquet"), []
    names, scratch = docs.columns, Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = scratch.cut(stage(spark, docs, DATA), name)
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == names
        if name in ("toxicity", "near_duplicates"):
            assert docs.join(before, names, "left_anti").count() == 0
        if name == "near_duplicates":
            kept = {r.doc_id for r in docs.collect()}
            assert kept == {c for i, (_, c, _) in brute_components({r.doc_id: r.text for r in before.collect()}, 5, 80).items() if c == i}
    assert seen[0] > seen[1] > 0 and seen[2] > 0 and seen[4] >= seen[3] > 0


def test_clean_documents_by_join_equals_broadcast(spark):
    from quireflow.llm.quality import clean_documents

    shared, digits = "read our terms of use before you go on", str.maketrans("0123456789", "abcdefghij")
    own = lambda i, k: " ".join(f"w{i}x{k}y{j}".translate(digits) for j in range(8))
    rows = [(i, "\n".join([shared, *(own(i, k) for k in range(3))]), None if i % 5 == 0 else "web") for i in range(80)]
    rows += [(90, shared, "web"), (91, None, None), (92, "", "web"), (93, shared + "\n" + own(93, 0), "news"), (7, rows[7][1], "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_x", F.lit(1))
    by = [sorted(map(tuple, clean_documents(docs, broadcast_lines=n).collect()), key=str) for n in (1000, 0)]
    assert by[0] == by[1]
    assert len(by[0]) == 82 and all(shared not in r[1] for r in by[0] if r[2] == "web")
