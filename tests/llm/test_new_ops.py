"""Chunked SentencePiece encoding, the filter audit and the conversation trie against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.llm import filter_audit, ngram_join, prefix_trie, queries, sentence_pieces, url_filter
from quireflow.llm.common import Scratch
from quireflow.llm.tokens import vocabulary

DATA = "/root/testdata/sf0.001"
MODEL = "piece_bpe_32k.model"
CLASH = "_conv _depth _part _n n id text_key part doc ids decoded level block hi lo pos key h own head run sha A E good toxic quality".split()


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def clashing(df):
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASH) if c not in df.columns))


# --- encoding by distinct chunks -------------------------------------------------------------------------------------------

PARTS = [*" \n▁\t\r\x0bab<>s0x0A漢😀é​ ￿\x00ﬁ½'.,", "  ", "▁▁", "<s>", "</s>", "<0x0A>", "<unk>", "the", " of", "　", " " * 20]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["", " ", "\n", "▁", " \n", *("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n))]


def test_chunks_are_the_librarys(spark):
    segmenter = sentence_pieces.Segmenter(vocabulary(MODEL))
    for text in odd_texts(3000, 1):
        chunks = sentence_pieces.chunks_of(text)
        assert not text or "".join(chunks) == " " + text.replace("▁", " ")
        got = np.frombuffer(b"".join(map(segmenter.ids, chunks)), "<i4")
        assert got.tolist() == segmenter.library.encode(text)
        assert segmenter.decode(got) == segmenter.library.decode(got.tolist())
    rng = random.Random(2)
    for _ in range(2000):  # ids that no text has: parts of characters, control ids, bytes that are spaces
        ids = [rng.choice([0, 1, 2, *range(3, 300), *range(29000, 29100)]) for _ in range(rng.randint(0, 8))]
        assert segmenter.decode(np.array(ids, np.int64)) == segmenter.library.decode(ids)


@pytest.mark.parametrize("most", [sentence_pieces.MOST_CHUNKS, 40, 0])
def test_documents_are_encoded_as_the_library_does(spark, most):
    """With all chunks in the table, with few, and with none."""
    held = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + odd_texts(300, 3) + [None, "x" * 200_000, "long words here " * 30_000]
    held = [(None if k % 50 == 0 else k // 2, t) for k, t in enumerate(held)]
    library = sentence_pieces.Segmenter(vocabulary(MODEL)).library
    want = sorted(((i, t, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in held), key=str)
    df = clashing(spark.createDataFrame(held, "doc_id long, text string"))
    out = sentence_pieces.encode_documents(df, vocabulary(MODEL), most=most)
    got = out.collect()
    assert sorted(((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in got), key=str) == want
    assert all(r[c] == k for r in got for k, c in enumerate(CLASH) if c not in ("ids", "decoded", "text"))
    again = sentence_pieces.decode_documents(out.select("doc_id", "ids"), vocabulary(MODEL)).collect()
    assert sorted((r.doc_id, tuple(r.ids), r.decoded) for r in again if r.doc_id) == sorted((i, a, d) for i, _, a, d in want if i)
    assert sentence_pieces.encode_documents(df.limit(0), vocabulary(MODEL)).count() == 0


def test_each_chunk_is_in_the_table_once(spark):
    df = spark.createDataFrame([("a b b c c c\nd\nd " + "z" * 49,), ("b c " + "z" * 49,), (None,), ("",)], "text string").repartition(3)
    counts = {r.chunk: r.n for r in sentence_pieces.chunk_counts(df).collect()}
    assert counts == {" a": 1, " b": 3, " c": 4, "\nd": 2}
    table = sentence_pieces.chunk_table(sentence_pieces.chunk_counts(df), vocabulary(MODEL), Scratch(spark, "test"))
    assert sorted(table["chunk"].to_pylist()) == ["\nd", " b", " c"]
    assert sentence_pieces.chunk_table(sentence_pieces.chunk_counts(df), vocabulary(MODEL), Scratch(spark, "test"), most=2).num_rows == 2


def test_digests(spark):
    got = queries.QUERIES["op11_sentencepiece"](spark, DATA).collect()
    library = sentence_pieces.Segmenter(vocabulary(MODEL)).library
    held = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(got) == len(held)
    for r in got:
        ids = library.encode(held[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


# --- filter audit ----------------------------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    """docs: doc_id, text, lang; labels: doc_id -> (quality, toxic). Every order is run."""
    rows = []
    for k, (i, text, lang) in enumerate(docs):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text)}
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        rows.append((lang or "", {f for f, x in fails.items() if x}, *labels.get(i, (0, 0))))
    out = {}
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                failing = [r for r in mine if f in r[1]]
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, labels):
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    own = clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = filter_audit.audit_documents(df, own).collect()
    assert len(got) == len({(r.part, r.filter_order, r.step) for r in got})
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}


def test_audit_against_all_orders(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4)) + rng.choice(["", "", "", "", "", "", "#", "B", "É"])
    texts = [None, "", " ", "A", "# b", *(" ".join([word() for _ in range(rng.choice([3, 199, 200, 201]))] + ["same"] * rng.choice([0, 300])) for _ in range(40))]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(300)]
    docs += [(7, "twice", "fr"), (7, "twice", "fr"), (9, "twice", "es"), (4, "very long " * 40_000, "long")]
    labels = {k: (rng.randint(0, 1), rng.randint(0, 1)) for k in range(0, 60, 2)}
    held = [(k, *v) for k, v in labels.items()] + [(None, 1, 1), (61, None, None), (2, 0, None), (999, 1, 1)]
    assert audited(spark, docs, held) == plain_audit(docs, labels)


def test_audit_of_nothing_and_of_one(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [(1, None, None)], []) == plain_audit([(1, None, None)], {})


def test_audit_of_a_hot_text_is_a_row_a_part(spark):
    """A text that a third of all documents have reaches the comparison as one row for each part."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.col("id").cast("string")).alias("text"), (F.col("id") % 2).cast("string").alias("lang"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scratch = Scratch(spark, "test")
    counts = {(r.part, r.E): r.n for r in filter_audit.flagged_counts(docs, none, scratch).collect()}
    assert counts == {("0", False): 1001, ("0", True): 499, ("1", False): 1000, ("1", True): 500}
    assert spark.read.parquet(scratch.held["texts"]).where("n > 1").count() == 2


def test_audit_has_no_python_on_executors(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = filter_audit.audit(filter_audit.flagged_counts(df, spark.read.parquet(f"{DATA}/labels.parquet"), Scratch(spark, "test")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- conversation trie -----------------------------------------------------------------------------------------------------


def plain_trie(rows):
    """rows: conv_id, turn, role, text. Nodes as a set of rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    turns = {c: [t for _, t in sorted(xs)] for c, xs in own.items()}
    built = {}
    for c, xs in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(int(c - np.fmod(c, 5)), [])[:h] + xs[h:])
    members = {}
    for c, xs in built.items():
        for d in range(len(xs) + 1):
            members.setdefault(xs[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p], sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)))) for p, m in members.items())


def nodes_of(df, **options):
    out = prefix_trie.trie_nodes(df, **options)
    assert all(t == "bigint" for c, t in out.dtypes if c != "ends_sha256")
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out.collect())


def some_turns(seed, convs, kinds):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 4 * convs), convs):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]) if kinds > 2 else "user", rng.choice(["", None, "é", "x", "yes 漢"][:kinds])))
    return rows


@pytest.mark.parametrize(("seed", "convs", "kinds"), [(1, 60, 5), (2, 200, 2), (3, 120, 1)])
def test_trie_against_plain(spark, seed, convs, kinds):
    rows = some_turns(seed, convs, kinds)
    rows += [(None, 1, "user", "x"), (7000, 3, "user", "twice"), (7000, 3, "user", "twice"), (7000, 3, "assistant", "a tie"), (10**12, 0, "", "far " * 50_000)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = plain_trie(rows)
    assert nodes_of(df) == want
    # small blocks, partial tries, merges of two, and lists of ends that are set aside at once
    monkey = prefix_trie.BLOCK
    try:
        prefix_trie.BLOCK = 3
        assert nodes_of(df.repartition(9), local_rows=7, fan=2, most_ends=3) == want
    finally:
        prefix_trie.BLOCK = monkey


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert nodes_of(spark.createDataFrame([], schema)) == [] and nodes_of(spark.createDataFrame([(None, 1, "a", "b")], schema)) == []
    rows = [(c, 0, "user", "x") for c in range(1, 40) if c % 5]  # no family has its first conversation
    assert nodes_of(spark.createDataFrame(rows, schema)) == plain_trie(rows)


def test_trie_of_a_long_conversation(spark):
    """Turns of one conversation lie in many blocks."""
    rows = [(5, t, "user", str(t % 3)) for t in range(3000)] + [(6, t, "user", str(t % 3)) for t in range(900)]
    assert nodes_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) == plain_trie(rows)


# --- bounded filters -------------------------------------------------------------------------------------------------------


def test_no_level_of_a_cascade_outgrows_its_bound(spark):
    """The universe grows a hundredfold; every level stays within the bound, and membership exact."""
    listed = spark.createDataFrame([(f"listed {k}",) for k in range(40)], "key string")
    for n, most in ((2_000, 256), (20_000, 256), (200_000, 256), (20_000, 64)):
        universe = spark.range(n).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("key"))
        cascades = url_filter.build_cascades(universe, listed, Scratch(spark, "test"), most)
        assert cascades and all(x.nbytes <= most for c in cascades for x in c.levels) and len({c.shards for c in cascades}) == 1
        keys = universe.unionByName(listed).select(F.array("key").alias("keys"), F.startswith("key", F.lit("listed")).alias("want"))
        assert url_filter.listed_flags(keys, "keys", cascades, "on").where(F.col("on")[0] != F.col("want")).count() == 0
    one = url_filter.build_cascades(spark.range(400_000).select(F.col("id").cast("string").alias("key")), spark.createDataFrame([(f"x{k}",) for k in range(5)], "key string"), Scratch(spark, "test"), 1024)
    assert len(one) == 1 and sum(x.nbytes for x in one[0].levels) < 200


# --- token classes on several levels -----------------------------------------------------------------------------------------


def test_rows_per_token_stay_the_same():
    """From the size that has two levels to 4096 times it; a chunk's worth of tokens is never dealt to more than 1 << LEVEL_BITS rows a level."""
    for times in (1, 4, 64, 4096, 1 << 20):
        size = (4 << 30) * times
        layout = ngram_join.Layout.of(size // 3000, size)
        assert max(layout.levels) <= ngram_join.LEVEL_BITS and sum(layout.levels) <= layout.bits
        tokens = size // ngram_join.TOKEN_BYTES
        per_level = tokens / layout.rows() * len(layout.levels)
        assert per_level > 1500, (times, layout)


@pytest.mark.parametrize(("level_bits", "part_tokens", "chunk"), [(2, 600, 40_000), (1, 4000, 5_000), (3, 50, 10**9)])
def test_levels_give_the_classes_of_one_level(spark, monkeypatch, level_bits, part_tokens, chunk):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(F.col("doc_id").alias("row"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0]
    monkeypatch.setattr(ngram_join, "CHUNK_BYTES", chunk)
    one = ngram_join.Layout.of(200, size, 60, 10**9)
    deep = ngram_join.Layout.of(200, size, level_bits, part_tokens)
    assert len(one.levels) == 1 and len(deep.levels) > 2 and deep.chunk_shift == one.chunk_shift and deep.bits == one.bits
    found = []
    for layout in (one, deep):
        held = {}
        for r in ngram_join.token_classes(docs, 5, 3, layout, Scratch(spark, "test")).collect():
            for k in ("shared", "often"):
                held.setdefault((r.unit, k), []).append((r.part, ngram_join._unpacked(r[k], r.n).tolist()))
        found.append({k: [b for _, bits in sorted(v) for b in bits] for k, v in held.items()})
    assert found[0] == found[1] and any(any(v) for v in found[0].values())


def test_join_on_several_levels(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = sorted(map(tuple, ngram_join.jaccard_join(docs).collect()))
    monkeypatch.setattr(ngram_join, "LEVEL_BITS", 2)
    monkeypatch.setattr(ngram_join, "PART_TOKENS", 1000)
    monkeypatch.setattr(ngram_join, "CHUNK_BYTES", 50_000)
    assert sorted(map(tuple, ngram_join.jaccard_join(docs).collect())) == want


# --- SQL -------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_prefix_trie"])
def test_sql_twins(spark, name):
    got = queries.QUERIES[name](spark, DATA)
    with duckdb.connect() as con:
        for t in ("documents", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        rel = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})")
        assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r)) for r in got.collect())
