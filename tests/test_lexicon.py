"""Segmentation under a whole lexicon against a plain split, lexicons in shards, and long words."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.operators import backends as B
from quireflow.operators import direction as D
from quireflow.plans import catalogue
from quireflow.tables import Tables

DATA = "/root/testdata/sf0.001"


def plain_split(text, lexicon, total):
    """(log-likelihood, words), by trying all words that end at each place; of equal ones the shorter last word."""
    longest = max(map(len, lexicon), default=1)
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        ways = [(best[at][0] + math.log(max(lexicon.get(text[at:end], 0.0), 0.01) / total), at) for at in range(max(0, end - longest), end) if end - at == 1 or text[at:end] in lexicon]
        best.append(max(ways))
    words, end = [], len(text)
    while end:
        words.append(text[best[end][1] : end])
        end = best[end][1]
    return (best[-1][0] if text else -100.0), words[::-1]


def same(got, want):
    assert got[1] == want[1] and got[0] == pytest.approx(want[0], abs=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_splits_against_a_plain_program(seed):
    rng = np.random.default_rng(seed)
    word = lambda n: "".join(rng.choice(list("ab漢\U0001f600"), n))
    lexicon = {word(rng.integers(1, 20)): float(rng.integers(0, 90)) for _ in range(60)} | {word(2): 3.0 for _ in range(10)}
    total = sum(lexicon.values())
    keys = list(lexicon)
    texts = ["", "x", *("".join(rng.choice([*keys, "a", "x"], rng.integers(0, 12))) for _ in range(150))]
    tries = [D.Trie.of(lexicon, total)]
    scores, words = D.best_splits(texts, tries, total, words=True)
    half = [D.Trie.of({w: lexicon[w] for w in keys[k::2]}, total) for k in range(2)]
    again = D.best_splits(texts, half, total, words=True)
    assert (scores, words) == again
    for text, s, w in zip(texts, scores, words, strict=True):
        same((s, w), plain_split(text, lexicon, total))


def test_words_of_any_length_are_found():
    long = "verylongwordofmorethantwelvecharacters"
    lexicon = {long: 5.0, "very": 5.0}
    assert D.segment_dictionary(f"x{long}very", lexicon, 10.0) == ["x", long, "very"]
    judge = D.Judge(lexicon)
    assert judge.fix_text(long[::-1]) == long and judge.fix_text("") == ""
    empty = D.Judge({})
    assert empty.fix_text("ab\n\nc") == "ab\n\nc" and empty.log_likelihood("") == -100.0


def test_lines_of_documents_against_a_plain_program(spark):
    """The registered query, whole lexicon, every line."""
    got = {(r.doc_id, r.line_no): r for r in catalogue.QUERIES["lexicon_segmentation"](spark, DATA).collect()}
    lexicon = {r.token: float(r.freq) for r in catalogue.lexicon(spark, DATA).collect()}
    total = sum(lexicon.values())
    lines = catalogue.doc_lines(spark, DATA).collect()
    assert len(got) == len(lines) and max(map(len, lexicon)) > 12
    for r in lines[::7]:
        score, words = plain_split(r.line, lexicon, total)
        own = got[r.doc_id, r.line_no]
        assert own.words == words and own.n_words == len(words) and own.loglik == pytest.approx(score, abs=1e-5)


@pytest.mark.parametrize("most", [10**6, 7])
def test_shards_and_odd_rows(spark, most):
    lexicon = {"the": 50.0, "cat": 20.0, "sat": 20.0, "thecat": 1.0, "é漢": 4.0, "and": 30.0, "a": 2.0, **{f"w{k}": 1.0 for k in range(40)}}
    table = spark.createDataFrame([*lexicon.items(), ("", 1.0), (None, None)], "token string, freq double")
    total = sum(lexicon.values()) + 1.0
    texts = [None, "", "a", "thecatsat", "é漢é漢x", "w1w22w39 and", "the\nend", "q" * 5000, "thecatsat"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, t string").withColumn("words_", F.lit(1))
    for r in D.segment_lines(df, "t", table, most).collect():
        if r.t is None:
            assert r.words is None and r.loglik is None
        else:
            same((r.loglik, r.words), plain_split(r.t, lexicon, total))
    assert D.segment_lines(df.limit(0), "t", table, most).count() == 0
    assert D.segment_lines(df, "t", table.limit(0), most).count() == len(texts)


def test_blocks_by_table_are_those_by_broadcast(spark):
    lexicon = {"the": 50.0, "cat": 20.0, "sat": 20.0, "on": 9.0}
    block = lambda label, w, h, content: {"label": label, "x1": 0, "y1": 0, "x2": w, "y2": h, "content": content}
    rows = [(1, [block("text", 9, 2, "taceht\nthecat\n\nx"), block("table", 9, 2, "taceht"), block("doc_title", 9, 2, "ehttas"), block("text", 2, 9, "taceht"), block(None, 9, 2, "taceht"), block("text", 9, 2, "")]), (2, []), (3, None), (1, [block("text", 9, 2, "taceht")])]
    df = spark.createDataFrame(rows, f"id int, blocks {B.BLOCKS}")
    words = spark.createDataFrame(list(lexicon.items()), "token string, freq double")
    said = lambda out: sorted(str((r.id, r.blocks and [(b.label, b.content) for b in r.blocks])) for r in out.collect())
    want = said(D.fix_direction(df, "blocks", D.Judge(lexicon)))
    assert said(D.fix_direction_by_table(df, "blocks", words, Tables(spark, "test"))) == want == said(D.fix_direction_by_table(df, "blocks", words, Tables(spark, "test"), most=2))
    assert any("thecat\\\\nthecat" in x or "thecat\\nthecat" in x for x in want)


def test_a_lexicon_that_is_listed_twice(spark, tmp_path):
    (tmp_path / "w.txt").write_text("the 50 x\ncat 20\nthe 7\nbroken\nbad x\n")
    assert D.read_lexicon(spark, str(tmp_path / "w.txt")) == {"the": 7.0, "cat": 20.0}


def test_shards_are_mapped_and_no_match_is_carried(spark, tmp_path):
    """Workers read tries from files that they share, and rows hold no column of matches, however many shards there are."""
    table = spark.createDataFrame([(f"w{k}", 1.0 + k) for k in range(50)], "token string, freq double")
    df = spark.createDataFrame([(k, f"w{k}w{k + 1}" * (1 + 7 * (k % 3))) for k in range(30)], "id int, t string")
    out, one = D.segment_lines(df, "t", table, most=9), D.segment_lines(df, "t", table)
    assert "_found" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, one.collect()))
    trie = D.mapped(D.send(spark, D.Trie.of({"ab": 2.0, "b": 1.0}, 3.0)))
    assert isinstance(trie.keys, np.memmap) and D.best_splits(["abb"], [trie], 3.0, words=True)[1] == [["ab", "b"]]
