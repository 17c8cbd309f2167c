"""The registered queries over the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm.common import Scratch, n_words
from quireflow.llm.filter_audit import audit_documents
from quireflow.llm.html_main import extract_pages
from quireflow.llm.mixing import mix_plan
from quireflow.llm.ngram_join import jaccard_join
from quireflow.llm.packing import pack_documents
from quireflow.llm.prefix_trie import trie_nodes
from quireflow.llm.quality import judge_documents
from quireflow.llm.sentence_pieces import digest
from quireflow.llm.token_counts import GROUP, RollupStore, count_tokens
from quireflow.llm.token_orc import token_ids_digest
from quireflow.llm.tokens import vocabulary
from quireflow.llm.topk import top_k
from quireflow.llm.toxicity import score_documents
from quireflow.llm.url_filter import judge_urls

#: The rules of op1: rule, verdict.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


#: The tokenizers of op2: name, kind, vocabulary file.
TOKENIZERS = [("byte_bpe_50k", "byte", "byte_bpe_50k.json"), ("word_bpe_49k", "word", "word_bpe_49k.json")]


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents by source, language, tokenizer and version.

    Loads them, loads them again (which changes nothing), moves documents of fewer than 10 words to the language ``und`` (a
    revision into another group), withdraws those, puts them back, and moves them back to their own language. So all documents
    are in the totals, each in its own group.
    """
    scratch = Scratch(spark, "token-counts")
    store = RollupStore(spark, scratch.path("store"))
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text")
    counted = count_tokens(docs, [(name, kind, vocabulary(file)) for name, kind, file in TOKENIZERS])
    lean = counted.select("source", "lang", (n_words(F.col("text")) < 10).alias("short"), F.explode("counts").alias("c")).select("source", "lang", "short", "c.*")
    lean = scratch.cut(lean, "counts")
    store.commit("load", load := lean.withColumn("op", F.lit("insert")))
    store.commit("load", load)
    moved = lean.where("short").withColumn("old_lang", F.col("lang")).withColumn("lang", F.lit("und"))
    store.commit("short", moved.withColumn("op", F.lit("revise")).withColumn("old_n_tokens", F.col("n_tokens")))
    store.commit("withdraw", moved.withColumn("op", F.lit("delete")))
    store.commit("restore", moved.withColumn("op", F.lit("insert")))
    store.commit("back", lean.where("short").withColumns({"old_lang": F.lit("und"), "op": F.lit("revise"), "old_n_tokens": F.col("n_tokens")}))
    out = store.totals().select(*GROUP, F.col("docs").alias("n_docs"), F.col("tokens").alias("n_tokens"))
    return scratch.finish(out)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), kind="byte", capacity=2048, end_id=0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), kind="word", end_id=2)


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(table(spark, sf_dir, "conversations"))


OP1_SQL = r"""
WITH rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
r AS (SELECT rule, verdict, regexp_extract(rule, '^[^/]*') AS h, substr(rule, length(regexp_extract(rule, '^[^/]*')) + 1) AS p FROM rules),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM u),
m AS (
  SELECT q.n, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM q JOIN r ON (q.host = r.h OR ends_with(q.host, '.' || r.h)) AND starts_with(q.path, r.p) GROUP BY q.n
)
SELECT q.page_id, q.host, q.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM q LEFT JOIN m USING (n)
"""

OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT n, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, unnest(range(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) AS i FROM d),
g AS (
  SELECT n, i, word, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN
    word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o END AS gram
  FROM w WINDOW o AS (PARTITION BY n ORDER BY i)
), t AS (SELECT n, i, word, gram IS NOT NULL AND count(*) OVER (PARTITION BY n, gram) > 1 AS twice FROM g),
c AS (SELECT n, word, bool_or(twice) OVER (PARTITION BY n ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM t),
m AS (SELECT n, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars, count(*) FILTER (hit) AS n_repeat_words FROM c GROUP BY n),
l AS (SELECT n, source, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
x AS (
  SELECT n, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY n, line ORDER BY i) AS copy,
    trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM l
), f AS (SELECT source, plain, count(DISTINCT text) AS docs FROM x WHERE words > 0 GROUP BY source, plain HAVING count(DISTINCT text) > 10),
h AS (SELECT source, count(DISTINCT text) AS all_docs FROM d GROUP BY source),
b AS (SELECT f.source, f.plain FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source WHERE docs > all_docs * 0.02::DOUBLE),
y AS (
  SELECT x.n, count(*) FILTER (copy > 1 AND words > 0) AS n_dup_lines, coalesce(CAST(sum(words) FILTER (b.plain IS NULL) AS BIGINT), 0) AS words_left
  FROM x LEFT JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.plain = b.plain AND x.words > 0 GROUP BY x.n
), z AS (
  SELECT d.doc_id, coalesce(m.n_words, 0) AS n_words, coalesce(m.word_chars, 0) AS word_chars, CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    y.n_dup_lines, coalesce(m.n_repeat_words, 0) AS n_repeat_words, y.words_left
  FROM d LEFT JOIN m USING (n) JOIN y USING (n)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 0.2::DOUBLE * n_words AS kept
FROM z
"""

OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT a AS v, a AS u FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.u = e.a),
m AS (SELECT v, min(u) AS root FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, (SELECT count(*) FROM e WHERE e.a = d.doc_id) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.v = d.doc_id
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), k AS (SELECT *, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INT) + 1] AS w FROM s),
c AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS due,
    coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS caps,
    sum(w) OVER (ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
  FROM w
), f AS (SELECT *, 2.0::DOUBLE * source_size * rest_w <= w * (due - caps) AS capped FROM c),
l AS (SELECT (due - caps) / rest_w AS level FROM f WHERE NOT capped ORDER BY source_size / w, source IS NULL, source LIMIT 1),
t AS (SELECT source, source_size, CAST(CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE w * (SELECT level FROM l) END AS DOUBLE) AS target FROM f),
b AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs, CAST(floor(target) AS BIGINT) AS budget FROM t
), r AS (
  SELECT k.doc_id, k.source, k.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target, CAST(epochs * size + least(size, greatest(rest - earlier, 0)) AS BIGINT) AS taken FROM r
"""

OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT a.vec_id AS query_id, a.q AS asked, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id OR a.q <> b.q WHERE a.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12_SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda k: CASE k
    WHEN 'A' THEN len(d.w) < 200
    WHEN 'B' THEN 100 * len(list_distinct(d.w)) < 50 * len(d.w)
    WHEN 'C' THEN 100 * (length(d.text) - length(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(d.text)
    WHEN 'D' THEN regexp_matches(d.text, '[#$%&*|]')
    ELSE coalesce(d.doc_id > m.least, false) END) AS fails
  FROM d JOIN m USING (text) LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT CAST('' AS VARCHAR) AS filter_order UNION ALL SELECT o.filter_order || k.k FROM o JOIN k ON strpos(o.filter_order, k.k) = 0),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS k, string_split(left(filter_order, step - 1), '') AS before
  FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o WHERE length(filter_order) = 5)
), r AS (
  SELECT c.part, s.filter_order, s.step, s.k,
    sum(CASE WHEN NOT list_has_any(c.fails, s.before) AND NOT list_contains(c.fails, s.k) THEN c.n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT list_has_any(c.fails, s.before) AND list_contains(c.fails, s.k) THEN c.n ELSE 0 END) AS removed,
    sum(CASE WHEN list_has_any(c.fails, s.before) AND list_contains(c.fails, s.k) THEN c.n ELSE 0 END) AS redundant,
    sum(CASE WHEN c.fails = [s.k] THEN c.n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT list_has_any(c.fails, s.before) AND list_contains(c.fails, s.k) THEN c.good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT list_has_any(c.fails, s.before) AND list_contains(c.fails, s.k) THEN c.toxic ELSE 0 END) AS toxic_lost
  FROM c CROSS JOIN s GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM r
"""

# crc32 of a decimal number, bit by bit; nodes are lists of digests of turns
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(bytes ORDER BY turn NULLS FIRST, key) AS sizes,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::BIGINT)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM t GROUP BY conv_id
), b AS (
  SELECT c.conv_id, coalesce(f.keys[1:c.h], []) || c.keys[c.h + 1:] AS keys, coalesce(f.sizes[1:c.h], []) || c.sizes[c.h + 1:] AS sizes
  FROM c LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 5
), p AS (SELECT conv_id, keys, sizes, unnest(range(len(keys) + 1)) AS depth FROM b),
q AS (SELECT conv_id, depth, keys[1:depth] AS node, CASE WHEN depth > 0 THEN keys[1:depth - 1] END AS parent, CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS bytes, depth = len(keys) AS ends FROM p),
n AS (
  SELECT node, any_value(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM q GROUP BY node
), k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
u AS (SELECT node, own, CAST(n_children = 0 AS BIGINT) AS leaf, unnest(range(depth + 1)) AS up FROM m),
s AS (SELECT node[1:up] AS node, sum(own) AS saved_tokens, sum(leaf) AS n_leaves FROM u GROUP BY 1)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, x.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s USING (node) LEFT JOIN m x ON m.depth > 0 AND x.node = m.parent
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_token_orc": op6_token_orc,
    "op7_html_main": op7_html_main,
    "op8_ngram_join": op8_ngram_join,
    "op9_mixing": op9_mixing,
    "op10_topk": op10_topk,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op5_quality": OP5_SQL, "op8_ngram_join": OP8_SQL, "op9_mixing": OP9_SQL, "op10_topk": OP10_SQL, "op12_filter_audit": OP12_SQL, "op13_prefix_trie": OP13_SQL}
