"""Filter interaction audit: what each order of filters keeps, removes and loses, from one CUBE over failure flags.

The documents are first counted by part and flags (32 rows a part at most). A CUBE over the flags and the part then gives,
in the row of a grouping set whose selected flags are all false, the documents that survive just these filters. A step of an
order of filters goes from one set of filters to the set with one more, so every figure of a step is a difference of two
survivors' rows: orders are joined with both, and nothing is counted again for an order.

Everything is DataFrame operations: no Python on the executors.

Defined cases: a null text is empty; a null part is the empty string. The copy filter compares digests of whole texts: a
document fails it if a smaller id has the same text, so rows that share id and text don't fail because of each other, and a
null id neither fails nor makes others fail. A document is good or toxic if one of its labels says so; null ids have no
labels. Repeated rows count each. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import WORD, Scratch, n_words

#: Letters of the five filters, in the order of their flags.
FILTERS = "ABCDE"
#: The last filter of FILTERS is the copy filter, of which the table as a whole decides.
COPY = FILTERS[-1]
CAPITALS = "".join(map(chr, range(65, 91)))


def text_flags(text: Column) -> dict[str, Column]:
    """Failure flags that a text decides by itself."""
    words = n_words(text)
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({WORD})"))))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {"A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 3 * F.length(text), "D": text.rlike("[#$%&*|]")}


def flagged_counts(docs: DataFrame, labels: DataFrame, scratch: Scratch, part: str = "lang") -> DataFrame:
    """part, A..E (booleans), n, good, toxic: documents by part and failure flags.

    Copies share their text, hence all flags but the copy filter's. So documents are summed by text, part and flags, with the
    sums of the smallest id beside them, and only these rows are compared: a text that a third of all documents have is a row
    for each part.
    """
    named = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(*(F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long")).alias(f"_{c}") for c in ("quality", "toxic")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lean = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"), *(c.alias(k) for k, c in text_flags(text).items()))
    rows = lean.join(named, F.col("id") == F.col("_id"), "left").select(*lean.columns, F.coalesce("_quality", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic"))
    own = ["text_key", "part", *FILTERS[:-1]]
    sums = lambda *names: [F.sum(c).alias(c) for c in names]
    by_id = rows.groupBy(*own, "id").agg(F.count(F.lit(1)).alias("n"), *sums("good", "toxic"))
    held = F.struct("n", "good", "toxic")
    free = F.col("id").isNull()
    by_text = by_id.groupBy(*own).agg(
        F.min("id").alias("least"), F.min_by(held, F.col("id")).alias("first"),
        *(F.coalesce(F.sum(F.when(free, F.col(c))), F.lit(0)).alias(f"free_{c}") for c in ("n", "good", "toxic")), *sums("n", "good", "toxic"),
    )
    both = scratch.cut(by_text, "texts")
    over = both.groupBy(F.col("text_key").alias("_key")).agg(F.min("least").alias("_least"))
    met = both.join(over, F.col("text_key") == F.col("_key"))
    mine = F.coalesce(F.col("least") == F.col("_least"), F.lit(False))
    passed = {c: F.col(f"free_{c}") + F.when(mine, F.col(f"first.{c}")).otherwise(F.lit(0)) for c in ("n", "good", "toxic")}
    sides = F.array(F.struct(F.lit(False).alias(COPY), *(v.alias(c) for c, v in passed.items())), F.struct(F.lit(True).alias(COPY), *((F.col(c) - v).alias(c) for c, v in passed.items())))
    out = met.select("part", *FILTERS[:-1], F.explode(sides).alias("s")).select("part", *FILTERS[:-1], "s.*").where("n > 0")
    return out.groupBy("part", *FILTERS).agg(*sums("n", "good", "toxic"))


def survivors(counts: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents that fail none of the filters in the mask (bit 16 is the first filter), from a CUBE over part and flags. A mask that nothing survives has no row."""
    cube = counts.cube("part", *FILTERS).agg(F.grouping_id().alias("gid"), *(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    # bits of grouping_id are set for the columns that are not selected; the part's is the highest
    none_fails = F.lit(True)
    for k in FILTERS:
        none_fails = none_fails & ~F.coalesce(F.col(k), F.lit(False))
    return cube.where((F.col("gid") < 32) & none_fails).select("part", (31 - F.col("gid")).cast("int").alias("mask"), "n", "good", "toxic")


def bit(letter: str) -> int:
    return 16 >> FILTERS.index(letter)


def order_steps() -> list[tuple]:
    """filter_order, step, its filter's bit, and the masks before and after it, for all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            out.append(("".join(order), step, bit(letter), before, before | bit(letter)))
            before |= bit(letter)
    return out


def audit(counts: DataFrame) -> DataFrame:
    """A row per part, order and step, of ``flagged_counts``."""
    alive = survivors(counts)
    parts = alive.where("mask = 0").select("part")
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(x).alias("before"), F.lit(y).alias("after")) for o, s, b, x, y in order_steps()))
    grid = parts.select("part", F.explode(steps).alias("s")).select("part", "s.*")

    def join(df: DataFrame, mask: Column, name: str) -> DataFrame:
        """With the survivors of a mask, zero if there is no row of them."""
        side = alive.select(F.col("part").alias("_part"), F.col("mask").alias("_mask"), *(F.col(c).alias(f"_{c}") for c in ("n", "good", "toxic")))
        out = df.join(side, (F.col("part") == F.col("_part")) & (mask == F.col("_mask")), "left")
        return out.select(*df.columns, *(F.coalesce(f"_{c}", F.lit(0)).alias(f"{name}_{c}") for c in ("n", "good", "toxic")))

    # pairs of sets that differ by one filter: what the filter removes after others, over all orders
    pairs = F.array(*(F.struct(F.lit(b).alias("bit"), F.lit(m).alias("without"), F.lit(factorial(m.bit_count()) * factorial(4 - m.bit_count())).alias("orders")) for b in map(bit, FILTERS) for m in range(32) if not m & b))
    shares = parts.select("part", F.explode(pairs).alias("s")).select("part", "s.*")
    shares = join(join(shares, F.col("without"), "a"), F.col("without").bitwiseOR(F.col("bit")), "z")
    gone = F.col("a_n") - F.col("z_n")
    own = shares.groupBy("part", "bit").agg(F.sum(gone * F.col("orders")).alias("shapley"), F.sum(F.when(F.col("without") == 0, gone)).alias("fails"), F.sum(F.when(F.col("without") == 31 - F.col("bit"), gone)).alias("unique_fails"))
    rows = join(join(grid, F.col("before"), "a"), F.col("after"), "z")
    rows = rows.join(own.withColumnsRenamed({"part": "_part", "bit": "_bit"}), (F.col("part") == F.col("_part")) & (F.col("bit") == F.col("_bit")))
    figures = {"kept": F.col("z_n"), "removed": gone, "redundant": F.col("fails") - gone, "unique_fails": F.col("unique_fails"), "good_lost": F.col("a_good") - F.col("z_good"), "toxic_lost": F.col("a_toxic") - F.col("z_toxic"), "shapley": F.col("shapley")}
    return rows.select("part", "filter_order", F.col("step").cast("int").alias("step"), *(c.cast("long").alias(k) for k, c in figures.items()))


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of documents and their labels (doc_id, quality, toxic)."""
    scratch = Scratch(docs.sparkSession, "audit")
    counts = scratch.cut(flagged_counts(docs, labels, scratch, part), "counts")
    return scratch.finish(audit(counts))
