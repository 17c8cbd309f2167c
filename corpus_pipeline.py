"""The corpus pipeline: toxicity, quality rules, near duplicates, source mixing, packing. Each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quireflow.llm.common import Scratch
from quireflow.llm.mixing import mix_documents
from quireflow.llm.ngram_join import drop_near_duplicates
from quireflow.llm.packing import pack_documents
from quireflow.llm.quality import clean_documents
from quireflow.llm.tokens import vocabulary
from quireflow.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; boilerplate lines go from the others."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8."""
    return drop_near_duplicates(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), kind="byte", capacity=2048, end_id=0)


STAGES = [("toxicity", toxicity), ("quality", quality_rules), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: A trained score decides the first stage, and subword ids the last: SQL can't express them. tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        scratch.drop(*[n for n in list(scratch.held) if n != name])
    return docs
