"""A corpus pipeline: quality rules, exact and near deduplication, mixing, and byte-level BPE.

Each stage gets what the one before it kept, written as Parquet and read again, so a lost executor
costs part of one stage. All but the last return the columns of the documents they get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm.bpe import public_vocabulary, token_digests
from tillwork.llm.common import landed, read_table
from tillwork.llm.exact_dedup import drop_copies
from tillwork.llm.mixing import mixed
from tillwork.llm.near_dedup import keep_one_of_each
from tillwork.llm.quality_rules import keep_clean
from tillwork.llm.registry import query


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines."""
    return keep_clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest identifier."""
    return drop_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    return token_digests(docs, public_vocabulary(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

#: MinHash classes and BPE are beyond SQL; tests/llm compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
