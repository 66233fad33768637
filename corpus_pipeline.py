"""Corpus pipeline over ``documents``: quality rules, exact dedup, MinHash near-dedup,
mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet and reads it again as the next stage's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewright.llm import exact_dedup, mixing, near_dup, packing, quality
from scorewright.llm.queries import MIX_BUDGET, tokenizer
from scorewright.llm.util import read
from scorewright.session import materialize

CACHED_WORDS = 120_000  # the workers still hold what earlier stages took
ORACLE_SQL = None  # near duplicates and packing cannot be said in SQL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one_row(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.keep_mixed(docs, MIX_BUDGET)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), cached_words=CACHED_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
