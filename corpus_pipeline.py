"""From documents to packed training sequences: quality rules, deduplication, mixing, packing.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the last return
the columns of documents; rows that a stage rejects are gone, and rows that the mix takes
several times are there as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import exact_dedup, mixing, packing, quality, shingle_join
from terrace.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio fitted on these documents."""
    return quality.keep(docs, quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    return exact_dedup.keep_first(docs, exact_dedup.new_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by five-word shingles, the one with the smallest id."""
    return shingle_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_copies),
    ("shingle_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: The likelihood ratio and the token ids are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
