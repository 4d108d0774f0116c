"""A cleaning pipeline over ``documents``: toxic documents go, one of each group
of near-duplicates stays, documents that hold benchmark items go, sources are
mixed to their target weights, and what is left is dealt into shards.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webcorpus.llm import decontam, mixing, sharding, simhash, toxicity
from webcorpus.llm.common import cut
from webcorpus.llm.queries import SHARD_BYTES
from webcorpus.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: rows scored 0.5 or more by nearest labelled examples go."""
    base = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return toxicity.keep_clean(docs, toxicity.fit(base, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of documents linked by SimHash the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the shard of every row; the last stage, with new columns."""
    return sharding.assign_shards(docs, SHARD_BYTES)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("benchmark_decontamination", drop_benchmark),
          ("mixing", mix_sources), ("sharding", deal_shards)]

#: Nearest examples, fingerprints and rounding are not SQL; tests check columns and row counts of each stage, and the operators on their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
