"""The corpus pipeline: drop low quality, keep one of each near-duplicate group,
mix the sources to their weights, pack into sequences.

Each stage takes what its predecessor kept, from a written table, and returns the
columns of ``documents``; the last one returns the packed pieces. Documents that a
mix takes twice are two rows from there on, and two copies never share a sequence.

Every stage runs on empty tables and on rows with nulls as its operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, neardup, packing, quality
from tidemark.llm.common import free_name, read
from tidemark.session import scratch_dir

#: Words of a shingle in the near-dedup stage; op5's contract of two words holds for op5 alone.
SHINGLE_WORDS = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold, learned from the labels outside the held-out fold."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    name = free_name(docs, "score")
    scored = quality.score_documents(docs, model, docs.columns, name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group by shingles of ``SHINGLE_WORDS`` words."""
    return neardup.drop_near_duplicates(docs, SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in packed sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: Hash ranks and best-fit search have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
