"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, ctw, divergence, forest, linkgraph, middle, mixing, neardup, packing, quality, tokens, topk, warc
from tidemark.llm.common import read


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document in a mix of all sources by weights 5, 2, 1."""
    return mixing.mix_counts(read(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what reads back from every rendered conversation, and from conversation -1."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    return chat.digests(chat.format_events(chat.turn_events(rows)))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archive written of them."""
    records = warc.archive(read(spark, sf_dir, "pages"))[1]
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best integer inner products of every twentieth vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.document_groups(read(spark, sf_dir, "documents"), width=2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return forest.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in packed sequences."""
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base log10 probability of every document."""
    return ctw.score_texts(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return tokens.token_counts(read(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's fill-in-middle form and of the text restored from it."""
    return middle.digests(read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, from each other and in the terms they use more."""
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by rules, and by trust and distrust of its host where none fits."""
    return linkgraph.judge(read(spark, sf_dir, "pages"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_chat_format": op2_chat_format,
    "op3_warc": op3_warc,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_nearest": op7_nearest,
    "op8_best_fit": op8_best_fit,
    "op9_lm_scores": op9_lm_scores,
    "op10_token_counts": op10_token_counts,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_url_verdicts": op13_url_verdicts,
}
