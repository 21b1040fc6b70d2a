"""Helpers the operators share: written tables and valid vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Words of a text: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts the lineage: the rows stay readable after executors are lost, and
    rows whose order depends on a shuffle are fixed once.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Number of words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written in decimal, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def valid_vector(v: Column) -> Column:
    """True for a vector that is neither null nor holds null or non-finite components."""
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(whole, F.lit(False))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
