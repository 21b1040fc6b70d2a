"""File layout: rewriting small files to a size in bytes, and proof of clustering (K8, K9).

File names and sizes come from the ``_metadata`` column of the rows themselves, so
they are read in parallel and match the rows' files exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.numbering import dense_numbers

#: The reference's small-file limit and largest file.
SMALL_BYTES = 100 * 1024 * 1024
TARGET_BYTES = 512 * 1024 * 1024

_FILE, _GROUP = "__tm_file", "__tm_group"


def data_files(rows: DataFrame) -> DataFrame:
    """(file, bytes, n_rows) of every file that holds rows of a file-backed DataFrame."""
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).groupBy("file", "bytes").agg(
        F.count(F.lit(1)).alias("n_rows"))


def rewrite_groups(files: DataFrame, small: int = SMALL_BYTES, target: int = TARGET_BYTES) -> DataFrame:
    """(file, folder, group): files below ``small`` bytes packed, per folder, into groups of about
    ``target`` bytes; others are groups of their own.

    Packing is a running sum in each folder: a group ends with the file that reaches ``target``,
    so it exceeds it by less than ``small``.
    """
    folder = F.regexp_replace("file", "/[^/]*$", "")
    order = Window.partitionBy("folder", "little").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(order), F.lit(0))
    placed = files.withColumns({"folder": folder, "little": F.col("bytes") < small}).withColumn(
        "group", F.when(F.col("little"), F.concat_ws(" ", F.lit("small"), F.floor(before / target).cast("string"))).otherwise(F.col("file")))
    return placed.select("file", "folder", "group")


def rewrite_small_files(
    spark: SparkSession,
    path: str,
    out: str,
    small: int = SMALL_BYTES,
    target: int = TARGET_BYTES,
    partition_by: Sequence[str] = (),
    compression: str = "gzip",
) -> int:
    """Write the dataset at ``path`` to ``out`` with one file per group; returns the number of files.

    Each group goes to a task of its own (its number is the partition id), whatever the session's
    shuffle partitions, and AQE neither splits nor merges these.
    """
    rows = spark.read.parquet(path)
    groups = rewrite_groups(data_files(rows), small, target).select("file", F.concat_ws("|", "folder", "group").alias("output"))
    # one number per output file
    outputs, n = dense_numbers(groups, "output", _GROUP)
    numbered = groups.join(outputs, "output").select(F.col("file").alias(_FILE), F.col(_GROUP).cast("int").alias(_GROUP))
    if n:
        dealt = rows.withColumn(_FILE, F.col("_metadata.file_path")).join(numbered, _FILE).repartitionById(n, F.col(_GROUP))
        writer = dealt.drop(_FILE, _GROUP).write.option("compression", compression).option("maxRecordsPerFile", 0)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out)
    else:
        rows.write.parquet(out)
    return n


def key_ranges(rows: DataFrame, cols: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """(within..., file, lo, hi, n_rows): the least and the greatest key of every file."""
    key = F.struct(*cols)
    return rows.select(*within, F.col("_metadata.file_path").alias("file"), key.alias("key")).groupBy(*within, "file").agg(
        F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n_rows"))


def clustering_report(rows: DataFrame, cols: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """(within..., n_files, n_rows, overlapping): files whose key range meets that of a file before.

    An interval scan: files by their least key, against the greatest key of all files before them.
    One row per file goes into it; files of one partition (``within``) are one group.
    """
    order = Window.partitionBy(*within).orderBy("lo", "hi", "file").rowsBetween(Window.unboundedPreceding, -1)
    scanned = key_ranges(rows, cols, within).withColumn("reached", F.max("hi").over(order))
    return scanned.groupBy(*within).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"), F.count_if(F.col("lo") <= F.col("reached")).alias("overlapping"))
