"""Object inventory and regex search over it.

A table of the files under a prefix — path, size, modification time — read by
the ``binaryFile`` source with only metadata columns selected (file contents
are not read). The listing itself is distributed by Spark's file index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def object_inventory(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(prefix).select("path", "length", "modificationTime")


def find_similar(inventory: DataFrame, pattern: str) -> DataFrame:
    """Paths matching a regular expression (search anywhere in the path)."""
    return inventory.filter(F.col("path").rlike(pattern))
