"""Dense numbers for any set of ids, without a single-task window.

Ids are dealt to range partitions, each partition numbers its own, and the counts of
the partitions before it are added. Only these counts, one per partition, reach the
driver; no task sees more than one range.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

_PART = "__tm_part"


def dense_numbers(ids: DataFrame, col: str, number: str = "number") -> tuple[DataFrame, int]:
    """(``col``, ``number``) for the distinct non-null values of ``col``, numbered 0, 1, ... in their
    order, and how many there are."""
    spark = ids.sparkSession
    path = scratch_dir(spark, "numbering")
    # written once: the ranges are sampled, and counts and numbers must see the same ones
    ranged = ids.select(col).filter(F.col(col).isNotNull()).distinct().repartitionByRange(col)
    ranged.withColumn(_PART, F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    counts = sorted((r[_PART], r["count"]) for r in ranged.groupBy(_PART).count().collect())
    ends = list(accumulate(n for _, n in counts))
    starts = spark.createDataFrame([(p, e - n) for (p, n), e in zip(counts, ends, strict=True)], f"{_PART} int, __tm_start long")
    own = F.row_number().over(Window.partitionBy(_PART).orderBy(col))
    numbered = ranged.withColumn("__tm_own", own).join(starts, _PART)
    return numbered.select(col, (F.col("__tm_start") + F.col("__tm_own") - 1).alias(number)), ends[-1] if ends else 0
