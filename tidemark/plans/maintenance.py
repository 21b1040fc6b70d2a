"""Table maintenance jobs: compaction, clustering, retention, statistics.

Each job is an explicit Spark job over the table (the reference's async
services become calls). Rewrites go to new directories made visible by their
``_SUCCESS``; nothing is overwritten in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.functions.columns import COMMIT_COL, DELETED_COL
from tidemark.operators.keyed import RANK_COL, ranked, retain_latest_versions
from tidemark.plans.commitlog import BATCH_COL, CommitLogTable, WriteOptions

#: A clustering task sorts about this many bytes of rows, whatever they are in parquet.
SORT_BYTES = 256 * 1024 * 1024
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def commits_since_base(table: CommitLogTable) -> int:
    end = table.base_end()
    return sum(1 for c in table.commits() if end is None or c > end)


def table_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fsys = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fsys.getContentSummary(p).getLength()) if fsys.exists(p) else 0


def bytes_to_sort(rows: DataFrame) -> int:
    """About what ``rows`` take in a sort: the sort's own entry and eight bytes a column, and the
    texts (nested columns as text) at their full length. Only these columns are read."""
    size = F.lit(64 + 8 * len(rows.columns)).cast("long")
    for f in rows.schema.fields:
        if not isinstance(f.dataType, _FIXED):
            c = F.col(f"`{f.name}`") if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`").cast("string")
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return int(rows.agg(F.sum(size)).first()[0] or 0)


def cluster(
    table: CommitLogTable,
    sort_columns: Sequence[str],
    target_file_bytes: int,
    options: WriteOptions | None = None,
) -> str | None:
    """K8: rewrite the snapshot as a base range-partitioned and sorted by
    ``sort_columns``, about ``target_file_bytes`` per file, or less where the
    rows of such a file are more than a task should sort (``SORT_BYTES``).

    Range partitioning samples the sort keys (no full sort on one task), so
    files cover disjoint key ranges and min/max statistics skip well. The
    record keys extend the range key: one sort value shared by a third of the
    rows still spreads over several files, which stay contiguous in it.
    """
    table.refresh()  # the base written below must hold every commit up to `end`
    pinned = table.commits(pinned=True)
    end = pinned[-1] if pinned else None
    if end is None:
        return None
    # size from everything the snapshot reads: the log and the base in use
    stored = table_bytes(table.spark, f"{table.path}/log") + sum(
        table_bytes(table.spark, p) for p in table.base_paths()
    )
    base, base_end = table._base(), table.pin()[1]
    versions = table.log(after=base_end)
    if base is not None:
        versions = versions.filter(F.col(COMMIT_COL) > F.lit(base_end)).unionByName(base)
    n_files = max(stored // max(1, target_file_bytes) + 1, -(-bytes_to_sort(versions) // SORT_BYTES))
    snap = table.snapshot(with_meta=True).withColumn(DELETED_COL, F.lit(False))
    # partition columns lead, so each file belongs to one partition and the
    # partitioned write finds its rows in order
    lead = list(table.spec.partition_by)
    range_key = list(dict.fromkeys([*lead, *sort_columns, *table.spec.resolve_keys]))
    rows = snap.repartitionByRange(int(n_files), *range_key).sortWithinPartitions(*range_key)
    table.write_base(rows, end, options)
    return end


def _history_dirs(table: CommitLogTable) -> list[str]:
    return table._finished("history")


def retain_versions(table: CommitLogTable, n: int, options: WriteOptions | None = None, grace: bool = False) -> DataFrame:
    """Keep the ``n`` newest versions per key, over the whole table life.

    The kept versions are the previous history plus the live log, ranked
    together, so a key keeps ``n`` versions in total however often retention
    runs. Versions at or before a key's newest delete are dropped with it.
    Then the table is compacted, log batches the base covers are removed,
    older history and base directories no reader needs are deleted. Returns
    the retained versions (with ``version_rank``).

    ``grace``: delete only what the run before had superseded already. Readers that
    pinned the table before this run then finish; run it less often than they last.
    """
    table.refresh()  # history and compaction must cover every commit up to `end`
    pinned = table.commits(pinned=True)
    end = pinned[-1] if pinned else None
    if end is None:
        return table.versions(n)
    target = f"{table.path}/history/{BATCH_COL}={end}~{n}"
    if not fs.exists(table.spark, target):
        keys = table.spec.resolve_keys
        log = table.log()
        previous = _history_dirs(table)
        candidates = log
        if previous:
            prev_end = previous[-1].split("=", 1)[1].split("~")[0]
            old = table.spark.read.parquet(f"{table.path}/history/{previous[-1]}").drop("version_rank")
            old = old.withColumn(DELETED_COL, F.lit(False))
            candidates = log.filter(F.col(COMMIT_COL) > F.lit(prev_end)).unionByName(old, allowMissingColumns=True)
        elif table.dropped_through() is not None:
            # the log was cut without a history: its older keys live in the base
            after = log.filter(F.col(COMMIT_COL) > F.lit(table.base_end()))
            candidates = after.unionByName(table._base(), allowMissingColumns=True)
        order = table._order(candidates)
        data = candidates.filter(~F.col(DELETED_COL))
        # at most n versions per (key, commit) before the key-level join, so
        # a hot key meets the delete join with at most n rows per commit
        data = ranked(data, [*keys, COMMIT_COL], order, n).drop(RANK_COL)
        if table.has_tombstones():
            tombs = (
                candidates.filter(F.col(DELETED_COL)).groupBy(*keys).agg(F.max(COMMIT_COL).alias("__tm_tomb"))
            )
            cond = [data[k].eqNullSafe(tombs[k]) for k in keys] + [data[COMMIT_COL] <= tombs["__tm_tomb"]]
            data = data.join(tombs, on=cond, how="left_anti")
        kept = retain_latest_versions(data, keys, order, n).drop(DELETED_COL)
        staging = f"{table.path}/_staging/history-{end}-{n}-{uuid.uuid4().hex[:8]}"
        compression = (options or WriteOptions(compression=table.spec.compression)).compression
        kept.write.mode("errorifexists").option("compression", compression).parquet(staging)
        fs.rename(table.spark, staging, target)
        table.compact(options)
        before = previous[-1].split("=", 1)[1].split("~")[0] if previous else None
        if not grace:
            table.drop_log_through(end)
        elif before is not None:
            table.drop_log_through(before)
        for d in previous[:-1] if grace else previous:
            fs.delete(table.spark, f"{table.path}/history/{d}")
        if not grace:
            drop_unused_bases(table)
        elif before is not None:
            drop_unused_bases(table, before)
    return table.spark.read.parquet(target)


def drop_unused_bases(table: CommitLogTable, before: str | None = None) -> list[str]:
    """Delete base directories that no partition is read from any more
    (``before``: only those that end earlier than this commit).

    Partition-scoped tables read each partition from the newest base holding
    it, so older bases stay while one of their partitions is still current;
    everything else is a superseded copy.
    """
    table.refresh()
    used = {p.split("/base/", 1)[1].split("/", 1)[0] for p in table.base_paths()}
    newest = table.base_dir()
    if newest:
        used.add(newest)
    ends = {d: d.split("=", 1)[1].split("~", 1)[0] for d in table._finished("base") if d not in used}
    gone = [d for d, end in ends.items() if before is None or end < before]
    for d in gone:
        fs.delete(table.spark, f"{table.path}/base/{d}")
    table.refresh()
    return gone


def retain_versions_if_due(table: CommitLogTable, n: int, every: int, options: WriteOptions | None = None) -> None:
    if len(table.batches()) >= every:
        retain_versions(table, n, options)


def analyze(spark: SparkSession, qualified_name: str, columns: Sequence[str]) -> DataFrame:
    """Column statistics for the optimizer on a catalog table."""
    cols = ", ".join(columns)
    spark.sql(f"ANALYZE TABLE {qualified_name} COMPUTE STATISTICS FOR COLUMNS {cols}")
    return spark.sql(f"DESCRIBE EXTENDED {qualified_name}")


#: What the catalog keeps about a column; distinct counts are approximate (HyperLogLog, see spark.sql.statistics.ndv.maxError).
STATISTICS = ("min", "max", "num_nulls", "distinct_count", "avg_col_len", "max_col_len")


def column_stats(spark: SparkSession, qualified_name: str, columns: Sequence[str]) -> DataFrame:
    """The stored statistics of ``columns``, one row each, values as text (null where the catalog has none)."""
    rows = []
    for c in columns:
        facts = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {qualified_name} `{c}`").collect()}
        rows.append((c, *[None if facts.get(s) in (None, "NULL") else facts[s] for s in STATISTICS]))
    return spark.createDataFrame(rows, ", ".join(["column_name string", *[f"{s} string" for s in STATISTICS]]))


def file_layout(spark: SparkSession, path: str) -> DataFrame:
    """Data files under ``path`` with their sizes (K9 checks)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )



def clean_staging(table: CommitLogTable) -> list[str]:
    """Remove leftovers of failed writes under ``_staging/``.

    A write that died before its rename never became visible; retrying the
    write picks a new commit time, so these folders only take space. Run it
    when no writer is active on the table (tables have a single writer).
    """
    root = f"{table.path}/_staging"
    gone = []
    for d in fs.list_dirs(table.spark, root):
        fs.delete(table.spark, f"{root}/{d}")
        gone.append(d)
    return gone
