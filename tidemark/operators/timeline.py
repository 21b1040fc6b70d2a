"""Commit-timeline operators over a commit-time column.

These run on any DataFrame that carries a commit-time column — a commit-log
table's ``_commit_time`` or a change feed derived from a date column. The
commit-log table also answers them from directory metadata without a scan
(``CommitLogTable.commits``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the reference reads at most this many commits per timeline call.
TIMELINE_CAP = 50


def commit_timeline(df: DataFrame, commit_col: str, limit: int | None = None) -> DataFrame:
    """Distinct commit times ascending, all or the first ``limit``.

    Plans as partial+final aggregate then ``TakeOrderedAndProject``: only the
    distinct values cross the shuffle, and only ``limit`` reach the driver.
    """
    out = df.select(F.col(commit_col).alias("commit_time")).distinct().orderBy("commit_time")
    return out.limit(limit) if limit else out


def begin_instant(df: DataFrame, commit_col: str) -> DataFrame:
    """T2 + P9: ``first commit - 1`` as BIGINT (begin of a read-everything range)."""
    return df.agg((F.min(commit_col).cast("bigint") - F.lit(1)).alias("begin_time"))


def commits_after(df: DataFrame, commit_col: str, begin: str | None) -> DataFrame:
    """P5: rows with commit time strictly after ``begin`` (all when None)."""
    return df if begin is None else df.filter(F.col(commit_col) > F.lit(begin))


def last_commit(
    df: DataFrame, commit_col: str, begin: str | None = None, max_commits: int | None = None
) -> DataFrame:
    """The last commit after ``begin`` as a one-row frame ``last_processed_commit``.

    ``max_commits`` caps the range to the first n commits after ``begin``
    (decision D2: the cap bounds rows and checkpoint together). The result is
    NULL when there is no commit after ``begin``.
    """
    rng = commits_after(df, commit_col, begin)
    if max_commits:
        rng = commit_timeline(rng, commit_col, max_commits).withColumnRenamed("commit_time", commit_col)
    return rng.agg(F.max(commit_col).alias("last_processed_commit"))
