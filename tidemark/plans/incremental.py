"""Stateful incremental reads with a stored checkpoint.

``IncrementalReader.read()`` returns the rows committed after the stored
checkpoint together with a *pending* checkpoint. The caller commits it after
its sink succeeded (decision D3), so a failed sink re-reads the same range on
the next run; with a keyed sink the replay is harmless.

Two kinds of source are supported:

* ``CommitLogSource`` — a tidemark table; commits come from directory
  metadata, rows from ``CommitLogTable.incremental``.
* ``ChangeFeedSource`` — any DataFrame with a commit-time column or
  expression (e.g. a date column rendered ``yyyyMMdd``); commits come from an
  aggregate over that column, rows from a range filter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.timeline import last_commit
from tidemark.plans.checkpoint import Checkpoint, CheckpointStore
from tidemark.plans.commitlog import CommitLogTable


class CommitLogSource:
    def __init__(self, table: CommitLogTable, mode: str = "latest_state", table_name: str | None = None):
        self.table = table
        self.mode = mode
        self.table_name = table_name or table.spec.name
        self.path = table.path

    def last_after(self, begin: str | None, max_commits: int | None) -> str | None:
        # each read cycle starts from a fresh view (other writers' commits
        # included) and keeps it for read_range
        self.table.refresh()
        commits = [c for c in self.table.commits(pinned=True) if begin is None or c > begin]
        if max_commits:
            commits = commits[:max_commits]
        return commits[-1] if commits else None

    def read_range(self, begin: str | None, end: str) -> DataFrame:
        return self.table.incremental(begin, end, mode=self.mode)

    def empty(self) -> DataFrame:
        return self.table.incremental(self.table.last_commit() or "", None, mode=self.mode).limit(0)


class ChangeFeedSource:
    """``day_col``: the date or timestamp column whose day (``yyyyMMdd``) is the
    commit time. Ranges are then also given as bounds on that column, which
    reach the scan and let parquet statistics skip what lies outside."""

    def __init__(self, df: DataFrame, commit: str | Column, table_name: str, path: str = "", day_col: str | None = None):
        self.commit_col = "_commit_time"
        self.day_col = day_col
        commit_expr = F.col(commit) if isinstance(commit, str) else commit
        self.df = df.withColumn(self.commit_col, commit_expr.cast("string"))
        self.table_name = table_name
        self.path = path

    def last_after(self, begin: str | None, max_commits: int | None) -> str | None:
        # One aggregate job; only the single max value reaches the driver.
        row = last_commit(self._days(self.df, begin, None), self.commit_col, begin, max_commits).first()
        return row[0] if row else None

    def read_range(self, begin: str | None, end: str) -> DataFrame:
        c = F.col(self.commit_col)
        cond = c <= F.lit(end)
        if begin is not None:
            cond = cond & (c > F.lit(begin))
        return self._days(self.df, begin, end).filter(cond)

    def read_after(self, begin: str | None) -> DataFrame:
        """Rows with a commit after ``begin``, without an upper bound."""
        c = F.col(self.commit_col)
        return self._days(self.df, begin, None).filter(c.isNotNull() if begin is None else c > F.lit(begin))

    def _days(self, df: DataFrame, begin: str | None, end: str | None) -> DataFrame:
        if self.day_col is None:
            return df
        kind = df.schema[self.day_col].dataType
        day_after = lambda x: F.lit(datetime.strptime(x, "%Y%m%d") + timedelta(days=1)).cast(kind)
        if begin is not None:
            df = df.filter(F.col(self.day_col) >= day_after(begin))
        return df if end is None else df.filter(F.col(self.day_col) < day_after(end))

    def empty(self) -> DataFrame:
        return self.df.limit(0)


@dataclass
class PendingCheckpoint:
    store: CheckpointStore
    checkpoint: Checkpoint

    def commit(self) -> Checkpoint:
        return self.store.write(
            self.checkpoint.table_name, self.checkpoint.path, self.checkpoint.last_processed_commit
        )


class IncrementalReader:
    """S3: read what is new since the stored checkpoint.

    First run (no checkpoint): everything up to the last commit. Later runs:
    (checkpoint, last commit]. Nothing new: an empty frame and no pending
    checkpoint. ``max_commits`` bounds a catch-up to n commits, rows and
    checkpoint together (decision D2).
    """

    def __init__(self, store: CheckpointStore, source, max_commits: int | None = None):
        self.store = store
        self.source = source
        self.max_commits = max_commits

    def read(self) -> tuple[DataFrame, PendingCheckpoint | None]:
        current = self.store.read(self.source.table_name)
        begin = current.last_processed_commit if current else None
        end = self.source.last_after(begin, self.max_commits)
        if end is None:
            return self.source.empty(), None
        rows = self.source.read_range(begin, end)
        pending = PendingCheckpoint(self.store, Checkpoint(self.source.table_name, self.source.path, end))
        return rows, pending


class ObservedReader:
    """S3 with the range end taken from the sink's own job.

    ``IncrementalReader`` looks for the last commit before it reads; here the rows after the
    checkpoint go to the sink at once, and ``DataFrame.observe`` gives their number and last
    commit as they pass. One scan instead of two. The range has no upper bound until then, so
    use it for sources that do not change while they are read (files listed once, a pinned
    table). A sink that fails stores nothing.
    """

    def __init__(self, store: CheckpointStore, source: ChangeFeedSource):
        self.store, self.source = store, source

    def deliver(self, sink: Callable[[DataFrame], object]) -> Checkpoint | None:
        """Give the new rows to ``sink``, which must run exactly one action over them; then store the checkpoint."""
        current = self.store.read(self.source.table_name)
        seen = Observation()
        commit = F.col(self.source.commit_col)
        rows = self.source.read_after(current.last_processed_commit if current else None)
        sink(rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.max(commit).alias("last_commit")))
        if not seen.get["n_rows"] or seen.get["last_commit"] is None:
            return None
        return PendingCheckpoint(self.store, Checkpoint(self.source.table_name, self.source.path, seen.get["last_commit"])).commit()
