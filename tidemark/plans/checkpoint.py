"""Checkpoint store.

An append-only JSON dataset: ``<root>/<table_name>/<write id>/part-*.json``.
The newest row of a table (by ``inserted_time``) is its checkpoint. Resetting
appends a row whose ``last_processed_commit`` is NULL, so history is never
rewritten in place. Every write goes to its own folder, so concurrent writers
(several loaders, several tables) never share a commit area, and a crashed
writer leaves at most a folder without ``_SUCCESS``, which readers skip.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("last_processed_commit", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("inserted_time", T.StringType()),
        T.StructField("table_name", T.StringType()),
    ]
)


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass(frozen=True)
class Checkpoint:
    table_name: str
    path: str
    last_processed_commit: str | None
    inserted_time: str = ""


class CheckpointStore:
    """Checkpoints of many tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table_dir(self, table_name: str) -> str:
        return f"{self.root}/{table_name}"

    def frame(self, table_name: str | None = None) -> DataFrame:
        """Checkpoint rows of one table or all (empty frame when none); only
        finished writes (with ``_SUCCESS``) are read."""
        pattern = f"{self._table_dir(table_name) if table_name else self.root + '/*'}/*/_SUCCESS"
        done = [p.rsplit("/", 1)[0] for p in fs.glob_names(self.spark, pattern)]
        if not done:
            return self.spark.createDataFrame([], CHECKPOINT_SCHEMA)
        return self.spark.read.schema(CHECKPOINT_SCHEMA).json(done)

    def latest_frame(self, table_name: str | None = None) -> DataFrame:
        """Newest row per table (C2 as a DataFrame)."""
        df = self.frame(table_name)
        w = Window.partitionBy("table_name").orderBy(F.col("inserted_time").desc())
        return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")

    def read(self, table_name: str) -> Checkpoint | None:
        """The table's checkpoint, or None (no row, or reset)."""
        # folders are named by insert time: only the newest finished one is opened
        done = [p.rsplit("/", 1)[0] for p in fs.glob_names(self.spark, f"{self._table_dir(table_name)}/*/_SUCCESS")]
        if not done:
            return None
        row = self.spark.read.schema(CHECKPOINT_SCHEMA).json(max(done, key=lambda d: d.rsplit("/", 1)[1])).first()
        if row is None or row["last_processed_commit"] is None:
            return None
        return Checkpoint(row["table_name"], row["path"], row["last_processed_commit"], row["inserted_time"])

    def exists(self, table_name: str) -> bool:
        """C1."""
        return self.read(table_name) is not None

    def write(self, table_name: str, path: str, last_processed_commit: str | None) -> Checkpoint:
        """Append one checkpoint row (single JSON encoding, decision D17)."""
        cp = Checkpoint(table_name, path, last_processed_commit, _now())
        row = [(cp.last_processed_commit, cp.path, cp.inserted_time, cp.table_name)]
        write_id = f"{cp.inserted_time.replace(' ', 'T').replace(':', '')}-{uuid.uuid4().hex[:8]}"
        (
            self.spark.createDataFrame(row, CHECKPOINT_SCHEMA)
            .coalesce(1)
            .write.mode("errorifexists")
            .json(f"{self._table_dir(table_name)}/{write_id}")
        )
        return cp

    def reset(self, table_name: str, path: str = "") -> Checkpoint:
        """C4: the next incremental read starts from the beginning."""
        return self.write(table_name, path, None)

    def prune(self, table_name: str, keep: int = 10) -> list[str]:
        """Drop all but the newest ``keep`` finished checkpoint writes of a table.

        Write folders are named by insert time, so name order is time order.
        The newest row is never removed, so the checkpoint itself is unchanged.
        """
        if keep < 1:
            raise ValueError("keep at least one checkpoint")
        done = sorted(
            p.rsplit("/", 2)[-2] for p in fs.glob_names(self.spark, f"{self._table_dir(table_name)}/*/_SUCCESS")
        )
        gone = done[:-keep]
        for name in gone:
            fs.delete(self.spark, f"{self._table_dir(table_name)}/{name}")
        return gone
