"""Commit-log tables: keyed, commit-stamped parquet.

Layout under the table path::

    _meta/v<version>.json                          spec + schema, newest wins
    _meta/dropped-through-<end>                    retention removed log up to <end>
    log/_batch=<id>[~delete|~u]/_commit_time=<t>/[<part>=<v>/]part-*.parquet
    log/_batch=<id>/_SUCCESS                       the batch is visible once this exists
    base/_batch=<end>~<stamp>/[<part>=<v>/]part-*.parquet   compacted snapshot

Every write job is one batch directory holding one commit (upsert, insert,
delete) or many (changelog import), written under ``_staging/`` and renamed
into place. Readers list the finished batches once and pass exactly those
paths to the parquet reader, so a half-written batch is never read and every
read of one ``CommitLogTable`` instance sees the same upper bound.
``_commit_time`` is a partition column: range filters on it appear under
``PartitionFilters`` and prune whole directories.

Resolution (snapshot) is latest-per-key with tombstones applied:

* ``incoming_wins`` orders versions by (``_commit_time``, pre-combine, ties);
  tombstones rank with the data in one window,
* ``event_time`` by (pre-combine, ``_commit_time``, ties), all descending;
  versions at or before a key's newest tombstone are dropped first.

With a compacted base, only log commits after it are read and only the keys
they touch are re-resolved: ``base ANTI touched  UNION  resolve(base SEMI
touched UNION log_after)``. When the touched key set is small AQE broadcasts
it and the base is never shuffled. Partition-scoped tables compact only the
partitions written since the last base.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.functions.columns import COMMIT_COL, DELETED_COL, orderable_columns
from tidemark.operators.keyed import (
    KEY_SCOPES,
    MERGE_MODES,
    latest_per_key,
    precombine,
    retain_latest_versions,
    scoped_keys,
)

BATCH_COL = "_batch"
META_COLS = (BATCH_COL, COMMIT_COL, DELETED_COL)
TOMB_COL = "__tm_tomb"
OPERATIONS = ("upsert", "insert", "bulk_insert", "delete")
TABLE_TYPES = ("COPY_ON_WRITE", "MERGE_ON_READ")
INCREMENT_MODES = ("latest_state", "changes")
COMMIT_FORMAT = "%Y%m%d%H%M%S%f"  # rendered to 17 digits (milliseconds)
DELETE_SUFFIX = "~delete"  # batch-name mark of a commit holding tombstones
UNIQUE_SUFFIX = "~u"  # batch-name mark of an upsert commit: one row per key
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for a NULL value
DROP_MARK = "dropped-through-"  # _meta marker: log batches up to this commit removed


def per_commit_winners(versions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Best data version per (key, commit), tombstones kept as they are.

    The ranking's partial ``WindowGroupLimit`` runs before a shuffle on
    (key, commit): a key holding a third of all rows is cut to one row per
    commit per map task, so later joins on the key see at most one row per
    commit for it. The key's overall winner is unchanged (max of maxima).
    """
    data = latest_per_key(versions.filter(~F.col(DELETED_COL)), [*keys, COMMIT_COL], order)
    return data.unionByName(versions.filter(F.col(DELETED_COL)))


def resolve_versions(
    versions: DataFrame,
    keys: list[str],
    order: list[str],
    merge_mode: str,
    tombstones: bool = True,
) -> DataFrame:
    """Latest live version per key among ``versions`` (data rows and tombstones).

    ``incoming_wins`` (order starts with ``_commit_time``): tombstones rank
    with the data, and a key whose newest version is a tombstone is gone. One
    window, whose partial ``WindowGroupLimit`` runs before the shuffle.

    ``event_time``: versions at or before the key's newest tombstone are
    dropped first (left-anti join on key equality against one row per deleted
    key), then the window on the same keys. Before that join the versions are
    cut to one per (key, commit) (``per_commit_winners``) so a hot key never
    lands whole in one join task; both steps are skipped when the input is
    known to hold no tombstones.
    """
    if merge_mode == "incoming_wins":
        return latest_per_key(versions, keys, order).filter(~F.col(DELETED_COL))
    if not tombstones:
        return latest_per_key(versions.filter(~F.col(DELETED_COL)), keys, order)
    versions = per_commit_winners(versions, keys, order)
    data = versions.filter(~F.col(DELETED_COL))
    tombs = versions.filter(F.col(DELETED_COL)).groupBy(*keys).agg(F.max(COMMIT_COL).alias(TOMB_COL))
    cond = [data[k].eqNullSafe(tombs[k]) for k in keys] + [data[COMMIT_COL] <= tombs[TOMB_COL]]
    return latest_per_key(data.join(tombs, on=cond, how="left_anti"), keys, order)


@dataclass(frozen=True)
class TableSpec:
    """What a table is keyed and ordered by (M1, M8)."""

    name: str
    keys: tuple[str, ...]
    precombine: str | None = None
    tie_breakers: tuple[str, ...] | None = None
    partition_by: tuple[str, ...] = ()
    key_scope: str = "partition"
    merge_mode: str = "incoming_wins"
    table_type: str = "COPY_ON_WRITE"
    compression: str = "snappy"  # codec of writes and rewrites that name none (K10)

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple([self.keys] if isinstance(self.keys, str) else self.keys))
        object.__setattr__(self, "partition_by", tuple(self.partition_by or ()))
        if self.tie_breakers is not None:
            object.__setattr__(self, "tie_breakers", tuple(self.tie_breakers))
        if not self.keys:
            raise ValueError("a table needs at least one record key")
        if self.key_scope not in KEY_SCOPES:
            raise ValueError(f"key_scope must be one of {KEY_SCOPES}")
        if self.merge_mode not in MERGE_MODES:
            raise ValueError(f"merge_mode must be one of {MERGE_MODES}")
        if self.table_type not in TABLE_TYPES:
            raise ValueError(f"table_type must be one of {TABLE_TYPES}")

    @property
    def resolve_keys(self) -> list[str]:
        return scoped_keys(self.keys, self.partition_by, self.key_scope)


@dataclass
class WriteOptions:
    """Physical write settings (K9, K10); see ``plans.write_config``."""

    compression: str = "snappy"
    max_records_per_file: int = 0
    rebalance: bool | None = None  # None: rebalance on partition columns if partitioned
    parquet_options: dict[str, str] = field(default_factory=dict)


def _base_key(base_dir: str) -> tuple[str, ...]:
    return tuple(base_dir.split("=", 1)[1].split("~"))


def _end_of(base_dir: str) -> str:
    return base_dir.split("=", 1)[1].split("~", 1)[0]


def _next_commit_time(last: str | None) -> str:
    """The present time, or the next one after ``last`` if that is later.

    Commit times compare as text, so a table whose last commit does not sort
    before any time we can make (other letters or another width) takes no new
    time of ours: pass one explicitly.
    """
    now = _dt.datetime.now(_dt.timezone.utc).strftime(COMMIT_FORMAT)[:17]
    if last is not None and now <= last:
        if len(last) == 17 and last.isdigit():
            return str(int(last) + 1)
        raise ValueError(f"no commit time of now sorts after the last commit {last!r}; pass commit_time")
    return now


class CommitLogTable:
    """A keyed table stored as a log of commits (optionally with a base)."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, schema: T.StructType | None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self._schema = schema
        self._pinned: tuple[list[str], str | None] | None = None
        self._fast_path = True  # off for views with another spec (``with_spec``)

    # ------------------------------------------------------------------ meta
    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: TableSpec, exist_ok: bool = True) -> CommitLogTable:
        """Create the table if missing; an existing table is opened."""
        if fs.exists(spark, f"{path.rstrip('/')}/_meta"):
            if not exist_ok:
                raise FileExistsError(path)
            table = cls.open(spark, path)
            other = [k for k, v in asdict(spec).items() if k != "compression" and asdict(table.spec)[k] != v]
            if other:
                raise ValueError(f"the table at {path} was created with other settings: {', '.join(other)}")
            return table
        table = cls(spark, path, spec, None)
        table._write_meta("0", None)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CommitLogTable:
        doc = cls._read_meta(spark, path)
        spec = TableSpec(**doc["spec"])
        schema = T.StructType.fromJson(doc["schema"]) if doc.get("schema") else None
        return cls(spark, path, spec, schema)

    def _reload_schema(self) -> None:
        """Take the newest stored schema before merging a write into it, so
        columns added through another instance are never dropped."""
        doc = self._read_meta(self.spark, self.path)
        if doc.get("schema"):
            self._schema = T.StructType.fromJson(doc["schema"])

    @staticmethod
    def _read_meta(spark: SparkSession, path: str) -> dict:
        meta_dir = f"{path.rstrip('/')}/_meta"
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(meta_dir)
        fsys = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fsys.exists(p):
            raise FileNotFoundError(f"no tidemark table at {path}")
        names = sorted(
            (
                st.getPath().getName()
                for st in fsys.listStatus(p)
                if st.getPath().getName().startswith("v") and st.getPath().getName().endswith(".json")
            ),
            key=lambda n: (len(n), n),
        )
        stream = fsys.open(jvm.org.apache.hadoop.fs.Path(f"{meta_dir}/{names[-1]}"))
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _write_meta(self, version: str, schema: T.StructType | None) -> None:
        """Write a metadata version atomically: a hidden temporary file is
        renamed into place, so readers never parse a half-written document."""
        doc = {"version": version, "spec": asdict(self.spec), "schema": schema.jsonValue() if schema else None}
        jvm = self.spark.sparkContext._jvm
        final = f"{self.path}/_meta/v{version}.json"
        tmp = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_meta/.v{version}.json.{uuid.uuid4().hex[:8]}.tmp")
        fsys = tmp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = fsys.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(doc).encode("utf-8")))
        finally:
            out.close()
        fsys.delete(jvm.org.apache.hadoop.fs.Path(final), False)  # a rewrite of the same version
        if not fsys.rename(tmp, jvm.org.apache.hadoop.fs.Path(final)):
            raise OSError(f"could not publish {final}")
        self._schema = schema

    @property
    def schema(self) -> T.StructType | None:
        """Data schema (user columns, partition columns included, no meta)."""
        return self._schema

    # -------------------------------------------------------------- timeline
    def _finished(self, area: str) -> list[str]:
        """Batch directories of ``area`` holding a ``_SUCCESS`` (one glob call)."""
        found = fs.glob_names(self.spark, f"{self.path}/{area}/{BATCH_COL}=*/_SUCCESS")
        return sorted(p.rstrip("/").split("/")[-2] for p in found)

    def batches(self) -> list[str]:
        """Finished log batch directory names, oldest first."""
        return self._finished("log")

    def commits(self, pinned: bool = False) -> list[str]:
        """M2: finished commit times ascending, from directory metadata (no scan).

        ``pinned``: only commits of the batches and base the following reads
        will see — what a reader must use to choose its range end, so a batch
        finishing in between is never skipped by a checkpoint.
        """
        if pinned:
            batches, base = self.pin()
        else:
            batches, base = self.batches(), self.base_end()
        finished = set(batches)
        out: set[str] = set()
        for p in fs.glob_names(self.spark, f"{self.path}/log/{BATCH_COL}=*/{COMMIT_COL}=*"):
            batch, commit = p.rstrip("/").split("/")[-2:]
            if batch in finished:
                out.add(commit.split("=", 1)[1])
        if base:
            out.add(base)
        return sorted(out)

    def base_dir(self) -> str | None:
        """Newest finished base directory name (greatest end, then stamp)."""
        bases = sorted(self._finished("base"), key=lambda d: tuple(d.split("=", 1)[1].split("~")))
        return bases[-1] if bases else None

    def base_end(self) -> str | None:
        d = self.base_dir()
        return _end_of(d) if d else None

    def last_commit(self) -> str | None:
        commits = self.commits()
        return commits[-1] if commits else None

    # ----------------------------------------------------------------- write
    def _storage_schema(self, df: DataFrame) -> T.StructType:
        user = [f for f in df.schema.fields if f.name not in META_COLS]
        return T.StructType(user)

    def _merge_schema(self, incoming: T.StructType) -> T.StructType:
        if self._schema is None:
            return incoming
        have = {f.name: f for f in self._schema.fields}
        drift = [
            f"{f.name}: {have[f.name].dataType.simpleString()} is stored, {f.dataType.simpleString()} was given"
            for f in incoming.fields
            if f.name in have and have[f.name].dataType.simpleString() != f.dataType.simpleString()
        ]
        if drift:
            raise ValueError("column types differ from the table's: " + "; ".join(drift))
        return T.StructType(self._schema.fields + [f for f in incoming.fields if f.name not in have])

    def _guard_keys(self, df: DataFrame) -> DataFrame:
        """Decision D13: a NULL record key fails the write job itself (no extra pass)."""
        out = df
        for k in self.spec.keys:
            out = out.withColumn(
                k,
                F.when(F.col(k).isNull(), F.raise_error(F.lit(f"NULL record key in column {k}"))).otherwise(F.col(k)),
            )
        return out

    def _write_batch(self, rows: DataFrame, batch: str, options: WriteOptions, floor: str | None = None, newest: bool = False) -> str | None:
        """Write one batch; returns its published name, None (nothing visible)
        when it held no rows.

        Emptiness is read from the written directories, not from a separate
        ``isEmpty()`` job, so an expensive input plan runs exactly once.

        ``floor``: the base's end when the write began. A batch with a commit at
        or before it would never be read, and commits of other widths would
        sort wrongly as text; either is refused before anything is published.
        ``newest``: also refuse when another commit was published meanwhile that
        the batch does not sort after (a table has one writer).
        """
        parts = list(self.spec.partition_by)
        rebalance = options.rebalance if options.rebalance is not None else bool(parts)
        if rebalance:
            # REBALANCE lets AQE split a hot partition value across tasks and
            # merge small ones, so files stay near the advisory size.
            rows = rows.hint("rebalance", *parts) if parts else rows.hint("rebalance")
        writer = rows.write.mode("errorifexists").option("compression", options.compression)
        if options.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", options.max_records_per_file)
        for k, v in options.parquet_options.items():
            writer = writer.option(k, v)
        # Written under _staging/ and moved into log/ once finished, so a
        # streaming file source over log/ only ever lists whole batches (on
        # stores with atomic directory rename); _SUCCESS guards the rest.
        staging = f"{self.path}/_staging/{BATCH_COL}={batch}"
        writer.partitionBy(COMMIT_COL, *parts).parquet(staging)
        if not fs.glob_names(self.spark, f"{staging}/{COMMIT_COL}=*"):
            fs.delete(self.spark, staging)  # K15: an empty batch creates no commit
            return None
        new = sorted(p.rstrip("/").rsplit("=", 1)[1] for p in fs.glob_names(self.spark, f"{staging}/{COMMIT_COL}=*"))
        try:
            self._check_order(new, floor)
            last = self.last_commit() if newest else None
            if last is not None and new[0] <= last:
                raise ValueError(f"commit {new[0]} does not sort after {last}, published meanwhile")
        except ValueError:
            fs.delete(self.spark, staging)
            raise
        fs.rename(self.spark, staging, f"{self.path}/log/{BATCH_COL}={batch}")
        return batch

    def _check_order(self, new: list[str], floor: str | None) -> None:
        """Commit times order as text, so a batch has one width, another width than
        the last commit's must sort after it, and none may be at or before the base."""
        if NULL_PARTITION in new:
            raise ValueError("NULL commit time")
        widths = sorted({len(c) for c in new})
        last = self.last_commit()
        if len(widths) > 1 or (last and new and len(last) != widths[0] and new[0] <= last):
            raise ValueError(f"commit times of widths {widths} do not order as text (last commit {last})")
        if floor is not None and new and new[0] <= floor:
            raise ValueError(f"commit {new[0]} is not after the compacted base, which ends at {floor}")

    def write(
        self,
        df: DataFrame,
        operation: str = "upsert",
        commit_time: str | None = None,
        options: WriteOptions | None = None,
    ) -> str | None:
        """K1/K5: write one commit; returns its time, or None for an empty input.

        ``upsert`` pre-combines the batch to one row per key (K2) and lets the
        newest commit win at read; ``insert``/``bulk_insert`` append as-is;
        ``delete`` writes tombstones for the keys in ``df``.
        """
        if operation not in OPERATIONS:
            raise ValueError(f"operation must be one of {OPERATIONS}, got {operation!r}")
        options = options or WriteOptions(compression=self.spec.compression)
        self._reload_schema()
        spec = self.spec
        keys = spec.resolve_keys
        if operation == "delete":
            base_schema = self._schema or self._storage_schema(df)
            rows = df.select(*keys).distinct()
            for f in base_schema.fields:
                if f.name not in keys:
                    rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
            rows = rows.select(*[f.name for f in base_schema.fields]).withColumn(DELETED_COL, F.lit(True))
            schema = base_schema
        else:
            rows = df.drop(*[c for c in META_COLS if c in df.columns])
            if operation == "upsert":
                ties = self._tie_breakers(rows)
                # keys alone leave nothing to choose by
                rows = precombine(rows, keys, spec.precombine, ties) if spec.precombine or ties else rows.dropDuplicates(keys)
            schema = self._merge_schema(self._storage_schema(rows))
            rows = rows.withColumn(DELETED_COL, F.lit(False))
        rows = self._guard_keys(rows)
        last = self.last_commit()
        commit = commit_time or _next_commit_time(last)
        if last is not None and commit_time is not None and commit_time <= last:
            raise ValueError(f"commit {commit_time} does not sort after the last commit {last}")
        suffix = {"delete": DELETE_SUFFIX, "upsert": UNIQUE_SUFFIX}.get(operation, "")
        batch = f"{commit}{suffix}"
        written = self._write_batch(
            rows.withColumn(COMMIT_COL, F.lit(commit)), batch, options, floor=self.base_end(), newest=True
        )
        self._pinned = None
        if not written:
            return None
        commit = written.removesuffix(DELETE_SUFFIX).removesuffix(UNIQUE_SUFFIX)
        if schema != self._schema:
            self._write_meta(commit, schema)
        return commit

    def import_changelog(
        self,
        df: DataFrame,
        commit_col: str,
        options: WriteOptions | None = None,
        with_tombstones: bool = False,
        batch_id: str | None = None,
    ) -> str | None:
        """Load many commits in one job: ``commit_col`` holds each row's commit
        time (an ``insert`` per commit, rows kept as they are).

        ``with_tombstones``: ``df`` carries a boolean ``_deleted`` column whose
        true rows are deletes (used to mirror another table's log).
        ``batch_id``: a caller-chosen batch name that makes the import
        idempotent — a replay of an id already written does nothing. Without
        one, commits that do not sort after the newest are refused: a reader
        whose checkpoint is past them would never see them.
        """
        options = options or WriteOptions(compression=self.spec.compression)
        self._reload_schema()
        if batch_id is not None:
            name = f"{batch_id}{DELETE_SUFFIX}" if with_tombstones else batch_id
            if fs.exists(self.spark, f"{self.path}/log/{BATCH_COL}={name}"):
                return None
        rows = df.withColumnRenamed(commit_col, COMMIT_COL) if commit_col != COMMIT_COL else df
        rows = rows.withColumn(COMMIT_COL, F.col(COMMIT_COL).cast("string"))
        schema = self._merge_schema(self._storage_schema(rows))
        deleted = F.coalesce(F.col(DELETED_COL), F.lit(False)) if with_tombstones else F.lit(False)
        rows = self._guard_keys(rows.withColumn(DELETED_COL, deleted))
        batch = batch_id or _dt.datetime.now(_dt.timezone.utc).strftime(COMMIT_FORMAT)[:17] + uuid.uuid4().hex[:6]
        if with_tombstones:
            batch = f"{batch}{DELETE_SUFFIX}"
        written = self._write_batch(rows, batch, options, floor=self.base_end(), newest=batch_id is None)
        self._pinned = None
        if not written:
            return None
        if schema != self._schema:
            self._write_meta(batch, schema)
        return batch

    def delete(self, keys_df: DataFrame, commit_time: str | None = None) -> str | None:
        return self.write(keys_df, operation="delete", commit_time=commit_time)

    # ------------------------------------------------------------------ read
    def _key_join(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Semi or anti join on the resolution keys. Record keys are never NULL, so plain equality lets
        key filters reach both sides; a NULL partition value equals itself."""
        keys = self.spec.resolve_keys
        right = right.select(*[F.col(k).alias(f"__tm_key_{i}") for i, k in enumerate(keys)])
        pairs = [(k, left[k], right[f"__tm_key_{i}"]) for i, k in enumerate(keys)]
        return left.join(right, [a == b if k in self.spec.keys else a.eqNullSafe(b) for k, a, b in pairs], how)

    def _tie_breakers(self, df: DataFrame) -> list[str]:
        if self.spec.tie_breakers is not None:
            return list(self.spec.tie_breakers)
        skip = [*self.spec.resolve_keys, *META_COLS, *([self.spec.precombine] if self.spec.precombine else [])]
        return orderable_columns(df, exclude=skip)

    def _order(self, df: DataFrame) -> list[str]:
        pre = [self.spec.precombine] if self.spec.precombine else []
        ties = self._tie_breakers(df)
        if self.spec.merge_mode == "event_time":
            return pre + [COMMIT_COL] + ties
        return [COMMIT_COL] + pre + ties

    def _read_schema(self) -> T.StructType:
        schema = self._schema or T.StructType([])
        parts = set(self.spec.partition_by)
        data = [f for f in schema.fields if f.name not in parts]
        part_fields = [f for f in schema.fields if f.name in parts]
        return T.StructType(
            data
            + [T.StructField(DELETED_COL, T.BooleanType())]
            + [T.StructField(BATCH_COL, T.StringType()), T.StructField(COMMIT_COL, T.StringType())]
            + part_fields
        )

    def refresh(self) -> CommitLogTable:
        """Drop the pinned view: the next read sees every batch finished by
        then. A table instance otherwise keeps one consistent view across its
        reads until it writes itself (``CommitLogTable.open`` also starts fresh)."""
        self._pinned = None
        return self

    def pin(self) -> tuple[list[str], str | None]:
        """Fix the visible batches and base for the following reads;
        returns (batch names, base end)."""
        if self._pinned is None:
            self._pinned = (self.batches(), self.base_dir())
        batches, base = self._pinned
        return batches, (_end_of(base) if base else None)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self._read_schema())

    def _is_empty(self) -> bool:
        batches, base_end = self.pin()
        return not batches and base_end is None

    def _batch_commits(self) -> dict[str, list[str]]:
        """Commit times inside each pinned batch (one glob call, cached with the pin)."""
        batches, _ = self.pin()
        if getattr(self, "_batch_commit_cache", None) is None or self._batch_commit_cache[0] is not self._pinned:
            found: dict[str, list[str]] = {b: [] for b in batches}
            for p in fs.glob_names(self.spark, f"{self.path}/log/{BATCH_COL}=*/{COMMIT_COL}=*"):
                batch, commit = p.rstrip("/").split("/")[-2:]
                if batch in found:
                    found[batch].append(commit.split("=", 1)[1])
            self._batch_commit_cache = (self._pinned, found)
        return self._batch_commit_cache[1]

    def log(self, after: str | None = None) -> DataFrame:
        """Every version in the visible log batches, tombstones included.

        ``after``: only batches holding a commit later than this are listed
        and read at all (rows are not filtered here; callers filter by commit).
        """
        batches, _ = self.pin()
        if after is not None:
            commits = self._batch_commits()
            batches = [b for b in batches if any(c > after for c in commits.get(b, []))]
        if not batches:
            return self._empty().drop(BATCH_COL)
        paths = [f"{self.path}/log/{b}" for b in batches]
        df = (
            self.spark.read.schema(self._read_schema())
            .option("basePath", f"{self.path}/log")
            .parquet(*paths)
        )
        return df.drop(BATCH_COL)

    def _partial_bases(self) -> bool:
        """Partition-scoped, partitioned tables compact only touched partitions."""
        return bool(self.spec.partition_by) and self.spec.key_scope == "partition"

    def base_paths(self) -> list[str]:
        """Directories the (pinned) base is read from.

        Unpartitioned or table-scoped tables: the newest base. Partition-scoped
        tables: for every first-level partition value, its directory in the
        newest base that holds it (one glob call, no scan).
        """
        self.pin()
        newest = self._pinned[1]
        if newest is None:
            return []
        if not self._partial_bases():
            return [f"{self.path}/base/{newest}"]
        finished = set(self._finished("base"))
        first = self.spec.partition_by[0]
        best: dict[str, tuple[tuple[str, ...], str]] = {}
        for p in fs.glob_names(self.spark, f"{self.path}/base/{BATCH_COL}=*/{first}=*"):
            bdir, pdir = p.rstrip("/").split("/")[-2:]
            if bdir not in finished or _base_key(bdir) > _base_key(newest):
                continue
            if pdir not in best or _base_key(bdir) > best[pdir][0]:
                best[pdir] = (_base_key(bdir), f"{self.path}/base/{bdir}/{pdir}")
        return sorted(v[1] for v in best.values())

    def _base(self) -> DataFrame | None:
        paths = self.base_paths()
        if not paths:
            return None
        if self._partial_bases():
            schema = T.StructType([f for f in self._read_schema().fields])
            df = self.spark.read.schema(schema).option("basePath", f"{self.path}/base").parquet(*paths)
            return df.drop(BATCH_COL)
        schema = T.StructType([f for f in self._read_schema().fields if f.name != BATCH_COL])
        where = paths[0]
        return self.spark.read.schema(schema).option("basePath", where).parquet(where)

    def touched_partitions(self, after: str) -> list[str]:
        """First-level partition directories written by commits after ``after``
        (from directory names)."""
        first = self.spec.partition_by[0]
        batches, _ = self.pin()
        finished = set(batches)
        touched = set()
        for p in fs.glob_names(self.spark, f"{self.path}/log/{BATCH_COL}=*/{COMMIT_COL}=*/{first}=*"):
            b, c, pdir = p.rstrip("/").split("/")[-3:]
            if b in finished and c.split("=", 1)[1] > after:
                touched.add(pdir)
        return sorted(touched)

    def has_tombstones(self) -> bool:
        """Whether any visible log batch came from a delete (from names, no scan)."""
        batches, _ = self.pin()
        return any(b.endswith(DELETE_SUFFIX) for b in batches)

    def _resolve(self, versions: DataFrame) -> DataFrame:
        """Latest live version per key among ``versions`` (tombstones applied)."""
        return resolve_versions(
            versions,
            self.spec.resolve_keys,
            self._order(versions),
            self.spec.merge_mode,
            self.has_tombstones(),
        )

    def snapshot(self, as_of: str | None = None, with_meta: bool = False, of: DataFrame | None = None) -> DataFrame:
        """The table as of its last (or ``as_of``) commit, one row per key.

        With a compacted base only log commits after the base are read (the
        commit filter prunes directories) and only the keys they touch are
        re-resolved: every commit after the base wins over it (``incoming_wins``,
        the base is read once), or is ranked with it (``event_time``).
        ``of``: only these resolution keys; other versions are left out before
        the ranking.
        """
        if self._is_empty():
            return self._finish(self._empty().drop(BATCH_COL), with_meta)
        base_end = self.pin()[1]
        if as_of is not None and base_end is not None and as_of < base_end:
            raise ValueError("as_of is older than the compacted base")
        log = self.log(after=base_end)
        if as_of is not None:
            log = log.filter(F.col(COMMIT_COL) <= F.lit(as_of))
        if of is not None:
            log = self._key_join(log, of, "left_semi")
        batches, _ = self.pin()
        if (
            self._fast_path
            and base_end is None
            and as_of is None
            and len(batches) == 1
            and batches[0].endswith(UNIQUE_SUFFIX)
        ):
            # a single upsert batch holds one row per key already: no ranking
            return self._finish(log.filter(~F.col(DELETED_COL)), with_meta)
        base = self._base()
        if base is None:
            return self._finish(self._resolve(log), with_meta)
        keys = self.spec.resolve_keys
        if of is not None:
            base = self._key_join(base, of, "left_semi")
        after = log.filter(F.col(COMMIT_COL) > F.lit(base_end))
        touched = after.select(*keys).distinct()
        quiet = None
        if self._partial_bases():
            # Base rows of partitions no later commit wrote to (known from
            # directory names) skip the key joins entirely.
            hit = self._partition_match(self.touched_partitions(base_end))
            quiet = base.filter(~F.coalesce(hit, F.lit(False)))
            base = base.filter(hit)
        untouched = self._key_join(base, touched, "left_anti")
        if self.spec.merge_mode == "event_time":
            after = self._key_join(base, touched, "left_semi").unionByName(after)
        redo = self._resolve(after)
        out = untouched.unionByName(redo)
        if quiet is not None:
            out = quiet.unionByName(out)
        return self._finish(out, with_meta)

    def _partition_match(self, partition_dirs: list[str]):
        """Predicate: the first partition column is one of ``partition_dirs``."""
        values = [unquote(d.split("=", 1)[1]) for d in partition_dirs]
        first = F.col(self.spec.partition_by[0])
        cond = first.cast("string").isin([v for v in values if v != NULL_PARTITION])
        if NULL_PARTITION in values:
            cond = cond | first.isNull()
        return cond

    def lookup(self, key: str, values: list, with_meta: bool = False) -> DataFrame:
        """Current rows for some values of one key column (K13 point lookup).

        The filter is on a resolution key, so Catalyst pushes it below the
        ranking window into every scan; parquet min/max statistics and the key
        bloom filters (``enable_meta_data_indexing``) then skip row groups.
        """
        if key not in self.spec.resolve_keys:
            raise ValueError(f"{key} is not a key of this table")
        return self.snapshot(with_meta=with_meta).filter(F.col(key).isin(values))

    def _finish(self, df: DataFrame, with_meta: bool) -> DataFrame:
        df = df.drop(DELETED_COL)
        return df if with_meta else df.drop(COMMIT_COL)

    def dropped_through(self) -> str | None:
        """Last commit whose log batches retention removed (None: log complete)."""
        marks = fs.glob_names(self.spark, f"{self.path}/_meta/{DROP_MARK}*")
        return max((m.rsplit(DROP_MARK, 1)[1] for m in marks), default=None)

    def incremental(
        self,
        begin: str | None,
        end: str | None = None,
        mode: str = "latest_state",
        with_meta: bool = True,
    ) -> DataFrame:
        """What changed in (``begin``, ``end``].

        ``changes`` — every version written in the range (no tombstones);
        available while retention has not removed the range's log batches.
        ``latest_state`` — one row per changed key: the snapshot row, if its
        commit lies in the range. For ``incoming_wins`` without an older base
        the range is pruned first (the winner of a key changed after ``begin``
        lies in it). Otherwise the keys changed in range (from the log and from
        base rows committed in range) are semi-joined back to their history
        and ranked *before* filtering, since a late arrival may lose to an
        older commit.
        """
        if mode not in INCREMENT_MODES:
            raise ValueError(f"mode must be one of {INCREMENT_MODES}")
        if self._is_empty():
            return self._finish(self._empty().drop(BATCH_COL), with_meta)
        base_end = self.pin()[1]
        # batches with no commit after the earliest one needed are not listed
        needed_after = begin
        if mode == "latest_state" and not (
            self.spec.merge_mode == "incoming_wins" and (base_end is None or (begin or "") >= base_end)
        ):
            needed_after = base_end  # the generic path reads the history after the base
        log = self.log(after=needed_after)
        in_range = F.lit(True)
        if begin is not None:
            in_range = in_range & (F.col(COMMIT_COL) > F.lit(begin))
        if end is not None:
            in_range = in_range & (F.col(COMMIT_COL) <= F.lit(end))
        if mode == "changes":
            dropped = self.dropped_through()
            if dropped is not None and (begin is None or begin < dropped):
                raise ValueError(f"changes up to {dropped} were removed by retention")
            return self._finish(log.filter(in_range & ~F.col(DELETED_COL)), with_meta)
        if self.spec.merge_mode == "incoming_wins" and (base_end is None or (begin or "") >= base_end):
            return self._finish(self._resolve(log.filter(in_range)), with_meta)
        keys = self.spec.resolve_keys
        if end is not None and base_end is not None and end < base_end:
            # the base is newer than the range: its log answers, while it is whole
            dropped = self.dropped_through()
            if dropped is not None:
                raise ValueError(f"end is older than the compacted base and the log up to {dropped} was removed")
            log = self.log().filter(F.col(COMMIT_COL) <= F.lit(end))
            if self.spec.merge_mode == "incoming_wins":
                return self._finish(self._resolve(log.filter(in_range)), with_meta)
            changed = log.filter(in_range).select(*keys).distinct()
            return self._finish(self._resolve(self._key_join(log, changed, "left_semi")).filter(in_range), with_meta)
        base = self._base()
        if self.spec.merge_mode == "incoming_wins" and base is not None:
            # a base row keeps its own commit, and one at or before begin never wins
            # against a row in range: one ranking over both, no joins
            history = log.filter(F.col(COMMIT_COL) > F.lit(base_end))
            return self._finish(self._resolve(base.unionByName(history).filter(in_range)), with_meta)
        history = log if base_end is None else log.filter(F.col(COMMIT_COL) > F.lit(base_end))
        if end is not None:
            history = history.filter(F.col(COMMIT_COL) <= F.lit(end))
        changed = history.filter(in_range).select(*keys)
        if base is not None:
            changed = changed.unionByName(base.filter(in_range).select(*keys))
        changed = changed.distinct()
        # the changed keys come first: only their history is ranked (AQE broadcasts them,
        # or splits a hot key's history over tasks of the join)
        versions = self._key_join(history, changed, "left_semi")
        if base is not None:
            versions = self._key_join(base, changed, "left_semi").unionByName(versions)
        out = self._resolve(versions).filter(in_range)
        return self._finish(out, with_meta)

    # ------------------------------------------------------------ maintenance
    def compact(self, options: WriteOptions | None = None, force: bool = False) -> str | None:
        """K6 COPY_ON_WRITE: write the resolved snapshot as a new base.

        Rows keep their own ``_commit_time`` so increments stay correct; the
        log is left in place (``drop_log_through`` removes it explicitly).
        A base already at the last commit is kept unless ``force``.
        """
        self._pinned = None
        batches, base_end = self.pin()
        pinned = self.commits(pinned=True)  # the base holds exactly what it claims
        end = pinned[-1] if pinned else None
        if end is None or (base_end == end and not force):
            return base_end
        parts = list(self.spec.partition_by)
        snap = self.snapshot(with_meta=True).withColumn(DELETED_COL, F.lit(False))
        touched: list[str] | None = None
        if self._partial_bases() and base_end is not None and not force:
            # Only partitions written since the base are re-resolved and
            # rewritten; the filter reaches both scans as a partition filter.
            touched = self.touched_partitions(base_end)
            snap = snap.filter(self._partition_match(touched))
        rows = snap.hint("rebalance", *parts) if parts else snap
        self.write_base(rows, end, options, touched)
        return end

    def write_base(
        self,
        rows: DataFrame,
        end: str,
        options: WriteOptions | None = None,
        partitions: list[str] | None = None,
    ) -> str:
        """Write resolved rows (with ``_commit_time``) as a base ending at ``end``.

        ``partitions`` names the first-level partition directories this base
        replaces; one left without rows (all keys deleted) is created empty so
        it hides the older base. Staged and renamed like log batches.
        """
        options = options or WriteOptions(compression=self.spec.compression)
        stamp = _dt.datetime.now(_dt.timezone.utc).strftime(COMMIT_FORMAT)
        name = f"{BATCH_COL}={end}~{stamp}"
        staging = f"{self.path}/_staging/base-{name}"
        writer = rows.write.mode("errorifexists").option("compression", options.compression)
        if options.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", options.max_records_per_file)
        writer.options(**options.parquet_options).partitionBy(*self.spec.partition_by).parquet(staging)
        for d in partitions or []:
            if not fs.exists(self.spark, f"{staging}/{d}"):
                fs.mkdirs(self.spark, f"{staging}/{d}")
        fs.rename(self.spark, staging, f"{self.path}/base/{name}")
        self._pinned = None
        return name

    def versions(self, n: int, rank_col: str = "version_rank") -> DataFrame:
        """The ``n`` newest versions per key in table order (tombstones excluded)."""
        dropped = self.dropped_through()
        if dropped is not None:
            raise ValueError(f"versions up to {dropped} were removed from the log by retention; read the history it keeps")
        live = self.log().filter(~F.col(DELETED_COL))
        return retain_latest_versions(live, self.spec.resolve_keys, self._order(live), n, rank_col).drop(
            DELETED_COL
        )

    def drop_log_through(self, end: str) -> list[str]:
        """Remove log batches wholly covered by the base ending at ``end``.

        Only batches whose every commit is <= ``end`` go; run after ``compact``.
        """
        if self.base_end() is None or self.base_end() < end:
            raise ValueError("compact up to end before dropping the log")
        self._pinned = None
        covered = [b for b, commits in self._batch_commits().items() if commits and max(commits) <= end]
        if covered:
            # the marker goes first: if the job dies half way, readers already
            # refuse `changes` over the range instead of returning part of it
            fs.touch(self.spark, f"{self.path}/_meta/{DROP_MARK}{end}")
        for b in covered:
            fs.delete(self.spark, f"{self.path}/log/{b}")
        self._pinned = None
        return covered

    def with_spec(self, **changes) -> CommitLogTable:
        """Same storage read with a different spec (e.g. merge mode)."""
        view = CommitLogTable(self.spark, self.path, replace(self.spec, **changes), self._schema)
        view._fast_path = False  # batches were made unique under the stored spec
        return view
