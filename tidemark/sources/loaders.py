"""Config-driven multi-source loader.

A payload lists sources; each is read FULL (snapshot) or INC (changes since
its checkpoint) and registered as a temp view under ``spark_table_name``:

    {"check_point_buckets": "<checkpoint root>",
     "source": [{"source_type": "TABLE" | "PARQUET" | "ITEMS" | "SQL",
                 "table_name": ..., "spark_table_name": ..., "path": ...,
                 "type": "FULL" | "INC", ...}]}

``TABLE`` is a tidemark commit-log table (the reference's lake table),
``PARQUET`` a plain dataset (INC needs ``commit_expr``, a SQL expression
giving each row's commit time; where that is a date column's day, naming it as
``day_col`` brings the range to the scan), ``ITEMS`` a key-value item export
(schema inferred; with ``schema`` it is scanned by ``segments`` tasks), ``SQL`` a view defined by ``query`` over views loaded
before it.

Unknown kinds always raise (decision D7). Read errors raise unless
``on_error="skip"``, which records a status per source instead. INC sources
return their pending checkpoints; ``LoadResult.commit()`` stores them once
the caller's sink succeeded (decision D3).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable
from tidemark.plans.incremental import (
    ChangeFeedSource,
    CommitLogSource,
    IncrementalReader,
    PendingCheckpoint,
)
from tidemark.sources.item_files import scan_items
from tidemark.sources.items import read_items

SOURCE_TYPES = ("TABLE", "PARQUET", "ITEMS", "SQL")
LOAD_TYPES = ("FULL", "INC")


@dataclass(frozen=True)
class SourceSpec:
    source_type: str
    spark_table_name: str
    table_name: str = ""
    path: str = ""
    type: str = "FULL"
    commit_expr: str | None = None
    query: str | None = None
    select: tuple[str, ...] | None = None
    increment_mode: str = "latest_state"
    max_commits: int | None = None
    schema: str | None = None
    segments: int | None = None
    day_col: str | None = None

    @classmethod
    def from_dict(cls, d: dict) -> SourceSpec:
        known = {k: v for k, v in d.items() if k in cls.__dataclass_fields__}
        if "select" in known and known["select"] is not None:
            known["select"] = tuple(known["select"])
        spec = cls(**known)
        if spec.source_type not in SOURCE_TYPES:
            raise ValueError(f"unknown source_type {spec.source_type!r}; expected one of {SOURCE_TYPES}")
        if spec.type not in LOAD_TYPES:
            raise ValueError(f"unknown load type {spec.type!r}; expected one of {LOAD_TYPES}")
        return spec


@dataclass
class LoadResult:
    status: dict[str, bool] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    pending: list[PendingCheckpoint] = field(default_factory=list)
    frames: dict[str, DataFrame] = field(default_factory=dict)

    def commit(self) -> None:
        """Store the checkpoints of every INC source read by this load."""
        for p in self.pending:
            p.commit()
        self.pending = []


class Loaders:
    """Load every source of a payload into a temp view.

    ``type_aliases`` maps other ``source_type`` names onto ours (e.g. an
    existing payload's lake-table kind onto ``TABLE``), so a payload written
    for another loader can be used as it is.
    """

    def __init__(
        self,
        payload: dict,
        spark: SparkSession,
        on_error: str = "raise",
        type_aliases: dict[str, str] | None = None,
    ):
        if on_error not in ("raise", "skip"):
            raise ValueError("on_error must be 'raise' or 'skip'")
        self.spark = spark
        aliases = type_aliases or {}
        self.specs = [
            SourceSpec.from_dict({**s, "source_type": aliases.get(s.get("source_type"), s.get("source_type"))})
            for s in payload.get("source", [])
        ]
        root = payload.get("check_point_buckets")
        self.store = CheckpointStore(spark, root) if root else None
        self.on_error = on_error

    def _read(self, spec: SourceSpec) -> tuple[DataFrame, PendingCheckpoint | None]:
        spark = self.spark
        if spec.source_type == "SQL":
            return spark.sql(spec.query), None
        if spec.source_type == "ITEMS":
            if spec.schema:
                return scan_items(spark, spec.path, spec.schema, spec.segments), None
            return read_items(spark, spec.path), None
        if spec.source_type == "TABLE":
            table = CommitLogTable.open(spark, spec.path)
            if spec.type == "FULL":
                return table.snapshot(), None
            source = CommitLogSource(table, spec.increment_mode, spec.table_name or table.spec.name)
        else:
            df = spark.read.parquet(spec.path)
            if spec.select:
                df = df.selectExpr(*spec.select)
            if spec.type == "FULL":
                return df, None
            if not spec.commit_expr:
                raise ValueError(f"INC over PARQUET needs commit_expr ({spec.spark_table_name})")
            source = ChangeFeedSource(df, F.expr(spec.commit_expr), spec.table_name or spec.spark_table_name, spec.path, spec.day_col)
        if self.store is None:
            raise ValueError("INC sources need check_point_buckets")
        df, pending = IncrementalReader(self.store, source, spec.max_commits).read()
        return df, pending

    def load(self) -> LoadResult:
        result = LoadResult()
        for spec in self.specs:
            try:
                df, pending = self._read(spec)
                if spec.select and spec.source_type != "PARQUET":
                    df = df.selectExpr(*spec.select)
                df.createOrReplaceTempView(spec.spark_table_name)
                result.frames[spec.spark_table_name] = df
                if pending is not None:
                    result.pending.append(pending)
                result.status[spec.spark_table_name] = True
            except Exception as exc:  # noqa: BLE001 - status mode records, raise mode re-raises
                if self.on_error == "raise":
                    raise
                result.status[spec.spark_table_name] = False
                result.errors[spec.spark_table_name] = str(exc)
        return result
