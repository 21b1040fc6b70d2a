"""Session construction (G1) and the shared scratch location.

The reference configures Kryo plus the options of its table format; only the
serializer carries over (the table format is ours and needs no extension).
AQE is switched on so joins pick broadcast vs sort-merge from runtime sizes
and split skewed partitions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from tidemark import fs

# Settings every tidemark job wants; cluster-level values (memory, executor
# count, shuffle partitions at scale) are left to the deployment.
DEFAULT_CONF: dict[str, str] = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with tidemark's defaults, ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory). Only when neither is set — local tests — a fresh
    folder is created and registered; elsewhere a missing setting is an error,
    as a machine-local folder would lose what other machines write.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Tables written by queries and tests live here so every executor can read
    them back (never a machine-local temp folder on a cluster).
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("tidemark_scratch_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside the block when it ends.

    Results that read them are lazy, so consume them (write them elsewhere, count them)
    before the block ends. Nested blocks remove their own folders only.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            fs.delete(spark, path)


def job_args(argv: list[str], required: list[str]) -> dict[str, str]:
    """Parse ``--NAME value`` job arguments (G2); missing names raise."""
    found: dict[str, str] = {}
    it = iter(argv)
    for token in it:
        if token.startswith("--"):
            found[token[2:]] = next(it, "")
    missing = [r for r in required if r not in found]
    if missing:
        raise ValueError(f"missing job arguments: {missing}")
    return found


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Shuffle partitions start at about one per ``partition_bytes`` of input so
    a reducer's share fits executor memory without spilling; AQE then merges
    small ones toward the advisory size and splits skewed ones. Scan splits
    use the same size, so a task reads at most that much parquet.
    """
    n = max(1, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        # on a busy cluster size post-shuffle partitions by bytes, not core count
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
