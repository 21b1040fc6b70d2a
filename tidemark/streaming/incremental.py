"""Structured Streaming form of the incremental pull (S3 streaming, §2.9).

The source table's finished log batches are read by the parquet file source
(batches appear in ``log/`` by an atomic rename, whole); progress lives in the
stream's own checkpoint instead of a checkpoint document. Each micro-batch is
mirrored into the target *with the source's commit times and tombstones*, cut
to one version per (key, commit) first. The target therefore resolves exactly
like the source, however the stream splits the backlog into micro-batches
(``max_files_per_trigger``). With ``trigger(availableNow=True)`` the stream
drains what is there and stops — the batch job of the reference, restartable
from its checkpoint.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fs
from tidemark.functions.columns import COMMIT_COL, DELETED_COL
from tidemark.plans.commitlog import BATCH_COL, CommitLogTable, per_commit_winners


def change_stream(source: CommitLogTable, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every version the source commits, as a stream (tombstones included)."""
    reader = source.spark.readStream.schema(source._read_schema()).option("basePath", f"{source.path}/log")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{source.path}/log").drop(BATCH_COL)


BOOTSTRAP_MARK = "_tidemark_bootstrap"


def _bootstrap(source: CommitLogTable, target: CommitLogTable, checkpoint_location: str, tag: str) -> str | None:
    """First start only: copy the source's compacted base into the target.

    Log batches the base covers may be gone already, so a new mirror starts
    from the base and streams only commits after its end. The end is kept
    in a marker inside the stream checkpoint, so restarts apply the same cut.
    """
    marks = fs.glob_names(source.spark, f"{checkpoint_location}/{BOOTSTRAP_MARK}-*")
    if marks:
        end = marks[0].rsplit(f"{BOOTSTRAP_MARK}-", 1)[1]
        return end or None
    if fs.exists(source.spark, f"{checkpoint_location}/offsets"):
        return None  # a stream that started before this marker existed
    source.refresh()
    end = source.base_end()
    if end is not None:
        base = source._base()
        # a fixed name: a copy repeated after a crash before the marker does nothing
        target.import_changelog(base.drop(DELETED_COL), COMMIT_COL, batch_id=f"s{tag}-base")
    fs.mkdirs(source.spark, checkpoint_location)
    fs.touch(source.spark, f"{checkpoint_location}/{BOOTSTRAP_MARK}-{end or ''}")
    return end


def upsert_stream(
    source: CommitLogTable,
    target: CommitLogTable,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = 1000,
) -> StreamingQuery:
    """Mirror ``source`` into ``target`` (same keys and ordering), one target
    batch per micro-batch.

    Micro-batches are bounded by ``max_files_per_trigger``; the mirror is exact however the backlog is split, and ``availableNow`` still
    drains all of it.
    """
    keys = source.spec.resolve_keys
    # epochs of this stream map to fixed batch names: a micro-batch replayed
    # after a failure finds its batch already written and does nothing
    stream_tag = hashlib.sha1(checkpoint_location.encode("utf-8")).hexdigest()[:10]

    def apply(batch: DataFrame, epoch: int) -> None:
        # any micro-batch may hold tombstones, so none has to be read twice
        versions = per_commit_winners(batch, keys, source._order(batch))
        target.import_changelog(versions, COMMIT_COL, with_tombstones=True, batch_id=f"s{stream_tag}-{epoch:012d}")

    changes = change_stream(source, max_files_per_trigger)
    start_after = _bootstrap(source, target, checkpoint_location, stream_tag)
    if start_after is not None:
        changes = changes.filter(F.col(COMMIT_COL) > F.lit(start_after))
    writer = (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
