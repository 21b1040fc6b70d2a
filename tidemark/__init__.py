"""tidemark — keyed, commit-stamped lake tables on plain Spark.

Upsert DataFrames into parquet tables by record key with pre-combine
ordering, read them back as snapshots or as the changes since a stored
checkpoint, join them with the DataFrame API / SQL from a declarative source
list, and deliver results to keyed sinks where the last write wins.

Everything is built from Spark built-ins (DataFrame, SQL, windows, joins,
Structured Streaming); there are no custom Catalyst rules.
"""

from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable, TableSpec, WriteOptions
from tidemark.plans.incremental import ChangeFeedSource, CommitLogSource, IncrementalReader, ObservedReader
from tidemark.plans.metrics_view import MaintainedMetrics
from tidemark.plans.write_config import WriteConfig, upsert_table
from tidemark.session import build_session, scale_conf, scratch_dir, scratch_scope
from tidemark.sinks.keyed import KeyedSink, put_partitions
from tidemark.sources.item_files import current_items, put_items, scan_items
from tidemark.sources.loaders import Loaders
from tidemark.streaming.join import join_stream

__all__ = [
    "ChangeFeedSource",
    "CheckpointStore",
    "CommitLogSource",
    "CommitLogTable",
    "IncrementalReader",
    "KeyedSink",
    "Loaders",
    "MaintainedMetrics",
    "ObservedReader",
    "TableSpec",
    "WriteConfig",
    "WriteOptions",
    "build_session",
    "current_items",
    "join_stream",
    "put_items",
    "put_partitions",
    "scale_conf",
    "scan_items",
    "scratch_dir",
    "scratch_scope",
    "upsert_table",
]
