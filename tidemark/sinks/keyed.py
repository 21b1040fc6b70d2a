"""Keyed item sink, last write wins.

The reference collects the join to the driver and saves one item per row.
Here delivery is distributed:

* ``KeyedSink`` stores items in a tidemark table keyed by (hash key, range
  key): the batch is pre-combined per key by ``order_by`` ("last" write
  = greatest order), attributes are cast to text, and the commit is one
  parallel parquet write. A later put of the same key wins at read, so a
  retried or replayed batch gives the same items.
* ``put_partitions`` pushes items to an external key-value service: rows are
  pre-combined, hash-partitioned on the item key (each key is written by
  exactly one task) and sent in fixed-size batches per partition by a client
  the caller provides. Nothing passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import orderable_columns, stringify
from tidemark.operators.keyed import precombine
from tidemark.plans.commitlog import CommitLogTable, TableSpec, WriteOptions
from tidemark.plans.maintenance import commits_since_base


def item_frame(
    df: DataFrame,
    hash_key: str,
    range_key: str | None = None,
    attributes: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Keys and attributes (as text) of every item; with ``order_by`` one per key."""
    keys = [hash_key] + ([range_key] if range_key else [])
    attrs = [c for c in (attributes if attributes is not None else df.columns) if c not in keys]
    if order_by:
        # the other columns break ties, so a retry keeps the same row
        df = precombine(df, keys, None, [*order_by, *orderable_columns(df, exclude=[*keys, *order_by])])
    return stringify(df.select(*keys, *attrs), attrs)


class KeyedSink:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        hash_key: str,
        range_key: str | None = None,
        attributes: Sequence[str] | None = None,
        order_by: Sequence[str] | None = None,
        name: str = "items",
        compact_every: int = 10,
    ):
        self.spark = spark
        self.path = path
        self.hash_key = hash_key
        self.range_key = range_key
        self.attributes = list(attributes) if attributes is not None else None
        self.order_by = list(order_by) if order_by else None
        self.name = name
        self.compact_every = compact_every  # puts between compactions, 0: never
        self._table: CommitLogTable | None = None

    @property
    def keys(self) -> list[str]:
        return [self.hash_key] + ([self.range_key] if self.range_key else [])

    def ensure(self) -> CommitLogTable:
        """Create the item table when missing (idempotent)."""
        if self._table is None:
            spec = TableSpec(
                name=self.name,
                keys=tuple(self.keys),
                precombine=None,
                tie_breakers=None,
                key_scope="table",
                merge_mode="incoming_wins",
                table_type="MERGE_ON_READ",
            )
            self._table = CommitLogTable.create(self.spark, self.path, spec)
        return self._table

    def put(self, df: DataFrame, options: WriteOptions | None = None, unique_keys: bool = False) -> str | None:
        """Write every row of ``df`` as an item; returns the commit time.

        ``unique_keys``: the batch is expected to hold one row per item key
        (e.g. a join of two keyed snapshots), so the pre-combine shuffle is
        skipped. Without ``order_by`` this is safe even if the expectation
        fails: reads resolve leftover duplicates with the same ordering the
        pre-combine would have used.
        """
        items = item_frame(df, self.hash_key, self.range_key, self.attributes, self.order_by)
        # With order_by the batch is already one row per key; without it the
        # upsert pre-combines on every attribute so the winner is deterministic.
        op = "insert" if (self.order_by or unique_keys) else "upsert"
        return self._compacted(self.ensure().write(items, operation=op, options=options), options)

    def _compacted(self, commit: str | None, options: WriteOptions | None) -> str | None:
        """Reads rank what was put since the last compaction, so that stays bounded."""
        table = self.ensure()
        if commit is not None and self.compact_every and commits_since_base(table.refresh()) >= self.compact_every:
            table.compact(options)
        return commit

    def put_if_absent(self, df: DataFrame, options: WriteOptions | None = None) -> str | None:
        """K21 on the store: write only items whose key is not stored yet;
        stored items are left as they are. Returns the commit time (None when
        every key was present)."""
        items = item_frame(df, self.hash_key, self.range_key, self.attributes, self.order_by)
        table = self.ensure().refresh()  # stored keys as of now, other writers included
        if table.last_commit() is not None:
            items = items.join(table.snapshot().select(*self.keys), on=self.keys, how="left_anti")
        op = "insert" if self.order_by else "upsert"
        return self._compacted(table.write(items, operation=op, options=options), options)

    def items(self) -> DataFrame:
        """Current items, one per key."""
        return CommitLogTable.open(self.spark, self.path).snapshot()


def put_partitions(
    df: DataFrame,
    make_client: Callable[[], object],
    hash_key: str,
    range_key: str | None = None,
    attributes: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    batch_size: int = 25,
    num_partitions: int | None = None,
) -> None:
    """Push items to an external store with ``client.put_batch(list[dict])``.

    Items are rendered to JSON on the JVM side; Python only groups them into
    batches. Puts are idempotent by key, so task retries and speculative
    copies are safe.
    """
    items = item_frame(df, hash_key, range_key, attributes, order_by)
    keys = [hash_key] + ([range_key] if range_key else [])
    # Partition on the full item key: each key is still sent by exactly one
    # task, and a hash key owning a large share of items spreads over tasks.
    payload = items.select(F.to_json(F.struct(*items.columns)).alias("item"), *keys)
    payload = payload.repartition(num_partitions, *keys) if num_partitions else payload.repartition(*keys)

    def send(rows: Iterable) -> None:
        client = make_client()
        batch: list[dict] = []
        for row in rows:
            batch.append(json.loads(row["item"]))
            if len(batch) >= batch_size:
                client.put_batch(batch)
                batch = []
        if batch:
            client.put_batch(batch)

    payload.select("item").foreachPartition(send)


def preview(df: DataFrame, n: int = 20, enabled: bool = False) -> None:
    """Console preview, only on request (it runs an extra job)."""
    if enabled:
        df.show(n, truncate=False)
