"""Stream-static join: a table's changes joined with a static table, delivered as items (J2, §2.9).

The changing side (orders) is read as a stream of its finished commits; the static side
(customers) is an ordinary DataFrame, read again by every micro-batch. As with an INC
source joined with a FULL one, only changed rows give output: a change on the static side
alone gives nothing.

Items go out through ``foreachBatch``. Each micro-batch becomes one batch of the item
table, named after the stream and the epoch and stamped with the source's commit times:

- a micro-batch replayed after a failure finds its batch written and adds nothing;
- an item delivered by several micro-batches resolves to its newest source commit,
  however the stream splits the backlog;
- a restart without new commits runs no micro-batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import COMMIT_COL, DELETED_COL, stringify
from tidemark.operators.joins import customer_orders
from tidemark.plans.commitlog import CommitLogTable, per_commit_winners
from tidemark.sinks.keyed import KeyedSink
from tidemark.streaming.incremental import change_stream


def _items_of(static: DataFrame, changed: DataFrame) -> DataFrame:
    return customer_orders(static, changed, keep=[COMMIT_COL])


def join_stream(
    source: CommitLogTable,
    static: DataFrame,
    sink: KeyedSink,
    checkpoint_location: str,
    join: Callable[[DataFrame, DataFrame], DataFrame] = _items_of,
    max_files_per_trigger: int | None = 1000,
) -> StreamingQuery:
    """Start an available-now stream of ``source``'s new versions, joined with ``static`` into ``sink``.

    ``join`` takes (static, changed rows) and gives the item columns and ``_commit_time``; it is part
    of the streaming plan. Deletes of the source give no items. Of several rows of one key in one
    commit (``insert`` batches) the greatest by the item's attributes stays.
    """
    tag = hashlib.sha1(checkpoint_location.encode("utf-8")).hexdigest()[:10]
    changed = change_stream(source, max_files_per_trigger)
    joined = join(static, changed.filter(~F.col(DELETED_COL)).drop(DELETED_COL))

    def deliver(batch: DataFrame, epoch: int) -> None:
        table = sink.ensure()
        attributes = [c for c in batch.columns if c not in (*sink.keys, COMMIT_COL) and (sink.attributes is None or c in sink.attributes)]
        items = stringify(batch.select(*sink.keys, *attributes, COMMIT_COL), attributes).withColumn(DELETED_COL, F.lit(False))
        items = per_commit_winners(items, sink.keys, table._order(items)).drop(DELETED_COL)
        table.import_changelog(items, COMMIT_COL, batch_id=f"j{tag}-{epoch:012d}")

    return joined.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
