"""Per-customer metrics kept up to date from the orders table's increments (A3, S3).

``MaintainedMetrics`` stores one row per customer in a keyed table. A refresh reads the
orders that changed since the table's last commit, as they were then and as they are now,
takes the old images away and adds the new ones, and merges these sums into the stored
rows. Only customers whose earliest or latest order left have their dates read again.

The stored rows carry the last order commit they include as their own commit time, in
one batch with the rows of customers that have no order left (tombstones). Progress and
rows are therefore one atomic commit: a refresh that fails is simply repeated, and one
that finds nothing new writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import COMMIT_COL, DELETED_COL
from tidemark.operators.metrics import SCALE, amount_of, apply_delta, metrics_delta
from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.session import scratch_dir

METRICS = ["n_orders", "total_value", "n_amounts", "first_order", "last_order"]


class MaintainedMetrics:
    """``orders``: a keyed table with the columns ``key``, ``value`` and ``date``; the metrics live at ``path``."""

    def __init__(
        self,
        spark: SparkSession,
        orders: CommitLogTable,
        path: str,
        key: str = "customer_id",
        value: str = "order_value",
        date: str = "order_date",
    ):
        self.spark, self.orders, self.key, self.value, self.date = spark, orders, key, value, date
        spec = TableSpec(name="customer_metrics", keys=(key,), tie_breakers=(), key_scope="table", table_type="MERGE_ON_READ")
        self.table = CommitLogTable.create(spark, path, spec)

    def refresh(self) -> str | None:
        """Bring the metrics to the orders table's last commit; returns it, or None when nothing changed."""
        begin = self.table.refresh().last_commit()
        self.orders.refresh()
        end = self.orders.last_commit()
        if end is None or (begin is not None and end <= begin):
            return None
        base_end = self.orders.pin()[1]
        if begin is None or (base_end is not None and base_end > begin):
            # nothing stored, or the old images went into a newer base: start from the whole table
            rows = self._recomputed(begin)
        else:
            rows = self._merged(begin, end)
        gone = (F.col("n_orders") == 0).alias(DELETED_COL)
        rows = rows.select(self.key, *METRICS, gone, F.lit(end).alias(COMMIT_COL))
        written = self.table.import_changelog(rows, COMMIT_COL, with_tombstones=True, batch_id=f"m{end}")
        return end if written else None

    def _whole(self, orders: DataFrame) -> DataFrame:
        return orders.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum(amount_of(self.value)).cast(f"decimal(38,{SCALE})").alias("total_value"),
            F.count(self.value).alias("n_amounts"), F.min(self.date).alias("first_order"), F.max(self.date).alias("last_order"))

    def _recomputed(self, begin: str | None) -> DataFrame:
        rows = self._whole(self.orders.snapshot())
        if begin is None:
            return rows
        vanished = self.table.snapshot().select(self.key).join(rows, self.key, "left_anti")
        return rows.unionByName(vanished.withColumn("n_orders", F.lit(0).cast("long")), allowMissingColumns=True)

    def _merged(self, begin: str, end: str) -> DataFrame:
        keys = self.orders.spec.resolve_keys
        in_range = (F.col(COMMIT_COL) > F.lit(begin)) & (F.col(COMMIT_COL) <= F.lit(end))
        # deletes count as changes, so the keys come from the log itself
        changed = self.orders.log(after=begin).filter(in_range).select(*keys).distinct()
        before = self.orders.snapshot(as_of=begin, of=changed)
        if self.orders.spec.merge_mode == "incoming_wins":
            # a changed order's newest version is in the range: its history is not read again
            after = self.orders.incremental(begin, end, with_meta=False)
        else:
            after = self.orders.snapshot(as_of=end, of=changed)
        images = [rows.select(self.key, self.value, self.date) for rows in (before, after)]
        delta = self._written(metrics_delta(*images, self.key, self.value, self.date), "metrics-delta")
        state = self.table.snapshot(of=delta.select(self.key))
        merged = self._written(apply_delta(state, delta, self.key), "metrics-merged")
        lost = merged.filter("lost").select(self.key)
        if lost.isEmpty():
            return merged.drop("lost")
        dates = self.orders.snapshot(as_of=end).join(lost, self.key, "left_semi").groupBy(self.key).agg(
            F.min(self.date).alias("first_again"), F.max(self.date).alias("last_again"))
        return merged.join(dates, self.key, "left").select(
            self.key, "n_orders", "total_value", "n_amounts",
            F.when(F.col("lost"), F.col("first_again")).otherwise(F.col("first_order")).alias("first_order"),
            F.when(F.col("lost"), F.col("last_again")).otherwise(F.col("last_order")).alias("last_order"))

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows used twice, one per changed customer: computed once."""
        path = scratch_dir(self.spark, name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def read(self, customers: DataFrame | None = None) -> DataFrame:
        """Current metrics; with ``customers``, of those alone (the inner join's rows)."""
        rows = self.table.refresh().snapshot()
        rows = rows.join(customers.select(self.key).distinct(), self.key, "left_semi") if customers is not None else rows
        return rows.select(self.key, "n_orders", F.col("total_value").cast("double").alias("total_value"), "first_order", "last_order")
