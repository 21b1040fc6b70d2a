"""The query catalogue: every operator run over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise table writes create their tables in a fresh folder under the shared
checkpoint folder, write through the library, and return what the library
reads back. All inputs are the whole tables; where a query needs two batches
(stored vs incoming) the table is split into two parts that together hold
every row.

Shared inputs (mirrored in the oracle SQL):

* ``EV``  — events with ``commit_time = yyyyMMdd(ts)``.
* ``B``   — the stored batch: events of all other feeds, unknown ones too.
* ``I``   — the incoming batch: events of the error / signup feeds.
* ``LOG`` — every order as a change of its customer, committed at
  ``2024010100 + o_orderkey % 10`` (ten commits).
* ``OC``  — ``yyyyMMdd(o_orderdate)``: orders as a change feed with one commit
  per order day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.functions.columns import COMMIT_COL, commit_time_of
from tidemark.operators import joins, keyed, metrics, timeline
from tidemark.plans import catalog, layout, maintenance
from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.plans.incremental import ChangeFeedSource, IncrementalReader, ObservedReader
from tidemark.plans.metrics_view import MaintainedMetrics
from tidemark.plans.write_config import WriteConfig, upsert_table, upsert_to_gold
from tidemark.session import scratch_dir
from tidemark.sinks.keyed import KeyedSink, item_frame
from tidemark.sources import generate, inventory, items
from tidemark.sources.item_files import current_items, put_items
from tidemark.sources.loaders import Loaders
from tidemark.sources.tables import customers_view, orders_view, read_table
from tidemark.streaming.incremental import upsert_stream
from tidemark.streaming.join import join_stream

# Fixed values of the query catalogue (mirrored in the oracle SQL).
INCOMING_FEEDS = ("error", "signup")
LOG_FIRST_COMMIT = 2024010100
LOG_COMMITS = 10
INC_BEGIN_LOG = "2024010107"
INC_BEGIN_DAY = "20001231"
COMPACT_AT = "2024010105"
INC_BEGIN_AFTER_COMPACTION = "2024010103"
DELETE_VALUE_ABOVE = 200
SQL_TRANSFORM = (
    "SELECT o_orderkey, o_custkey, o_totalprice, upper(o_orderstatus) AS status "
    "FROM {temp} WHERE o_totalprice > 100000"
)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def events_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", commit_time_of("ts").alias("commit_time")
    )


def _feeds(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events stored before and events coming in; unknown and NULL types are stored ones."""
    is_incoming = F.coalesce(F.col("event_type").isin(*INCOMING_FEEDS), F.lit(False))
    return ev.filter(~is_incoming), ev.filter(is_incoming)


def orders_log(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select(
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        (F.lit(LOG_FIRST_COMMIT) + F.col("o_orderkey") % LOG_COMMITS).cast("string").alias("commit_time"),
    )


def _events_table(spark: SparkSession, name: str, mode: str = "incoming_wins") -> CommitLogTable:
    spec = TableSpec(
        name=name,
        keys=("user_id",),
        precombine="ts",
        tie_breakers=("event_id",),
        merge_mode=mode,
        table_type="MERGE_ON_READ",
    )
    return CommitLogTable.create(spark, scratch_dir(spark, name), spec)


def _log_table(spark: SparkSession, sf: str, mode: str = "incoming_wins") -> CommitLogTable:
    spec = TableSpec(
        name="orders_log",
        keys=("o_custkey",),
        precombine="o_orderdate",
        tie_breakers=("o_orderkey",),
        merge_mode=mode,
        table_type="MERGE_ON_READ",
    )
    table = CommitLogTable.create(spark, scratch_dir(spark, "orders_log"), spec)
    table.import_changelog(orders_log(spark, sf), "commit_time")
    return table


def _with_commit_col(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(COMMIT_COL, "commit_time")


# ----------------------------------------------------------------- queries
def customer_orders_join(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship (S5, S1, P1, J1): load sources from a payload, run the join SQL."""
    tag = scratch_dir(spark, "v").rsplit("-", 1)[1]
    names = {k: f"tm_{k}_{tag}" for k in ("customer", "nation", "customers", "orders")}
    payload = {
        "source": [
            {"source_type": "PARQUET", "table_name": "customer", "spark_table_name": names["customer"],
             "path": f"{sf}/customer.parquet", "type": "FULL"},
            {"source_type": "PARQUET", "table_name": "nation", "spark_table_name": names["nation"],
             "path": f"{sf}/nation.parquet", "type": "FULL"},
            {"source_type": "PARQUET", "table_name": "orders", "spark_table_name": names["orders"],
             "path": f"{sf}/orders.parquet", "type": "FULL",
             "select": ["o_orderkey AS order_id", "o_custkey AS customer_id", "o_orderpriority AS name",
                        "o_totalprice AS order_value", "o_orderdate AS order_date"]},
            {"source_type": "SQL", "spark_table_name": names["customers"],
             "query": (f"SELECT c.c_custkey AS customer_id, c.c_name AS name, n.n_name AS state, "
                       f"n.n_name AS city, concat('c', CAST(c.c_custkey AS STRING), '@example.com') AS email "
                       f"FROM {names['customer']} c JOIN {names['nation']} n ON c.c_nationkey = n.n_nationkey")},
        ]
    }
    Loaders(payload, spark).load()
    return joins.customer_orders_sql(spark, names["customers"], names["orders"])


def precombine_latest(spark: SparkSession, sf: str) -> DataFrame:
    """K2: newest event per user."""
    return keyed.precombine(events_changelog(spark, sf), ["user_id"], "ts", ["event_id"])


def upsert_incoming_wins(spark: SparkSession, sf: str) -> DataFrame:
    """K1 K3: upsert B then I into a table; the incoming row replaces the stored one."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    table = _events_table(spark, "ev_incoming")
    table.write(stored, "upsert")
    table.write(incoming, "upsert")
    return table.snapshot()


def upsert_event_time(spark: SparkSession, sf: str) -> DataFrame:
    """Same writes, the later event time wins."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    table = _events_table(spark, "ev_eventtime", mode="event_time")
    table.write(stored, "upsert")
    table.write(incoming, "upsert")
    return table.snapshot()


def upsert_partition_scope(spark: SparkSession, sf: str) -> DataFrame:
    """K4: key unique per (event_type partition, user)."""
    spec = TableSpec(
        name="ev_by_type", keys=("user_id",), precombine="ts", tie_breakers=("event_id",),
        partition_by=("event_type",), key_scope="partition", table_type="MERGE_ON_READ",
    )
    table = CommitLogTable.create(spark, scratch_dir(spark, "ev_by_type"), spec)
    table.write(events_changelog(spark, sf), "upsert")
    return table.snapshot()


def upsert_table_scope(spark: SparkSession, sf: str) -> DataFrame:
    """K4 table scope: partitioned by event type, keyed by user alone — a
    user's row moves between partitions when a newer event has another type."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    spec = TableSpec(
        name="ev_table_scope", keys=("user_id",), precombine="ts", tie_breakers=("event_id",),
        partition_by=("event_type",), key_scope="table", table_type="MERGE_ON_READ",
    )
    table = CommitLogTable.create(spark, scratch_dir(spark, "ev_table_scope"), spec)
    table.write(stored, "upsert")
    table.write(incoming, "upsert")
    return table.snapshot()


def put_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Stored users keep their row; new users are added from I."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    b = keyed.precombine(stored, ["user_id"], "ts", ["event_id"])
    i = keyed.precombine(incoming, ["user_id"], "ts", ["event_id"])
    return keyed.put_if_absent(b, i, ["user_id"])


def keyed_delete(spark: SparkSession, sf: str) -> DataFrame:
    """K5 delete: users with an incoming event above the value limit are removed."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    table = _events_table(spark, "ev_delete")
    table.write(stored, "upsert")
    table.delete(incoming.filter(F.col("value") > DELETE_VALUE_ABOVE))
    return table.snapshot()


def event_time_delete_reinsert(spark: SparkSession, sf: str) -> DataFrame:
    """K5 D11 under event time: upsert B, delete the users with an incoming
    event above the limit, upsert I. Deleted users come back only with
    versions written after the delete."""
    stored, incoming = _feeds(events_changelog(spark, sf))
    table = _events_table(spark, "ev_et_delete", mode="event_time")
    table.write(stored, "upsert")
    table.delete(incoming.filter(F.col("value") > DELETE_VALUE_ABOVE))
    table.write(incoming, "upsert")
    return table.snapshot()


def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    """Latest order per customer over the ten-commit log."""
    return _with_commit_col(_log_table(spark, sf).snapshot(with_meta=True))


def incremental_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer changed after commit 2024010107."""
    return _with_commit_col(_log_table(spark, sf).incremental(INC_BEGIN_LOG, mode="latest_state"))


def incremental_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Every row committed after 2024010107."""
    return _with_commit_col(_log_table(spark, sf).incremental(INC_BEGIN_LOG, mode="changes"))


def incremental_event_time(spark: SparkSession, sf: str) -> DataFrame:
    """S2 in event-time order: rank by order date first, then keep changed rows."""
    table = _log_table(spark, sf, mode="event_time")
    return _with_commit_col(table.incremental(INC_BEGIN_LOG, mode="latest_state"))


def incremental_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """The first six log commits are compacted and their log is
    removed before the rest arrives; the increment after 2024010103 is still
    exact (changed keys come from the base too)."""
    spec = TableSpec(name="orders_log", keys=("o_custkey",), precombine="o_orderdate",
                     tie_breakers=("o_orderkey",), table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, scratch_dir(spark, "orders_log_c"), spec)
    log = orders_log(spark, sf)
    table.import_changelog(log.filter(F.col("commit_time") <= COMPACT_AT), "commit_time")
    table.compact()
    table.drop_log_through(table.base_end())
    table.import_changelog(log.filter(F.col("commit_time") > COMPACT_AT), "commit_time")
    return _with_commit_col(table.incremental(INC_BEGIN_AFTER_COMPACTION, mode="latest_state"))


def retain_latest_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The three newest versions per customer."""
    versions = _log_table(spark, sf).versions(3)
    return _with_commit_col(versions).withColumn("version_rank", F.col("version_rank").cast("int"))


def compacted_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """K6 COPY_ON_WRITE: compact the log, then re-send every open order as an
    upsert; the snapshot resolves the base plus the later commit."""
    table = _log_table(spark, sf)
    table.compact()
    resent = _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    table.write(resent, "upsert")
    return table.snapshot().drop("commit_time")


def commit_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """First 50 commit days of orders."""
    orders = _t(spark, sf, "orders").select(commit_time_of("o_orderdate").alias("oc"))
    return timeline.commit_timeline(orders, "oc", timeline.TIMELINE_CAP)


def begin_instant(spark: SparkSession, sf: str) -> DataFrame:
    """First commit day minus one."""
    orders = _t(spark, sf, "orders").select(commit_time_of("o_orderdate").alias("oc"))
    return timeline.begin_instant(orders, "oc")


def _advance(spark: SparkSession, sf: str, max_commits: int | None) -> DataFrame:
    store = CheckpointStore(spark, scratch_dir(spark, "checkpoints"))
    orders = _t(spark, sf, "orders")
    source = ChangeFeedSource(orders, commit_time_of("o_orderdate"), "orders", f"{sf}/orders.parquet", day_col="o_orderdate")
    store.write("orders", source.path, INC_BEGIN_DAY)
    rows, pending = IncrementalReader(store, source, max_commits).read()
    rows.write.format("noop").mode("overwrite").save()  # the consumer, then progress
    if pending is not None:
        pending.commit()
    return store.latest_frame("orders").select("table_name", "last_processed_commit")


def checkpoint_advance(spark: SparkSession, sf: str) -> DataFrame:
    """Checkpoint after reading everything past 20001231."""
    return _advance(spark, sf, None)


def checkpoint_advance_capped(spark: SparkSession, sf: str) -> DataFrame:
    """Same, bounded to the next 50 commits."""
    return _advance(spark, sf, timeline.TIMELINE_CAP)


def incremental_join_full(spark: SparkSession, sf: str) -> DataFrame:
    """Orders INC (past the checkpoint) joined with customers FULL."""
    root = scratch_dir(spark, "checkpoints")
    CheckpointStore(spark, root).write("orders", f"{sf}/orders.parquet", INC_BEGIN_DAY)
    tag = root.rsplit("-", 1)[1]
    oname, cname = f"tm_inc_orders_{tag}", f"tm_full_customer_{tag}"
    payload = {
        "check_point_buckets": root,
        "source": [
            {"source_type": "PARQUET", "table_name": "orders", "spark_table_name": oname,
             "path": f"{sf}/orders.parquet", "type": "INC",
             "commit_expr": "date_format(o_orderdate, 'yyyyMMdd')", "day_col": "o_orderdate"},
            {"source_type": "PARQUET", "table_name": "customer", "spark_table_name": cname,
             "path": f"{sf}/customer.parquet", "type": "FULL"},
        ],
    }
    Loaders(payload, spark).load()
    return spark.sql(
        f"SELECT c.c_custkey AS customer_id, o.o_orderkey AS order_id, c.c_name AS customer_name, "
        f"o.o_totalprice AS order_value FROM {cname} c JOIN {oname} o ON c.c_custkey = o.o_custkey"
    )


def kv_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders delivered as text items keyed by (customer_id, order_id)."""
    orders = _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderdate").alias("order_date"),
    )
    sink = KeyedSink(spark, scratch_dir(spark, "kv_items"), "customer_id", "order_id")
    sink.put(orders)
    return sink.items().select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_id").cast("string").alias("order_id"),
        "order_value",
        "order_date",
    )


def kv_put_last_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem rows put by (l_orderkey, l_linenumber); the greatest
    (ship date, part, supplier, price, quantity) is the last write."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    latest = keyed.precombine(li, ["l_orderkey", "l_linenumber"], None, order)
    spec = TableSpec(name="lineitem_items", keys=("l_orderkey", "l_linenumber"), tie_breakers=tuple(order),
                     key_scope="table", table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, scratch_dir(spark, "lineitem_items"), spec)
    table.write(latest, "insert")
    return table.snapshot()


def schemaless_items(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as items with an inferred schema."""
    ev = _t(spark, sf, "events").select("event_id", "props")
    return items.expand_items(ev, "props", keep=["event_id"]).select("event_id", F.col("k").cast("bigint").alias("k"))


def sql_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert orders through a SQL transform; read the table back."""
    config = WriteConfig(
        glue_database="tm", table_name="orders_tx", record_id="o_orderkey", precomb_key="o_totalprice",
        table_type="MERGE_ON_READ", partition_fields=None, enable_partition=False, enable_cleaner=False,
        enable_hive_sync=False, enable_clustering=False, enable_meta_data_indexing=True,
        use_sql_transformer=True, sql_transformer_query=SQL_TRANSFORM,
        target_path=scratch_dir(spark, "orders_tx"),
    )
    upsert_table(spark, _t(spark, sf, "orders"), config)
    return CommitLogTable.open(spark, config.target_path).snapshot()


def partitioned_write_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers partitioned by state, registered in the catalog, counted by SQL."""
    customers = customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    name = "customers_" + scratch_dir(spark, "c").rsplit("-", 1)[1]
    config = WriteConfig(
        glue_database=None, table_name=name, record_id="customer_id", precomb_key=None,
        table_type="COPY_ON_WRITE", partition_fields="state", enable_partition=True, enable_cleaner=False,
        enable_hive_sync=True, enable_clustering=False, enable_meta_data_indexing=False,
        use_sql_transformer=False, sql_transformer_query=None, target_path=scratch_dir(spark, name),
        compression="gzip",
    )
    upsert_table(spark, customers, config)
    return spark.sql(f"SELECT state, count(*) AS n_rows FROM {name} GROUP BY state")


def gen_customers(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic customer per customer key."""
    ids = _t(spark, sf, "customer").select(F.col("c_custkey").alias("i"))
    return generate.customers_from_ids(ids)


def gen_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic order per order key, customers drawn from the customer count."""
    n_customers = _t(spark, sf, "customer").select(F.count(F.lit(1))).scalar()
    ids = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("i"))
    return generate.orders_from_ids(ids, n_customers)


def customer_order_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A3: per-customer order count, total, first and last order."""
    joined = joins.customer_orders(
        customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation")),
        orders_view(_t(spark, sf, "orders")),
    )
    return metrics.order_metrics(joined)


def load_join_items(spark: SparkSession, sf: str) -> DataFrame:
    """Both reference jobs end to end — seed the
    customers/orders tables, load them from a payload, join, deliver items."""
    root = scratch_dir(spark, "join_items")
    customers = customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    jobs.seed_tables(
        spark, customers, orders_view(_t(spark, sf, "orders")), f"{root}/customers", f"{root}/orders",
        customer_precombine=None, catalog_sync=False,
    )
    tag = root.rsplit("-", 1)[1]
    cview, oview = f"tm_ji_customers_{tag}", f"tm_ji_orders_{tag}"
    payload = {
        "check_point_buckets": f"{root}/checkpoints",
        "source": [
            {"source_type": "TABLE", "table_name": "orders", "spark_table_name": oview,
             "path": f"{root}/orders", "type": "FULL"},
            {"source_type": "TABLE", "table_name": "customers", "spark_table_name": cview,
             "path": f"{root}/customers", "type": "FULL"},
        ],
    }
    sink = KeyedSink(spark, f"{root}/items", "customer_id", "order_id", name="orders_items")
    jobs.load_join_deliver(spark, payload, sink, cview, oview, unique_keys=True)
    return sink.items()


def load_join_items_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """J2 S3 S4 C3 K17 on tables: a first run delivers every order and stores
    its checkpoint; the open orders are then re-sent to the orders table, and
    the second run delivers exactly those (orders INC, customers FULL)."""
    root = scratch_dir(spark, "join_items_inc")
    customers = customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    orders = _t(spark, sf, "orders")
    jobs.seed_tables(
        spark, customers, orders_view(orders), f"{root}/customers", f"{root}/orders",
        customer_precombine=None, catalog_sync=False,
    )
    tag = root.rsplit("-", 1)[1]
    cview, oview = f"tm_jii_customers_{tag}", f"tm_jii_orders_{tag}"
    payload = {
        "check_point_buckets": f"{root}/checkpoints",
        "source": [
            {"source_type": "TABLE", "table_name": "orders", "spark_table_name": oview,
             "path": f"{root}/orders", "type": "INC"},
            {"source_type": "TABLE", "table_name": "customers", "spark_table_name": cview,
             "path": f"{root}/customers", "type": "FULL"},
        ],
    }
    jobs.load_join_deliver(spark, payload, KeyedSink(spark, f"{root}/items", "customer_id", "order_id"), cview, oview)
    CommitLogTable.open(spark, f"{root}/orders").write(orders_view(orders.filter(F.col("o_orderstatus") == "O")))
    second = KeyedSink(spark, f"{root}/items_second_run", "customer_id", "order_id")
    jobs.load_join_deliver(spark, payload, second, cview, oview)
    return second.items()


def customer_metrics_items(spark: SparkSession, sf: str) -> DataFrame:
    """Per-customer metrics delivered as text items keyed by customer."""
    joined = joins.customer_orders(
        customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation")),
        orders_view(_t(spark, sf, "orders")),
    )
    per_customer = metrics.order_metrics(joined, total_type="decimal(18,2)")
    sink = KeyedSink(spark, scratch_dir(spark, "metric_items"), "customer_id", name="customer_metrics")
    sink.put(per_customer)
    return sink.items().withColumn("customer_id", F.col("customer_id").cast("string"))


def clustered_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """K8: the events table clustered by (event_type, ts); rows are unchanged."""
    from tidemark.plans import maintenance

    spec = TableSpec(name="ev_clustered", keys=("event_id",), precombine="ts", key_scope="table")
    table = CommitLogTable.create(spark, scratch_dir(spark, "ev_clustered"), spec)
    table.write(_t(spark, sf, "events"), "insert")
    maintenance.cluster(table, ["event_type", "ts"], 128 * 1024 * 1024)
    return table.snapshot()


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """§2.9: replicate the order log with an available-now stream; equals the snapshot."""
    source = _log_table(spark, sf)
    target = CommitLogTable.create(spark, scratch_dir(spark, "orders_replica"), source.spec)
    query = upsert_stream(source, target, scratch_dir(spark, "stream_ckpt"))
    query.awaitTermination()
    return _with_commit_col(target.snapshot(with_meta=True))


def object_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Commits whose data files a search of the order log's inventory finds."""
    table = _log_table(spark, sf)
    inv = inventory.object_inventory(spark, f"{table.path}/log", glob="*.parquet")
    found = inventory.find_similar(inv, f"{COMMIT_COL}=[0-9]+/").filter("length > 0")
    commit = F.regexp_extract("path", f"{COMMIT_COL}=([0-9]+)/", 1).alias("commit_time")
    return found.groupBy(commit).agg((F.count(F.lit(1)) > 0).alias("has_files"))


def retention_job(spark: SparkSession, sf: str) -> DataFrame:
    """Retention run twice, the second time after more commits; three versions stay per customer."""
    spec = TableSpec(name="orders_log", keys=("o_custkey",), precombine="o_orderdate",
                     tie_breakers=("o_orderkey",), table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, scratch_dir(spark, "orders_log_r"), spec)
    log = orders_log(spark, sf)
    table.import_changelog(log.filter(F.col("commit_time") <= COMPACT_AT), "commit_time")
    maintenance.retain_versions(table, 3)
    table.import_changelog(log.filter(F.col("commit_time") > COMPACT_AT), "commit_time")
    kept = maintenance.retain_versions(table, 3)
    return _with_commit_col(kept).withColumn("version_rank", F.col("version_rank").cast("int"))


def capped_catch_up_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log is compacted; an increment bounded at 2024010105 is still answered, from the log."""
    table = _log_table(spark, sf)
    table.compact()
    return _with_commit_col(table.incremental(INC_BEGIN_AFTER_COMPACTION, COMPACT_AT, mode="latest_state"))


def catalog_after_second_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, then the open ones at twice the price; SQL on the registered table sees both."""
    name = "orders_cow_" + scratch_dir(spark, "c").rsplit("-", 1)[1]
    config = WriteConfig(
        glue_database=None, table_name=name, record_id="o_orderkey", precomb_key="o_orderdate",
        table_type="COPY_ON_WRITE", partition_fields=None, enable_partition=False, enable_cleaner=False,
        enable_hive_sync=True, enable_clustering=False, enable_meta_data_indexing=False,
        use_sql_transformer=False, sql_transformer_query=None, target_path=scratch_dir(spark, name),
        compression="gzip",
    )
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    upsert_table(spark, orders, config)
    again = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    upsert_table(spark, again, config)
    return spark.sql(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice FROM {name}")


def checkpoint_reset(spark: SparkSession, sf: str) -> DataFrame:
    """C4: after a reset the next incremental read delivers every order again."""
    store = CheckpointStore(spark, scratch_dir(spark, "checkpoints"))
    source = ChangeFeedSource(_t(spark, sf, "orders"), commit_time_of("o_orderdate"), "orders", f"{sf}/orders.parquet", day_col="o_orderdate")
    _, pending = IncrementalReader(store, source).read()
    pending.commit()
    store.reset("orders")
    rows, _ = IncrementalReader(store, source).read()
    return rows.select("o_orderkey", "o_orderdate")


def empty_increment(spark: SparkSession, sf: str) -> DataFrame:
    """T4 A2: nothing is new after the last commit, so the read is empty and stores no checkpoint."""
    store = CheckpointStore(spark, scratch_dir(spark, "checkpoints"))
    source = ChangeFeedSource(_t(spark, sf, "orders"), commit_time_of("o_orderdate"), "orders", f"{sf}/orders.parquet", day_col="o_orderdate")
    _, pending = IncrementalReader(store, source).read()
    pending.commit()
    rows, nothing = IncrementalReader(store, source).read()
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("has_checkpoint", F.lit(nothing is not None))


def empty_write_guard(spark: SparkSession, sf: str) -> DataFrame:
    """An upsert that selects nothing creates no commit and leaves the table as it was."""
    table = _log_table(spark, sf)
    before = table.commits()
    none = orders_log(spark, sf).filter(F.col("o_orderkey") < 0).drop("commit_time")
    created = table.write(none, "upsert")
    same = created is None and CommitLogTable.open(spark, table.path).commits() == before
    return _with_commit_col(table.snapshot(with_meta=True)).withColumn("unchanged", F.lit(same))


def item_attribute_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Customers delivered as items with two of their attributes."""
    sink = KeyedSink(spark, scratch_dir(spark, "kv_subset"), "c_custkey", attributes=["c_name", "c_nationkey"])
    sink.put(_t(spark, sf, "customer"))
    return sink.items().select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_nationkey")


def metrics_after_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A3 S3: metrics kept up to date from increments. A first commit holds the open and the pending
    orders; the second adds the filled ones and moves the open ones (double price, a day later); the
    third deletes the pending ones. Each is merged into the stored metrics on its own."""
    orders, status = _t(spark, sf, "orders"), F.col("o_orderstatus")
    spec = TableSpec(name="orders", keys=("order_id",), key_scope="table", table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, scratch_dir(spark, "orders_m"), spec)
    kept = MaintainedMetrics(spark, table, scratch_dir(spark, "customer_metrics"))
    filled = F.coalesce(status == "F", F.lit(False))
    table.write(orders_view(orders.filter(~filled)))
    kept.refresh()
    moved = orders_view(orders.filter(status == "O")).withColumns(
        {"order_value": F.col("order_value") * 2, "order_date": F.col("order_date") + F.expr("INTERVAL 1 DAY")})
    table.write(orders_view(orders.filter(filled)).unionByName(moved))
    kept.refresh()
    table.delete(orders_view(orders.filter(status == "P")))
    kept.refresh()
    return kept.read(customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation")))


def stream_join_items(spark: SparkSession, sf: str) -> DataFrame:
    """J2 §2.9: the orders table's commits as a stream, joined with the customers and delivered as
    items. A first run delivers every order; the open orders are then sent again, and the restarted
    stream delivers exactly those."""
    root = scratch_dir(spark, "stream_join")
    orders = _t(spark, sf, "orders")
    spec = TableSpec(name="orders", keys=("order_id",), key_scope="table", table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, f"{root}/orders", spec)
    customers = customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    table.write(orders_view(orders))
    join_stream(table, customers, KeyedSink(spark, f"{root}/items", "customer_id", "order_id"), f"{root}/progress").awaitTermination()
    table.write(orders_view(orders.filter(F.col("o_orderstatus") == "O")))
    second = KeyedSink(spark, f"{root}/items_second_run", "customer_id", "order_id")
    join_stream(table, customers, second, f"{root}/progress").awaitTermination()
    return second.items()


def item_segments_join(spark: SparkSession, sf: str) -> DataFrame:
    """The orders exported as items, scanned by segments through the loader and joined with the customers."""
    root = scratch_dir(spark, "order_export")
    orders = orders_view(_t(spark, sf, "orders"))
    orders.select(F.to_json(F.struct(*orders.columns))).write.text(root)
    tag = root.rsplit("-", 1)[1]
    names = {k: f"tm_seg_{k}_{tag}" for k in ("customers", "orders")}
    customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation")).createOrReplaceTempView(f"{names['customers']}_all")
    payload = {
        "source": [
            {"source_type": "ITEMS", "spark_table_name": names["orders"], "path": root, "segments": 16,
             "schema": "order_id long, customer_id long, name string, order_value double, order_date timestamp_ntz"},
            {"source_type": "SQL", "spark_table_name": names["customers"], "query": f"SELECT * FROM {names['customers']}_all"},
        ]
    }
    Loaders(payload, spark).load()
    return joins.customer_orders_sql(spark, names["customers"], names["orders"])


def item_writer_put(spark: SparkSession, sf: str) -> DataFrame:
    """All orders put as items by the data source's tasks, then the open ones at twice the price; the last put wins."""
    path = scratch_dir(spark, "item_files")
    orders, keys = _t(spark, sf, "orders"), ("customer_id", "order_id")
    attributes = ["order_value", "order_date"]
    put_items(item_frame(orders_view(orders), *keys, attributes), path, "2024010100")
    again = orders_view(orders.filter(F.col("o_orderstatus") == "O")).withColumn("order_value", F.col("order_value") * 2)
    put_items(item_frame(again, *keys, attributes), path, "2024010101")
    return current_items(spark, path, "customer_id long, order_id long, order_value string, order_date string", keys)


def gen_orders_for_customers(spark: SparkSession, sf: str) -> DataFrame:
    """One order per order key, its customer drawn from a sparse set of ids: customers that have orders."""
    orders = _t(spark, sf, "orders")
    return generate.orders_for_customers(orders.select(F.col("o_orderkey").alias("i")), orders, "o_custkey")


def small_file_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """K9: orders stored in small files by status, rewritten to files of about 256 KiB within each folder."""
    root = scratch_dir(spark, "small_files")
    _t(spark, sf, "orders").repartition(24).write.partitionBy("o_orderstatus").parquet(f"{root}/in")
    layout.rewrite_small_files(spark, f"{root}/in", f"{root}/out", 128 * 1024, 256 * 1024, ["o_orderstatus"])
    return spark.read.parquet(f"{root}/out").withColumn("o_orderstatus", F.col("o_orderstatus").cast("string"))


def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """K8: events clustered by time within their type, in about 24 files; no two files of a type overlap."""
    spec = TableSpec(name="ev_layout", keys=("event_id",), precombine="ts", partition_by=("event_type",), key_scope="partition")
    table = CommitLogTable.create(spark, scratch_dir(spark, "ev_layout"), spec)
    table.write(_t(spark, sf, "events"), "insert")
    maintenance.cluster(table, ["ts"], maintenance.table_bytes(spark, f"{table.path}/log") // 24)
    rows = spark.read.option("basePath", f"{table.path}/base/{table.base_dir()}").parquet(*table.base_paths())
    report = layout.clustering_report(rows, ["ts", "event_id"], ["event_type"])
    return report.select("event_type", "n_rows", "overlapping")


def column_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the orders' columns from the catalog; the distinct count is held against the exact one."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name = "orders_stats_" + scratch_dir(spark, "s").rsplit("-", 1)[1]
    spec = TableSpec(name=name, keys=("o_orderkey",), key_scope="table", table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, scratch_dir(spark, name), spec)
    table.write(orders, "insert")
    catalog.register(spark, table, name)
    maintenance.analyze(spark, name, orders.columns)
    stats = maintenance.column_stats(spark, name, orders.columns)
    exact = spark.table(name).agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "column_name", "exact")
    # the catalog's estimate may be off by three times its standard error
    near = F.abs(F.col("distinct_count").cast("double") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.15)
    return stats.join(exact, "column_name").select(
        "column_name", "min", "max", F.col("num_nulls").cast("long").alias("num_nulls"), near.alias("distinct_near"))


def checkpoint_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The checkpoint's commit is observed while the rows go to the sink, in one scan."""
    store = CheckpointStore(spark, scratch_dir(spark, "checkpoints"))
    store.write("orders", f"{sf}/orders.parquet", INC_BEGIN_DAY)
    source = ChangeFeedSource(_t(spark, sf, "orders"), commit_time_of("o_orderdate"), "orders", f"{sf}/orders.parquet", day_col="o_orderdate")
    out = scratch_dir(spark, "observed")
    ObservedReader(store, source).deliver(lambda rows: rows.write.parquet(out))
    latest = store.read("orders")
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("last_processed_commit", F.lit(latest.last_processed_commit))


def gold_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Orders through the second helper; with each row the codec of the stored files."""
    root = scratch_dir(spark, "gold")
    name = "driver_earnings_" + root.rsplit("-", 1)[1]
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    upsert_to_gold(spark, orders, root, name, "o_orderkey", "o_orderdate", table_type="MERGE_ON_READ")
    table = CommitLogTable.open(spark, f"{root}/gold/table_name={name}")
    table.write(orders.filter("o_totalprice > 100000").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    table.compact()
    base = spark.read.parquet(*table.base_paths())
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"\.([a-z0-9]+)\.parquet$", 1)
    return base.select(*orders.columns, codec.alias("codec"))


def local_rows_join(spark: SparkSession, sf: str) -> DataFrame:
    """The nations (25 rows) as local rows with an explicit schema, joined with every customer."""
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = [r.asDict() for r in nation.collect()]  # a fixed dimension
    states = generate.rows_to_frame(spark, rows, nation.schema)
    customer = _t(spark, sf, "customer")
    return customer.join(states, customer["c_nationkey"] == states["n_nationkey"]).select("c_custkey", "c_name", F.col("n_name").alias("state"))


def partitioned_write_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers partitioned by state, every row read back by name from the catalog."""
    customers = customers_view(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    name = "customers_rows_" + scratch_dir(spark, "c").rsplit("-", 1)[1]
    config = WriteConfig(
        glue_database=None, table_name=name, record_id="customer_id", precomb_key=None,
        table_type="COPY_ON_WRITE", partition_fields="state", enable_partition=True, enable_cleaner=False,
        enable_hive_sync=True, enable_clustering=False, enable_meta_data_indexing=False,
        use_sql_transformer=False, sql_transformer_query=None, target_path=scratch_dir(spark, name),
        compression="gzip",
    )
    upsert_table(spark, customers, config)
    return spark.sql(f"SELECT customer_id, name, state, city, email FROM {name}")


def sink_last_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem rows put into the item sink by (l_orderkey, l_linenumber); the greatest
    (ship date, part, supplier, price, quantity) is the last write."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    sink = KeyedSink(spark, scratch_dir(spark, "lineitem_sink"), "l_orderkey", "l_linenumber", attributes=order, order_by=order)
    sink.put(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *order))
    return sink.items().select("l_orderkey", "l_linenumber", *order)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer_orders_join": customer_orders_join,
    "precombine_latest": precombine_latest,
    "upsert_incoming_wins": upsert_incoming_wins,
    "upsert_event_time": upsert_event_time,
    "upsert_partition_scope": upsert_partition_scope,
    "upsert_table_scope": upsert_table_scope,
    "put_if_absent": put_if_absent,
    "keyed_delete": keyed_delete,
    "snapshot_read": snapshot_read,
    "incremental_latest_state": incremental_latest_state,
    "incremental_changes": incremental_changes,
    "incremental_event_time": incremental_event_time,
    "incremental_after_compaction": incremental_after_compaction,
    "event_time_delete_reinsert": event_time_delete_reinsert,
    "retain_latest_versions": retain_latest_versions,
    "compacted_snapshot": compacted_snapshot,
    "commit_timeline": commit_timeline,
    "begin_instant": begin_instant,
    "checkpoint_advance": checkpoint_advance,
    "checkpoint_advance_capped": checkpoint_advance_capped,
    "incremental_join_full": incremental_join_full,
    "kv_items": kv_items,
    "kv_put_last_write_wins": kv_put_last_write_wins,
    "schemaless_items": schemaless_items,
    "sql_transform": sql_transform,
    "partitioned_write_counts": partitioned_write_counts,
    "gen_customers": gen_customers,
    "gen_orders": gen_orders,
    "customer_order_metrics": customer_order_metrics,
    "load_join_items": load_join_items,
    "load_join_items_incremental": load_join_items_incremental,
    "customer_metrics_items": customer_metrics_items,
    "clustered_rewrite": clustered_rewrite,
    "stream_upsert": stream_upsert,
    "object_inventory": object_inventory,
    "retention_job": retention_job,
    "capped_catch_up_after_compaction": capped_catch_up_after_compaction,
    "catalog_after_second_upsert": catalog_after_second_upsert,
    "checkpoint_reset": checkpoint_reset,
    "empty_increment": empty_increment,
    "empty_write_guard": empty_write_guard,
    "item_attribute_subset": item_attribute_subset,
    "metrics_after_changes": metrics_after_changes,
    "stream_join_items": stream_join_items,
    "item_segments_join": item_segments_join,
    "item_writer_put": item_writer_put,
    "gen_orders_for_customers": gen_orders_for_customers,
    "small_file_rewrite": small_file_rewrite,
    "clustered_layout": clustered_layout,
    "column_stats": column_stats,
    "checkpoint_observed": checkpoint_observed,
    "gold_upsert": gold_upsert,
    "partitioned_write_rows": partitioned_write_rows,
    "sink_last_write_wins": sink_last_write_wins,
    "local_rows_join": local_rows_join,
}
