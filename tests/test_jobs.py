"""The reference's two jobs as library calls, FULL and INC."""

from __future__ import annotations

from tidemark import jobs
from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable
from tidemark.sinks.keyed import KeyedSink
from tidemark.sources import generate


def test_seed_then_incremental_deliveries(spark, tmp_table_dir):
    customers = generate.generate_customers(spark, 5)
    orders = generate.generate_orders(spark, 20, 5)
    jobs.seed_tables(spark, customers, orders, f"{tmp_table_dir}/c", f"{tmp_table_dir}/o", catalog_sync=False)
    payload = {
        "check_point_buckets": f"{tmp_table_dir}/ckpt",
        "source": [
            {"source_type": "TABLE", "table_name": "orders", "spark_table_name": "j_orders",
             "path": f"{tmp_table_dir}/o", "type": "INC", "increment_mode": "changes"},
            {"source_type": "TABLE", "table_name": "customers", "spark_table_name": "j_customers",
             "path": f"{tmp_table_dir}/c", "type": "FULL"},
        ],
    }
    sink = KeyedSink(spark, f"{tmp_table_dir}/items", "customer_id", "order_id")
    assert jobs.load_join_deliver(spark, payload, sink, "j_customers", "j_orders") is not None
    assert sink.items().count() == 20
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    first = store.read("orders").last_processed_commit

    # new orders arrive: the next run delivers only them
    more = generate.generate_orders(spark, 30, 5).filter("order_id >= 20")
    CommitLogTable.open(spark, f"{tmp_table_dir}/o").write(more)
    sink2 = KeyedSink(spark, f"{tmp_table_dir}/items2", "customer_id", "order_id", attributes=["order_value"])
    jobs.load_join_deliver(spark, payload, sink2, "j_customers", "j_orders", attributes=["order_value", "city"])
    got = sink2.items()
    assert sorted(r["order_id"] for r in got.collect()) == list(range(20, 30))
    assert got.columns == ["customer_id", "order_id", "order_value"]
    assert store.read("orders").last_processed_commit > first

    # nothing new: empty delivery, checkpoint unchanged
    last = store.read("orders").last_processed_commit
    assert jobs.load_join_deliver(spark, payload, sink2, "j_customers", "j_orders") is None
    assert store.read("orders").last_processed_commit == last
