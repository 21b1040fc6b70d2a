"""A customer owning a third of all orders: joins split, aggregates pre-combine.

The hot key is derived from the driver's orders table (every third order is
re-assigned to customer 0). Broadcast is switched off and the skew thresholds
are lowered so the small test data behaves like a large shuffle; the input is
spread over several map tasks, because AQE splits a skewed reduce partition
at map-output boundaries (a cluster has thousands of map tasks).
"""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, metrics
from tidemark.sources.tables import customers_view, orders_view, read_table

SF = "/root/testdata/sf0.01"
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture()
def hot_orders(spark):
    orders = read_table(spark, SF, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    )
    return orders.repartition(8)


def _final(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_the_hot_customer(spark, hot_orders):
    with conf(spark, SKEW_CONF):
        customers = customers_view(read_table(spark, SF, "customer"), read_table(spark, SF, "nation"))
        joined = joins.customer_orders(customers, orders_view(hot_orders))
        rows, plan = _final(joined)
    assert "SortMergeJoin(skew=true)" in plan and "skewed" in plan
    assert len(rows) == 15_000
    assert sum(1 for r in rows if r["customer_id"] == 0) == 5_000 + sum(
        1 for r in read_table(spark, SF, "orders").filter("o_custkey = 0 AND o_orderkey % 3 <> 0").collect()
    )


def test_metrics_pre_aggregate_the_hot_customer(spark, hot_orders):
    with conf(spark, SKEW_CONF):
        customers = customers_view(read_table(spark, SF, "customer"), read_table(spark, SF, "nation"))
        per_customer = metrics.order_metrics(joins.customer_orders(customers, orders_view(hot_orders)))
        rows, plan = _final(per_customer)
    assert "partial_count" in plan and "partial_sum" in plan
    hot = next(r for r in rows if r["customer_id"] == 0)
    assert hot["n_orders"] >= 5_000
    assert sum(r["n_orders"] for r in rows) == 15_000
