"""Reading the driver's parquet tables and mapping them onto the reference model.

The reference's two tables are ``customers`` (customer_id, name, state, city,
email, ...) and ``orders`` (order_id, name, order_value, priority, order_date,
customer_id). Over the TPC-H-style inputs they are projections; parquet
column pruning and filter pushdown apply through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers_view(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customers: key ``c_custkey``, state and city from the nation name.

    ``nation`` is a fixed 25-row dimension; Catalyst broadcasts it from its
    file-size statistics (well under the broadcast threshold).
    """
    c, n = customer.alias("c"), nation.alias("n")
    return c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "inner").select(
        F.col("c.c_custkey").alias("customer_id"),
        F.col("c.c_name").alias("name"),
        F.col("n.n_name").alias("state"),
        F.col("n.n_name").alias("city"),
        F.concat(F.lit("c"), F.col("c.c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )


def orders_view(orders: DataFrame) -> DataFrame:
    """orders: key ``o_orderkey``, name/priority from ``o_orderpriority``."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderdate").alias("order_date"),
    )
