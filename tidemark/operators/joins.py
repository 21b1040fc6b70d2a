"""Joins (J1, J2) and the reference's projection.

The flagship is the reference's SQL text run over whatever views the loader
registered: customers JOIN orders ON customer_id. Strategy is left to
Catalyst + AQE: sort-merge on ``customer_id`` for two large sides (AQE's
skew-join splits a customer that owns a third of all orders), broadcast when
a side's size is measured to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the reference's join query, column for column (the two view
# names are parameters).
CUSTOMER_ORDERS_SQL = """
SELECT  c.customer_id,
        o.order_id,
        c.city,
        c.name AS customer_name,
        c.email,
        o.name AS order_name,
        o.order_value,
        o.order_date
FROM {customers} c
JOIN {orders} o ON c.customer_id = o.customer_id
"""

JOIN_COLUMNS = (
    "customer_id",
    "order_id",
    "city",
    "customer_name",
    "email",
    "order_name",
    "order_value",
    "order_date",
)


def customer_orders_sql(spark: SparkSession, customers: str = "customers", orders: str = "orders") -> DataFrame:
    """J1 over registered views."""
    return spark.sql(CUSTOMER_ORDERS_SQL.format(customers=customers, orders=orders))


def customer_orders(customers: DataFrame, orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """J1 + P1 in DataFrame form: one row per matching (customer, order) pair;
    NULL keys never match. ``keep``: further columns of the orders."""
    c, o = customers.alias("c"), orders.alias("o")
    return c.join(o, F.col("c.customer_id") == F.col("o.customer_id"), "inner").select(
        F.col("c.customer_id"),
        F.col("o.order_id"),
        F.col("c.city"),
        F.col("c.name").alias("customer_name"),
        F.col("c.email"),
        F.col("o.name").alias("order_name"),
        F.col("o.order_value"),
        F.col("o.order_date"),
        *[F.col(f"o.{c}") for c in keep],
    )
