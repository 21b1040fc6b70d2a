"""Synthetic customers and orders.

The reference builds rows in driver loops with a fake-data library; here each
attribute is column arithmetic over an id column, so generation is a
distributed projection of any id source (``spark.range(n)`` or the keys of
an existing table) and the output is deterministic. Values follow the
reference's shapes: every column is text except the ids, ``order_value`` is
an integer 10..1000 rendered as text, ``priority`` one of three levels,
``order_date`` a ``yyyy-MM-dd`` day within 30 days of the anchor, and every
order's ``customer_id`` is one of the generated customers (ids ``0..n-1``), or
of a given set of ids (``orders_for_customers``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import dense_numbers

# The reference's order priorities and date window.
PRIORITIES = ("LOW", "MEDIUM", "HIGH")
ORDER_DAYS_BACK = 30

ANCHOR_DAY = "2024-01-30"
CREATED_AT_ORIGIN = "2024-01-01 00:00:00"


def _mix(i: Column, mult: int, add: int, mod: int | Column) -> Column:
    return (i * F.lit(mult) + F.lit(add)) % mod


def customers_from_ids(ids: DataFrame, id_col: str = "i") -> DataFrame:
    """S10 over an id column: name, state, city, email, created_at, address."""
    i = F.col(id_col).cast("bigint")
    return ids.select(
        i.alias("customer_id"),
        F.concat(F.lit("name_"), i.cast("string")).alias("name"),
        F.concat(F.lit("state_"), _mix(i, 37, 11, 50).cast("string")).alias("state"),
        F.concat(F.lit("city_"), _mix(i, 53, 7, 200).cast("string")).alias("city"),
        F.concat(F.lit("c"), i.cast("string"), F.lit("@example.com")).alias("email"),
        F.date_format(
            F.lit(CREATED_AT_ORIGIN).cast(T.TimestampNTZType()) + F.make_dt_interval(secs=i.cast("decimal(18,6)")),
            "yyyy-MM-dd'T'HH:mm:ss",
        ).alias("created_at"),
        F.concat(
            _mix(i, 7, 1, 9999).cast("string"), F.lit(" Main St, "), F.lit("city_"), _mix(i, 53, 7, 200).cast("string")
        ).alias("address"),
    )


def orders_from_ids(ids: DataFrame, n_customers: int | Column, id_col: str = "i") -> DataFrame:
    """S11 over an id column; ``customer_id`` drawn from ``0..n_customers-1``."""
    if isinstance(n_customers, int) and n_customers < 1:
        raise ValueError("orders need at least one customer to belong to")
    i = F.col(id_col).cast("bigint")
    priority = F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), (_mix(i, 31, 5, len(PRIORITIES)) + 1).cast("int"))
    day = F.date_sub(F.lit(ANCHOR_DAY).cast("date"), _mix(i, 17, 3, ORDER_DAYS_BACK + 1).cast("int"))
    return ids.select(
        i.alias("order_id"),
        F.substring(F.concat(F.lit("order "), i.cast("string")), 1, 20).alias("name"),
        (F.lit(10) + _mix(i, 104729, 7, 991)).cast("string").alias("order_value"),
        priority.alias("priority"),
        F.date_format(day, "yyyy-MM-dd").alias("order_date"),
        _mix(i, 7919, 13, n_customers).cast("bigint").alias("customer_id"),
    )


def orders_for_customers(ids: DataFrame, customers: DataFrame, customer_col: str, id_col: str = "i") -> DataFrame:
    """S11 over given customers: every order draws, with replacement, one of the ids in ``customers``.

    Any set of ids will do, sparse or of another type: ids are numbered densely and the draws
    joined to the numbers, so every order has a customer of the set.
    """
    numbered, n = dense_numbers(customers, customer_col)
    if n < 1:
        raise ValueError("orders need at least one customer to belong to")
    drawn = orders_from_ids(ids, n, id_col)
    numbered = numbered.select(F.col("number").alias("__tm_draw"), F.col(customer_col).alias("__tm_id"))
    met = drawn.join(numbered, drawn["customer_id"] == numbered["__tm_draw"])
    return met.select(*[c for c in drawn.columns if c != "customer_id"], F.col("__tm_id").alias("customer_id"))


def generate_customers(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    return customers_from_ids(spark.range(0, n, 1, num_partitions).withColumnRenamed("id", "i"))


def generate_orders(spark: SparkSession, m: int, n_customers: int, num_partitions: int | None = None) -> DataFrame:
    return orders_from_ids(spark.range(0, m, 1, num_partitions).withColumnRenamed("id", "i"), n_customers)


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Local rows with an explicit schema (small fixtures, tests)."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
