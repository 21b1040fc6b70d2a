"""Per-customer order metrics over the join result (A3).

The reference's title promises aggregates pushed to the key-value table; the
metrics are a ``groupBy(customer_id)`` with partial aggregation before the
shuffle, so a customer owning a third of the orders costs one row per map
task at the exchange. Money is summed as a wide DECIMAL so the total does not
depend on the order rows are added in; text that is no amount, or one too
large for it, fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10


def amount_of(value: str, scale: int = SCALE) -> Column:
    """A row's exact amount; null stays null, text that is no amount (or too large) fails the job:
    in ANSI mode the cast itself, otherwise its null."""
    # 28 digits of a row's amount leave ten for the sum
    amount = F.col(value).cast(f"decimal(28,{scale})")
    bad = F.raise_error(F.concat(F.lit(f"not an amount in {value}: "), F.col(value).cast("string"))).cast(f"decimal(28,{scale})")
    return F.when(F.col(value).isNull() | amount.isNotNull(), amount).otherwise(bad)


def order_metrics(
    joined: DataFrame,
    key: str = "customer_id",
    value: str = "order_value",
    date: str = "order_date",
    total_type: str = "double",
    scale: int = SCALE,
) -> DataFrame:
    """``total_type`` is the type of the exact DECIMAL(38, ``scale``) total on
    output (``decimal(18,2)`` keeps it exact for text items)."""
    return joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(amount_of(value, scale)).cast(total_type).alias("total_value"),
        F.min(date).alias("first_order"),
        F.max(date).alias("last_order"),
    )


def metrics_delta(
    before: DataFrame, after: DataFrame, key: str = "customer_id", value: str = "order_value", date: str = "order_date"
) -> DataFrame:
    """What changed orders do to their customers' metrics: old images are taken away, new ones added.

    ``before`` and ``after`` hold the changed orders as they were and as they are (an order that is
    new is only in ``after``, a deleted one only in ``before``). Each is summed for itself, in tasks of
    its own, with partial sums before the shuffle; then two rows of a customer meet at most.
    """
    # one digit less, as the difference of two 38-digit decimals would lose one behind the point
    narrow = f"decimal(37,{SCALE})"
    both = _sums(before, key, value, date, "taken").join(_sums(after, key, value, date, "added"), key, "full_outer")
    added, taken = ({c: F.coalesce(F.col(f"{side}_{c}"), F.lit(0)) for c in ("orders", "value", "amounts")} for side in ("added", "taken"))
    return both.select(
        key,
        (added["orders"] - taken["orders"]).alias("d_orders"),
        (added["value"].cast(narrow) - taken["value"].cast(narrow)).alias("d_value"),
        *[side["amounts"].alias(f"{name}_amounts") for name, side in (("added", added), ("taken", taken))],
        "added_first", "added_last", "taken_first", "taken_last",
    )


def _sums(images: DataFrame, key: str, value: str, date: str, side: str) -> DataFrame:
    return images.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{side}_orders"),
        F.sum(amount_of(value)).alias(f"{side}_value"),
        F.count(value).alias(f"{side}_amounts"),
        F.min(date).alias(f"{side}_first"),
        F.max(date).alias(f"{side}_last"),
    )


def apply_delta(state: DataFrame, delta: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers of ``delta`` with their new metrics, from ``state`` (n_orders, total_value, n_amounts,
    first_order, last_order).

    ``lost`` marks customers whose earliest or latest order may have left: an old image was at the
    extreme and no new one reaches it. Their dates have to be read again; all others are exact.
    """
    # one digit less, as a sum of two 38-digit decimals would lose one behind the point
    narrow = f"decimal(37,{SCALE})"
    total = F.coalesce("total_value", F.lit(0)).cast(narrow) + F.col("d_value").cast(narrow)
    amounts = F.coalesce("n_amounts", F.lit(0)) + F.col("added_amounts") - F.col("taken_amounts")
    met = delta.join(state, key, "left")
    first_left = (F.col("taken_first") <= F.col("first_order")) & ~F.coalesce(F.col("added_first") <= F.col("first_order"), F.lit(False))
    last_left = (F.col("taken_last") >= F.col("last_order")) & ~F.coalesce(F.col("added_last") >= F.col("last_order"), F.lit(False))
    n = (F.coalesce("n_orders", F.lit(0)) + F.col("d_orders")).cast("long")
    return met.select(
        key,
        n.alias("n_orders"),
        F.when(amounts > 0, total.cast(f"decimal(38,{SCALE})")).alias("total_value"),
        amounts.cast("long").alias("n_amounts"),
        F.least("first_order", "added_first").alias("first_order"),
        F.greatest("last_order", "added_last").alias("last_order"),
        ((n > 0) & F.coalesce(first_left | last_left, F.lit(False))).alias("lost"),
    )
