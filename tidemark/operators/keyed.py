"""Keyed primitives, pure DataFrame -> DataFrame.

All of them reduce to two shapes Spark executes well at any size:

* latest-per-key: ``row_number() <= n`` over ``PARTITION BY keys``. Catalyst
  plans a *partial* ``WindowGroupLimit`` before the shuffle, so a key that
  holds a third of all rows is cut down to ``n`` rows per map task before it
  reaches the exchange — hot keys do not pile up in one reducer.
* key-set difference: a left-anti join on the keys. Both sides are unique per
  key at that point (pre-combined), so the join is skew-free; AQE broadcasts
  the smaller side when its runtime size is under the broadcast threshold and
  sort-merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import desc_order, orderable_columns

RANK_COL = "__tm_rank"
SOURCE_COL = "__tm_src"

MERGE_MODES = ("incoming_wins", "event_time")
KEY_SCOPES = ("partition", "table")


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def ranked(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str | Column],
    n: int,
    rank_col: str = RANK_COL,
) -> DataFrame:
    """Rows ranked ``1..n`` per key (greatest ``order_by`` first, NULLs last)."""
    if not order_by:
        raise ValueError("ranking needs at least one ordering column")
    w = Window.partitionBy(*_keys(keys)).orderBy(*desc_order(order_by))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the one greatest in ``order_by`` (all descending)."""
    return ranked(df, keys, order_by, 1).drop(RANK_COL)


def default_tie_breakers(
    df: DataFrame, keys: Sequence[str], precombine: str | None
) -> list[str]:
    """Decision D10: without explicit tie-breakers every remaining orderable
    column breaks ties, so the winner never depends on arrival order."""
    return orderable_columns(df, exclude=[*keys, *([precombine] if precombine else [])])


def precombine(
    df: DataFrame,
    keys: str | Sequence[str],
    precombine_col: str | None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """K2: of the rows with one key keep the greatest pre-combine value."""
    keys = _keys(keys)
    ties = list(tie_breakers) if tie_breakers is not None else default_tie_breakers(
        df, keys, precombine_col
    )
    order = ([precombine_col] if precombine_col else []) + ties
    return latest_per_key(df, keys, order)


def scoped_keys(
    keys: str | Sequence[str], partition_by: Sequence[str] = (), key_scope: str = "partition"
) -> list[str]:
    """K4: a key is unique per partition (``partition``) or per table (``table``)."""
    if key_scope not in KEY_SCOPES:
        raise ValueError(f"key_scope must be one of {KEY_SCOPES}, got {key_scope!r}")
    keys = _keys(keys)
    if key_scope == "table":
        return keys
    return [p for p in partition_by if p not in keys] + keys


def upsert(
    base: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    precombine_col: str | None,
    tie_breakers: Sequence[str] | None = None,
    mode: str = "incoming_wins",
) -> DataFrame:
    """K3: merge ``incoming`` into ``base`` by key; new keys insert.

    ``incoming_wins`` — the pre-combined incoming row replaces the stored one.
    ``event_time`` — the greater pre-combine value wins, incoming on ties
    (decision D11). ``base`` is expected to hold one row per key.
    """
    if mode not in MERGE_MODES:
        raise ValueError(f"mode must be one of {MERGE_MODES}, got {mode!r}")
    keys = _keys(keys)
    ties = list(tie_breakers) if tie_breakers is not None else default_tie_breakers(
        incoming, keys, precombine_col
    )
    fresh = precombine(incoming, keys, precombine_col, ties)
    if mode == "incoming_wins":
        kept = base.join(fresh.select(*keys), on=keys, how="left_anti")
        return fresh.unionByName(kept)
    both = base.withColumn(SOURCE_COL, F.lit(0)).unionByName(
        fresh.withColumn(SOURCE_COL, F.lit(1))
    )
    order = ([precombine_col] if precombine_col else []) + [SOURCE_COL] + ties
    return latest_per_key(both, keys, order).drop(SOURCE_COL)


def put_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str]
) -> DataFrame:
    """Stored rows stay; incoming rows are added only for new keys."""
    keys = _keys(keys)
    return existing.unionByName(incoming.join(existing.select(*keys), on=keys, how="left_anti"))


def delete_keys(base: DataFrame, deletes: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """K5 ``delete``: drop every base row whose key appears in ``deletes``.

    The delete keys are made distinct first (partial aggregation), so a key
    repeated across many delete rows reaches the join once.
    """
    keys = _keys(keys)
    return base.join(deletes.select(*keys).distinct(), on=keys, how="left_anti")


def retain_latest_versions(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str | Column],
    n: int,
    rank_col: str = "version_rank",
) -> DataFrame:
    """Keep the ``n`` newest versions of every key, numbered from 1."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return ranked(df, keys, order_by, n, rank_col=rank_col)
