"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Meta columns carried by every commit-log table row.
COMMIT_COL = "_commit_time"
DELETED_COL = "_deleted"

ORDERABLE = (
    T.NumericType,
    T.StringType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BooleanType,
    T.BinaryType,
)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc_order(cols: Iterable[str | Column]) -> list[Column]:
    """Descending, NULLs last: the greatest non-NULL value ranks first."""
    return [_as_col(c).desc_nulls_last() for c in cols]


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of ``df`` with a total order, in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, ORDERABLE)
    ]


def commit_time_of(c: str | Column, pattern: str = "yyyyMMdd") -> Column:
    """Commit-time text of a date/timestamp column (``yyyyMMdd`` by default)."""
    return F.date_format(_as_col(c), pattern)


def stringify(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast ``cols`` to STRING in place (P3). NULL stays NULL (decision D5)."""
    wanted = set(cols)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if f.name in wanted else F.col(f.name)
            for f in df.schema.fields
        ]
    )
