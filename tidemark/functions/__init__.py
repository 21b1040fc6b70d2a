"""Column-level helpers: ordering specs, casts, commit-time formats, flags."""

from tidemark.functions.columns import (
    COMMIT_COL,
    DELETED_COL,
    commit_time_of,
    desc_order,
    stringify,
)
from tidemark.functions.flags import parse_flag

__all__ = [
    "COMMIT_COL",
    "DELETED_COL",
    "commit_time_of",
    "desc_order",
    "parse_flag",
    "stringify",
]
