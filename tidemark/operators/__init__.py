"""Relational operators: keyed merge primitives, joins, timeline, metrics."""

from tidemark.operators.joins import customer_orders, customer_orders_sql
from tidemark.operators.keyed import (
    delete_keys,
    latest_per_key,
    precombine,
    put_if_absent,
    retain_latest_versions,
    scoped_keys,
    upsert,
)
from tidemark.operators.metrics import order_metrics
from tidemark.operators.timeline import begin_instant, commit_timeline, last_commit

__all__ = [
    "begin_instant",
    "commit_timeline",
    "customer_orders",
    "customer_orders_sql",
    "delete_keys",
    "last_commit",
    "latest_per_key",
    "order_metrics",
    "precombine",
    "put_if_absent",
    "retain_latest_versions",
    "scoped_keys",
    "upsert",
]
