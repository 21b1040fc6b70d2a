"""Sinks: keyed item delivery (last write wins)."""

from tidemark.sinks.keyed import KeyedSink, put_partitions

__all__ = ["KeyedSink", "put_partitions"]
