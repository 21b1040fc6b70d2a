"""Structured Streaming form of the incremental path."""

from tidemark.streaming.incremental import change_stream, upsert_stream

__all__ = ["change_stream", "upsert_stream"]
