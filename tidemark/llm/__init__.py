"""Operators of a training-data pipeline: mixing, chat formatting, archives,
vector search, near-duplicate detection, quality, packing, scoring, token
counts, fill-in-middle, source audits and url filters. Nothing else in the library imports this subpackage."""
