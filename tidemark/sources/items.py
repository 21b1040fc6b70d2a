"""Schemaless key-value items to DataFrames.

Items are JSON documents. A whole export is read by the JSON reader, which
infers one schema over *all* records in a distributed pass (missing keys
become NULL, nested objects structs, lists arrays) — every page of the scan,
not just the first (decision D8). A JSON string column is expanded the same
way: ``schema_of_variant_agg`` merges the per-row schemas in an aggregate,
then ``from_json`` parses with the merged schema.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_items(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON-lines item export (one item per line) as a DataFrame."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.option("prefersDecimal", "true").json(path)


def variant_schema_to_ddl(schema: str) -> str:
    """``OBJECT<k: BIGINT>`` (variant schema text) -> ``STRUCT<k: BIGINT>``."""
    # a type stands at the start, behind a field's colon or inside a list; names stay
    return re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", schema)


def infer_json_schema(df: DataFrame, json_col: str) -> str:
    """Merged DDL schema of a JSON string column (one aggregate job)."""
    row = df.agg(F.schema_of_variant_agg(F.parse_json(F.col(json_col))).alias("s")).first()
    return variant_schema_to_ddl(row["s"])


def expand_items(df: DataFrame, json_col: str, schema: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Parse ``json_col`` into top-level columns next to ``keep``."""
    ddl = schema or infer_json_schema(df, json_col)
    if not ddl.startswith("STRUCT<") and schema is None:
        return df.select(*(keep or []))  # no items, so no fields
    parsed: Column = F.from_json(F.col(json_col), ddl)
    return df.select(*(keep or []), parsed.alias("__item")).select(*(keep or []), "__item.*")


def item_field(json_col: str, path: str, type_name: str) -> Column:
    """One typed attribute of each item (NULL when absent)."""
    return F.try_variant_get(F.parse_json(F.col(json_col)), path, type_name)
