"""Catalog registration.

A COPY_ON_WRITE table is registered as a persistent SQL view over two external
tables, its base and its log: rows of the base whose key no later commit touched,
and the newest version of every key in the commits after it, ranked at read. A
write therefore writes its own rows only; registering adds its directories to the
log table's partitions and replaces the view, without a moment in which the name is
missing. The base is rewritten by compaction, on its own cadence.

A MERGE_ON_READ table (and a COPY_ON_WRITE one in ``event_time`` mode, whose base is
brought to the last commit first) is registered as an external table over the
compacted base, its partitions recovered: a read-optimized view, as of the last
compaction. Re-registering after a later compaction points the table at the newer
base.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark import fs
from tidemark.functions.columns import COMMIT_COL, DELETED_COL
from tidemark.plans.commitlog import BATCH_COL, CommitLogTable, WriteOptions

PARTITIONS_PER_STATEMENT = 500


PATH_PROPERTY = "tidemark.path"


def _facts(spark: SparkSession, qualified: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect()}


def _exists(spark: SparkSession, qualified: str) -> bool:
    return spark.catalog.tableExists(qualified.replace("`", ""))


def _refuse_foreign(spark: SparkSession, qualified: str, path: str) -> str | None:
    """What the name is now: None, VIEW or EXTERNAL. Raise if it is anything but a registration of the table
    at ``path``: its view, or an external table below it (whose data a drop keeps)."""
    if not _exists(spark, qualified):
        return None
    facts = _facts(spark, qualified)
    own = re.sub(r"^file:/+", "/", path).rstrip("/") + "/"
    if facts.get("Type") == "VIEW":
        stated = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {qualified}").collect()}
        if stated.get(PATH_PROPERTY) == path:
            return "VIEW"
    elif facts.get("Type") == "EXTERNAL" and re.sub(r"^file:/+", "/", facts.get("Location", "")).startswith(own):
        return "EXTERNAL"
    raise ValueError(f"{qualified} exists and is not a registration of the table at {path}")


def _quoted(database: str | None, name: str) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _add_partitions(spark: SparkSession, qualified: str, found: list[tuple[dict[str, str], str]]) -> None:
    """Register (values, directory) pairs, many per statement; known ones stay."""
    specs = [f"PARTITION ({', '.join(f'`{k}` = {_text(v)}' for k, v in values.items())}) LOCATION {_text(where)}" for values, where in found]
    for i in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS " + " ".join(specs[i : i + PARTITIONS_PER_STATEMENT]))


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _helper(spark: SparkSession, database: str | None, name: str, kind: str, columns: list[T.StructField], parts: list[T.StructField], location: str) -> str:
    """An external table named by its columns and place, so another layout gets another table."""
    ddl = _ddl([*columns, *parts])
    tag = hashlib.sha1(f"{ddl}|{location}".encode()).hexdigest()[:10]
    qualified = _quoted(database, f"{name}__{kind}_{tag}")
    by = f"PARTITIONED BY ({', '.join(f'`{f.name}`' for f in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} ({ddl}) USING parquet {by} LOCATION {_text(location)}")
    return qualified


def _directories(spark: SparkSession, root: str, names: list[str]) -> list[tuple[dict[str, str], str]]:
    """(values, path) of the partition directories ``<root>/<names[0]>=*/...``."""
    out = []
    for p in fs.glob_names(spark, root + "".join(f"/{n}=*" for n in names)):
        values = [unquote(x.split("=", 1)[1]) for x in p.rstrip("/").split("/")[-len(names) :]]
        out.append((dict(zip(names, values, strict=True)), p))
    return out


def register_view(spark: SparkSession, table: CommitLogTable, name: str, database: str | None = None) -> str:
    """Register the table's latest commit as a view over its base and the commits after it (``incoming_wins``)."""
    table.refresh()
    batches, end = table.pin()
    if table.last_commit() is None:
        raise ValueError("nothing to register: the table has no commits")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    qualified = _quoted(database, name)
    was = _refuse_foreign(spark, qualified, table.path)
    parts = [table.schema[p] for p in table.spec.partition_by]
    data = [f for f in table.schema.fields if f.name not in table.spec.partition_by]
    meta = [T.StructField(BATCH_COL, T.StringType()), T.StructField(COMMIT_COL, T.StringType())]
    deleted = T.StructField(DELETED_COL, T.BooleanType())
    columns = ", ".join(f"`{f.name}`" for f in [*table.schema.fields, meta[1], deleted])
    keys = [f"`{k}`" for k in table.spec.resolve_keys]
    later = [b.split("=", 1)[1] for b in batches if end is None or any(c > end for c in table._batch_commits()[b])]
    log = _helper(spark, database, name, "log", [*data, deleted], [*meta, *parts], f"{table.path}/log")
    helpers = [log]
    found = [x for b in later for x in _directories(spark, f"{table.path}/log/{BATCH_COL}={b}", [COMMIT_COL, *table.spec.partition_by])]
    _add_partitions(spark, log, [({BATCH_COL: p.split(f"/{BATCH_COL}=", 1)[1].split("/", 1)[0], **values}, p) for values, p in found])
    which = f"`{BATCH_COL}` IN ({', '.join(map(_text, later))})" if later else "false"
    after = f"SELECT {columns} FROM {log} WHERE {which}" + (f" AND `{COMMIT_COL}` > {_text(end)}" if end else "")
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in table._order(table._empty()))
    newest = (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS `__tm_rank` "
              f"FROM ({after})) WHERE `__tm_rank` = 1 AND NOT `{DELETED_COL}`")
    sql = newest
    if end is not None:
        paths = table.base_paths()
        base = _helper(spark, database, name, "base", [*data, meta[1], deleted], parts, f"{table.path}/base/{table.base_dir()}")
        helpers.append(base)
        if parts:
            names = list(table.spec.partition_by)
            places = [p for p in paths] if table._partial_bases() else [f"{paths[0]}/{names[0]}=*"]
            dirs = []
            for p in places:
                first = fs.glob_names(spark, p)
                for d in first:
                    head = {names[0]: unquote(d.rstrip("/").rsplit("=", 1)[1])}
                    dirs += [({**head, **v}, q) for v, q in _directories(spark, d, names[1:])] if names[1:] else [(head, d)]
            _add_partitions(spark, base, dirs)
        same = " AND ".join(f"b.{k} <=> t.{k}" for k in keys)
        sql = f"SELECT {columns} FROM {base} b LEFT ANTI JOIN (SELECT DISTINCT {', '.join(keys)} FROM ({after})) t ON {same} UNION ALL {newest}"
    if was == "EXTERNAL":
        spark.sql(f"DROP TABLE {qualified}")  # registered as a table once; its data stays
    spark.sql(f"CREATE OR REPLACE VIEW {qualified} COMMENT 'latest commit' TBLPROPERTIES ({_text(PATH_PROPERTY)} = {_text(table.path)}) AS {sql}")
    # helpers of earlier layouts and bases: no view names them any more
    listed = spark.sql(f"SHOW TABLES{f' IN `{database}`' if database else ''} LIKE '{name}__*'").collect()
    for r in listed:
        old = _quoted(database, r["tableName"])
        if re.fullmatch(rf"{re.escape(name.lower())}__(log|base)_[0-9a-f]{{10}}", r["tableName"]) and old not in [h.lower() if not database else h for h in helpers]:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return qualified


def register(
    spark: SparkSession,
    table: CommitLogTable,
    name: str,
    database: str | None = None,
    refresh: bool = False,
    options: WriteOptions | None = None,
) -> str:
    """Register the table: a COPY_ON_WRITE one as a view of its latest commit (``register_view``),
    others as their compacted base.

    ``refresh``: compact first. A table or view of that name that is not a registration
    of this table is refused, never dropped.
    """
    table.refresh()  # register what is there now, not what an old view saw
    current = table.spec.table_type == "COPY_ON_WRITE"
    if current and table.spec.merge_mode == "incoming_wins":
        if refresh:
            table.compact(options)
        return register_view(spark, table, name, database)
    if table.base_end() is None or refresh or current:
        table.compact(options)
    if table.base_end() is None:
        raise ValueError("nothing to register: the table has no commits")
    parts = list(table.spec.partition_by)
    if len(table.base_paths()) > 1 and len(parts) > 1:
        # multi-level partitions spread over several bases: fold them into one
        table.compact(options, force=True)
    qualified = _quoted(database, name)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    was = _refuse_foreign(spark, qualified, table.path)
    columns = [f for f in table.schema.fields if f.name not in parts]
    columns += [T.StructField(COMMIT_COL, T.StringType()), T.StructField(DELETED_COL, T.BooleanType())]
    columns += [table.schema[p] for p in parts]
    location = f"{table.path}/base/{table.base_dir()}"
    if was == "EXTERNAL" and not parts and [(f.name, f.dataType) for f in spark.table(qualified).schema] == [(f.name, f.dataType) for f in columns]:
        # the name stays: readers see the old base or the new one
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION {_text(location)}")
        spark.sql(f"REFRESH TABLE {qualified}")
        return qualified
    if was:
        spark.sql(f"DROP {'VIEW' if was == 'VIEW' else 'TABLE'} {qualified}")
    partition_clause = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    comment = "latest commit" if current else "as of the last compaction"
    spark.sql(f"CREATE TABLE {qualified} ({_ddl(columns)}) USING parquet {partition_clause} LOCATION {_text(location)} COMMENT '{comment}'")
    if not parts:
        return qualified
    paths = table.base_paths()
    if len(paths) == 1:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
        return qualified
    # partition-scoped tables compact only touched partitions: each partition
    # is registered at its own (newest) base directory
    _add_partitions(spark, qualified, [({parts[0]: unquote(p.rstrip("/").rsplit("/", 1)[1].split("=", 1)[1])}, p) for p in paths])
    return qualified
