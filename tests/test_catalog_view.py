"""Copy-on-write tables in the catalog: current without a rewrite."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_write_config import batch, config
from tidemark.plans import catalog, maintenance
from tidemark.plans.commitlog import CommitLogTable
from tidemark.plans.write_config import upsert_table


def files(path):
    return {f: pq.read_metadata(f).num_rows for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def cow(path, name, **kw):
    return config(path, **{"table_type": "COPY_ON_WRITE", "enable_hive_sync": True, "table_name": name, "compact_every": 0, **kw})


def shown(spark, name, cols="customer_id, name, state, created_at"):
    return sorted(map(tuple, spark.sql(f"SELECT {cols} FROM {name}").collect()), key=str)


def stored(spark, path, cols=("customer_id", "name", "state", "created_at")):
    return sorted(map(tuple, CommitLogTable.open(spark, path).snapshot().select(*cols).collect()), key=str)


@pytest.mark.parametrize("parts", [True, False])
def test_a_one_row_upsert_writes_one_row(spark, tmp_table_dir, parts):
    name = f"cow_one_{parts}".lower()
    cfg = cow(tmp_table_dir, name, enable_partition=parts)
    upsert_table(spark, batch(spark, [(str(i), f"n{i}", ["NY", "CA", None, "it's %"][i % 4], "2024-01-01") for i in range(40)]), cfg)
    before = files(tmp_table_dir)
    upsert_table(spark, batch(spark, [("7", "new", "it's %", "2024-01-02")]), cfg)
    written = {f: n for f, n in files(tmp_table_dir).items() if f not in before}
    assert sum(written.values()) == 1 and not glob.glob(f"{tmp_table_dir}/base/*")
    assert shown(spark, name) == stored(spark, tmp_table_dir) and len(shown(spark, name)) == 40
    assert ("7", "new", "it's %", "2024-01-02") in shown(spark, name)


@pytest.mark.parametrize("parts", [True, False])
def test_the_view_follows_deletes_compaction_clustering_and_new_columns(spark, tmp_table_dir, parts):
    name = f"cow_all_{parts}".lower()
    cfg = cow(tmp_table_dir, name, enable_partition=parts)
    rows = [(str(i), f"n{i}", ["NY", "CA", None][i % 3], "2024-01-01") for i in range(12)]
    upsert_table(spark, batch(spark, rows), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    t.delete(batch(spark, [rows[0], rows[2]]))
    catalog.register(spark, t, name)
    assert shown(spark, name) == stored(spark, tmp_table_dir) and len(shown(spark, name)) == 10
    t.compact()
    upsert_table(spark, batch(spark, [("1", "again", "CA", "2024-01-03"), ("2", "back", None, "2024-01-03"), ("5", "null part", None, "2024-01-03")]), cfg)
    assert shown(spark, name) == stored(spark, tmp_table_dir) and len(shown(spark, name)) == 11
    t.refresh().compact()  # touched partitions alone, where the table has them
    upsert_table(spark, batch(spark, [("9", "x", "NY", "2024-01-04")]).withColumn("extra", F.lit("e")), cfg)
    assert shown(spark, name, "customer_id, extra") == stored(spark, tmp_table_dir, ("customer_id", "extra"))
    t = CommitLogTable.open(spark, tmp_table_dir)
    maintenance.retain_versions(t, 2)
    catalog.register(spark, t, name)
    assert shown(spark, name) == stored(spark, tmp_table_dir) and len(shown(spark, name)) == 11
    helpers = [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()]
    assert len(helpers) == 2


def test_the_name_is_never_missing_and_foreign_names_are_refused(spark, tmp_table_dir):
    spark.sql("DROP VIEW IF EXISTS cow_taken")
    spark.sql("CREATE VIEW cow_taken AS SELECT 1 AS x")
    cfg = cow(tmp_table_dir, "cow_taken")
    with pytest.raises(ValueError, match="not a registration"):
        upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg)
    assert spark.sql("SELECT x FROM cow_taken").first()[0] == 1
    spark.sql("DROP VIEW cow_taken")
    t = CommitLogTable.open(spark, tmp_table_dir)
    catalog.register(spark, t, "cow_taken")
    reader = spark.table("cow_taken")  # resolved before the next write: a consistent old view
    upsert_table(spark, batch(spark, [("2", "b", "NY", "2024-01-02")]), cfg)
    assert reader.count() == 1 and spark.table("cow_taken").count() == 2


def test_rewrites_keep_the_tables_codec(spark, tmp_table_dir):
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), config(tmp_table_dir, compression="gzip", table_type="MERGE_ON_READ"))
    t = CommitLogTable.open(spark, tmp_table_dir)
    t.compact()
    t.write(batch(spark, [("2", "b", "NY", "2024-01-02")]))
    found = glob.glob(f"{tmp_table_dir}/**/*.parquet", recursive=True)
    assert len(found) == 3 and all(f.endswith(".gz.parquet") for f in found)


def test_retention_with_grace_leaves_what_open_readers_hold(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, table_type="MERGE_ON_READ", enable_partition=False)
    for day in range(1, 4):
        upsert_table(spark, batch(spark, [(str(i), f"n{i}-{day}", "NY", f"2024-01-0{day}") for i in range(5)]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    held = [t.snapshot(), t.incremental(t.commits()[0], mode="changes")]
    maintenance.retain_versions(t, 2, grace=True)
    assert [x.count() for x in held] == [5, 10]  # both still read the files they pinned
    upsert_table(spark, batch(spark, [("9", "n9", "NY", "2024-01-09")]), cfg)
    reader = CommitLogTable.open(spark, tmp_table_dir)
    now = reader.snapshot()
    kept = maintenance.retain_versions(CommitLogTable.open(spark, tmp_table_dir), 2, grace=True)
    assert now.count() == 6 and kept.count() == 11
    t = CommitLogTable.open(spark, tmp_table_dir)
    # the first run's log went with the second run, the second's own stays
    assert len(t.batches()) == 1 and len(t._finished("history")) == 2 and t.snapshot().count() == 6


def test_item_tables_are_compacted(spark, tmp_table_dir):
    from tidemark.sinks.keyed import KeyedSink

    sink = KeyedSink(spark, tmp_table_dir, "k", compact_every=2)
    for i in range(5):
        sink.put(spark.createDataFrame([("a", str(i)), (f"b{i}", "x")], "k string, v string"))
    t = CommitLogTable.open(spark, tmp_table_dir)
    assert maintenance.commits_since_base(t) == 1
    assert {r.k: r.v for r in sink.items().collect()} == {"a": "4"} | {f"b{i}": "x" for i in range(5)}
