"""The reference-style upsert entry point, maintenance jobs, generators, skew."""

from __future__ import annotations

import glob

import pytest

from pyspark.sql import functions as F

from tidemark.operators import keyed
from tidemark.plans import maintenance
from tidemark.plans.commitlog import CommitLogTable
from tidemark.plans.write_config import WriteConfig, upsert_table
from tidemark.sources import generate, inventory

SCHEMA = "customer_id string, name string, state string, created_at string"


def config(path, **kw):
    base = dict(
        glue_database=None, table_name="customers_t", record_id="customer_id", precomb_key="created_at",
        table_type="COPY_ON_WRITE", partition_fields="state", enable_partition=True, enable_cleaner=False,
        enable_hive_sync=False, enable_clustering="False", enable_meta_data_indexing="false",
        use_sql_transformer=False, sql_transformer_query="default", target_path=path, index_type="BLOOM",
    )
    base.update(kw)
    return WriteConfig(**base)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_copy_on_write_compacts_on_cadence(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, compact_every=2)
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    assert t.base_end() is None
    upsert_table(spark, batch(spark, [("1", "a2", "NY", "2024-01-02")]), cfg)
    assert t.base_end() == t.last_commit()
    assert [r["name"] for r in t.snapshot().collect()] == ["a2"]


def test_global_index_moves_key_between_partitions(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, index_type="GLOBAL_BLOOM", table_type="MERGE_ON_READ")
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg)
    upsert_table(spark, batch(spark, [("1", "a", "CA", "2024-01-02")]), cfg)
    assert [tuple(r) for r in CommitLogTable.open(spark, tmp_table_dir).snapshot().select("state").collect()] == [
        ("CA",)
    ]


def test_empty_after_transform_writes_nothing(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, use_sql_transformer="true",
                 sql_transformer_query="SELECT * FROM temp WHERE state = 'nowhere'")
    assert upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg) is None
    assert CommitLogTable.open(spark, tmp_table_dir).commits() == []


def test_cleaner_clustering_catalog_and_stats(spark, tmp_table_dir):
    cfg = config(
        tmp_table_dir, table_type="MERGE_ON_READ", enable_cleaner=True, compact_every=3,
        enable_clustering=True, clustering_column="name", enable_hive_sync="True",
        enable_meta_data_indexing=True, compression="gzip", table_name="customers_sync",
    )
    for day in range(1, 5):
        upsert_table(spark, batch(spark, [(str(i), f"n{i}-{day}", "NY" if i % 2 else "CA", f"2024-01-0{day}")
                                          for i in range(6)]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    # the cleaner ran once three batches existed: older log batches are gone
    assert len(t.batches()) <= 2
    assert sorted(r["name"] for r in t.snapshot().collect()) == [f"n{i}-4" for i in range(6)]
    # catalog sync: the table is queryable by name, partitions recovered
    assert spark.sql("SELECT count(*) AS n FROM customers_sync").first()["n"] == 6
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS customers_sync").collect()}
    assert parts == {"state=CA", "state=NY"}
    desc = maintenance.analyze(spark, "customers_sync", ["customer_id"])
    assert desc.filter(F.col("col_name") == "Statistics").count() == 1
    assert glob.glob(f"{tmp_table_dir}/log/**/*.gz.parquet", recursive=True)


def test_cluster_sorts_within_files(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ")
    upsert_table(spark, batch(spark, [(str(i), f"z{9 - i}", "NY", "2024-01-01") for i in range(10)]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    maintenance.cluster(t, ["name"], 1 << 30)
    names = [r["name"] for r in spark.read.parquet(f"{tmp_table_dir}/base/{t.base_dir()}").collect()]
    assert names == sorted(names)


def test_hot_key_latest_is_exact(spark):
    # one key owns a third of the rows
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("pre")
    )
    out = keyed.precombine(df, ["k"], "pre", [])
    assert out.filter("k = 0").first()["pre"] == 29_997
    assert out.count() == 20_001


def test_generators_respect_domains(spark):
    customers = generate.generate_customers(spark, 50)
    orders = generate.generate_orders(spark, 100, 50)
    assert customers.count() == 50 and orders.count() == 100
    assert orders.join(customers, "customer_id", "left_anti").isEmpty()  # every order has a customer
    stats = orders.agg(
        F.min(F.col("order_value").cast("int")).alias("lo"), F.max(F.col("order_value").cast("int")).alias("hi"),
        F.max(F.length("name")).alias("name_len"), F.min("order_date").alias("d0"), F.max("order_date").alias("d1"),
    ).first()
    assert 10 <= stats["lo"] and stats["hi"] <= 1000 and stats["name_len"] <= 20
    assert "2023-12-31" <= stats["d0"] and stats["d1"] <= "2024-01-30"
    assert {r[0] for r in orders.select("priority").distinct().collect()} <= {"LOW", "MEDIUM", "HIGH"}


def test_inventory_search(spark, tmp_table_dir):
    spark.range(3).write.parquet(f"{tmp_table_dir}/inv/a")
    spark.range(3).write.parquet(f"{tmp_table_dir}/inv/b")
    inv = inventory.object_inventory(spark, f"{tmp_table_dir}/inv", glob="*.parquet")
    assert inv.count() >= 2
    hits = inventory.find_similar(inv, "/inv/a/")
    assert hits.count() >= 1 and hits.filter(~F.col("path").contains("/inv/a/")).isEmpty()


def test_failed_write_leaves_nothing_visible(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ")
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    bad = batch(spark, [("2", "b", "NY", "2024-01-01")]).withColumn(
        "name", F.when(F.col("customer_id") == "2", F.raise_error(F.lit("executor lost"))).otherwise(F.col("name"))
    )
    try:
        t.write(bad)
    except Exception:  # noqa: BLE001 - the job is meant to fail
        pass
    assert [r["customer_id"] for r in t.snapshot().collect()] == ["1"]
    maintenance.clean_staging(t)
    assert not glob.glob(f"{tmp_table_dir}/_staging/*")
    # a retry succeeds with a new commit
    assert t.write(batch(spark, [("2", "b", "NY", "2024-01-01")])) is not None
    assert sorted(r["customer_id"] for r in t.snapshot().collect()) == ["1", "2"]


def test_catalog_follows_partial_bases(spark, tmp_table_dir):
    from tidemark.plans import catalog

    cfg = config(tmp_table_dir, table_type="MERGE_ON_READ", table_name="partial_sync")
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01"), ("2", "b", "CA", "2024-01-01")]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    t.compact()
    upsert_table(spark, batch(spark, [("1", "a2", "NY", "2024-01-02")]), cfg)
    query = "SELECT customer_id, name, state FROM partial_sync"
    catalog.register(spark, t, "partial_sync")  # read-optimized: as of the last compaction
    assert sorted(tuple(r) for r in spark.sql(query).collect()) == [("1", "a", "NY"), ("2", "b", "CA")]
    catalog.register(spark, t, "partial_sync", refresh=True)  # compacts the touched partition
    assert len(t.base_paths()) == 2
    assert sorted(tuple(r) for r in spark.sql(query).collect()) == [("1", "a2", "NY"), ("2", "b", "CA")]


def test_cluster_spreads_a_dominant_sort_value(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ")
    # one name owns a third of the rows
    rows = [(str(i), "hot" if i % 3 == 0 else f"n{i:04d}", "NY", "2024-01-01") for i in range(3000)]
    upsert_table(spark, batch(spark, rows), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    maintenance.cluster(t, ["name"], 4096)  # small target: many files
    base = spark.read.parquet(f"{tmp_table_dir}/base/{t.base_dir()}")
    per_file = base.filter("name = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1  # the hot value is split over files
    assert base.count() == 3000


def test_cluster_sizes_from_base_after_retention(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ")
    upsert_table(spark, batch(spark, [(str(i), f"n{i:04d}", "NY", "2024-01-01") for i in range(2000)]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    maintenance.retain_versions(t, 1)  # the log is gone, the base holds the data
    assert t.batches() == []
    maintenance.cluster(t, ["name"], 4096)
    files = glob.glob(f"{tmp_table_dir}/base/{t.base_dir()}/*.parquet")
    assert len(files) > 1


def test_cluster_bounds_a_sort_by_decoded_rows(spark, tmp_table_dir, monkeypatch):
    """Rows that are small in parquet only: one file of the size asked for would be one sort of all of them."""
    monkeypatch.setattr(maintenance, "SORT_BYTES", 1 << 20, raising=False)
    rows = spark.range(4000).select(
        (F.col("id") * 7919 % 4000).cast("string").alias("customer_id"), F.lpad((F.col("id") % 1000).cast("string"), 4, "0").alias("name"),
        F.repeat(F.lit("NY"), 1000).alias("state"), F.lit("2024-01-01").alias("created_at"))
    upsert_table(spark, rows, config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ"))
    t = CommitLogTable.open(spark, tmp_table_dir)
    maintenance.cluster(t, ["name"], 1 << 30)  # 8 MB of text
    base = spark.read.parquet(f"{tmp_table_dir}/base/{t.base_dir()}")
    per_file = base.groupBy(F.input_file_name()).agg(F.min("name").alias("lo"), F.max("name").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert len(per_file) >= 8 and max(r.n for r in per_file) < 1000
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]))
    assert sorted(map(tuple, t.refresh().snapshot().collect())) == sorted(map(tuple, rows.collect()))
    # a second run measures the base and the log after it
    upsert_table(spark, rows.limit(10), config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ"))
    maintenance.cluster(t, ["name"], 1 << 30)
    again = spark.read.parquet(f"{tmp_table_dir}/base/{t.refresh().base_dir()}")
    assert 8 <= again.select(F.input_file_name()).distinct().count() <= len(per_file) + 1 and again.count() == 4000


def test_rows_to_frame_and_gold_helper_and_file_cap(spark, tmp_table_dir):
    from pyspark.sql import types as T

    from tidemark.plans.write_config import upsert_to_gold
    from tidemark.sinks.keyed import preview

    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("order_date", T.StringType()),
                           T.StructField("v", T.StringType())])
    df = generate.rows_to_frame(spark, [{"order_id": str(i), "order_date": "2024-01-01", "v": "x"} for i in range(10)]
                                + [{"order_id": "10"}], schema)
    assert df.count() == 11 and df.filter("order_id = '10'").first()["v"] is None  # missing keys become NULL
    preview(df, enabled=False)  # K19: nothing runs unless asked
    commit = upsert_to_gold(spark, df, tmp_table_dir, "earnings", "order_id", "order_date", table_type="MERGE_ON_READ")
    gold = f"{tmp_table_dir}/gold/table_name=earnings"
    assert commit is not None and CommitLogTable.open(spark, gold).snapshot().count() == 11
    assert spark.sql("SELECT count(*) AS n FROM earnings").first()["n"] == 11  # catalog sync is on
    capped = config(f"{tmp_table_dir}/capped", enable_partition=False, table_type="MERGE_ON_READ",
                    max_records_per_file=2)
    upsert_table(spark, batch(spark, [(str(i), "n", "NY", "2024-01-01") for i in range(10)]).coalesce(1), capped)
    assert len(glob.glob(f"{tmp_table_dir}/capped/log/**/*.parquet", recursive=True)) >= 5  # K9
    layout = maintenance.file_layout(spark, f"{tmp_table_dir}/capped/log")
    assert layout.count() >= 5 and layout.filter("length <= 0").isEmpty()


def test_write_methods_through_the_config(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ", method="bulk_insert")
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01"), ("1", "a-dup", "NY", "2024-01-02"),
                                      ("2", "b", "CA", "2024-01-01")]), cfg)
    t = CommitLogTable.open(spark, tmp_table_dir)
    assert len(t.incremental(None, mode="changes").collect()) == 3  # bulk_insert keeps every row
    cfg.method = "delete"
    upsert_table(spark, batch(spark, [("1", None, None, None)]), cfg)
    # `t` keeps its pinned view until refreshed (the delete came through another instance)
    assert sorted(r["customer_id"] for r in t.snapshot().collect()) == ["1", "2"]
    assert [r["customer_id"] for r in t.refresh().snapshot().collect()] == ["2"]
    cfg.method = "merge"
    with pytest.raises(ValueError):
        upsert_table(spark, batch(spark, [("3", "c", "TX", "2024-01-01")]), cfg)


def test_maintenance_on_a_stale_instance_covers_later_commits(spark, tmp_table_dir):
    cfg = config(tmp_table_dir, enable_partition=False, table_type="MERGE_ON_READ")
    upsert_table(spark, batch(spark, [("1", "a", "NY", "2024-01-01")]), cfg)
    stale = CommitLogTable.open(spark, tmp_table_dir)
    assert stale.snapshot().count() == 1  # pinned before the next commit
    upsert_table(spark, batch(spark, [("2", "b", "CA", "2024-01-01")]), cfg)
    maintenance.cluster(stale, ["name"], 1 << 30)
    fresh = CommitLogTable.open(spark, tmp_table_dir)
    assert fresh.base_end() == fresh.last_commit()
    base = spark.read.parquet(f"{tmp_table_dir}/base/{fresh.base_dir()}")
    assert sorted(r["customer_id"] for r in base.collect()) == ["1", "2"]
    fresh.drop_log_through(fresh.base_end())
    assert sorted(r["customer_id"] for r in fresh.refresh().snapshot().collect()) == ["1", "2"]
