"""Dense numbers, file sizes in bytes, proof of clustering, statistics, observed checkpoints."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import commit_time_of
from tidemark.operators.numbering import dense_numbers
from tidemark.plans import layout, maintenance
from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.plans.incremental import ChangeFeedSource, ObservedReader
from tidemark.sources import generate


@pytest.mark.parametrize("ids", [["b", "a", None, "é", "a"], [-5, 10**12, 7], [], [None], list(range(0, 3000, 7))])
def test_dense_numbers(spark, ids):
    kind = "string" if ids and isinstance(ids[0], str) else "long"
    got, n = dense_numbers(spark.createDataFrame([(i,) for i in ids], f"id {kind}"), "id")
    want = sorted({i for i in ids if i is not None}, key=lambda x: x.encode() if isinstance(x, str) else x)
    assert n == len(want) and [r.id for r in got.orderBy("number").collect()] == want
    assert sorted(r.number for r in got.collect()) == list(range(n))


def test_no_window_without_a_partition(spark):
    got, _ = dense_numbers(spark.range(100).withColumnRenamed("id", "x"), "x")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_orders_draw_from_a_sparse_set(spark):
    customers = spark.createDataFrame([("k9",), ("k1000000",), ("zz",), (None,)], "c string")
    got = generate.orders_for_customers(spark.range(500).withColumnRenamed("id", "i"), customers, "c").toPandas()
    assert len(got) == 500 and set(got.customer_id) == {"k9", "k1000000", "zz"}
    with pytest.raises(ValueError, match="at least one customer"):
        generate.orders_for_customers(spark.range(5).withColumnRenamed("id", "i"), customers.limit(0), "c")


def files_under(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_small_files_become_files_of_the_size_asked_for(spark, tmp_table_dir, parts):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 3 == 0).cast("string").alias("p"))
    write = lambda df, mode: (df.write.partitionBy(*parts) if parts else df.write).mode(mode).option("compression", "gzip").parquet(f"{tmp_table_dir}/in")
    write(rows.repartition(30), "overwrite")
    write(rows.filter("id < 30000").coalesce(1), "append")
    before = files_under(f"{tmp_table_dir}/in")
    small, target = 200_000, 400_000
    assert any(s >= small for s in before.values())
    n = layout.rewrite_small_files(spark, f"{tmp_table_dir}/in", f"{tmp_table_dir}/out", small, target, parts)
    after = files_under(f"{tmp_table_dir}/out")
    assert len(after) == n < len(before)
    big = [s for s in before.values() if s >= small]
    # little files were packed to about the target; the large ones stay files of their own
    assert sorted(after.values())[-len(big) :] >= [0.9 * s for s in sorted(big)]
    packed = sorted(after.values())[: len(after) - len(big)]
    assert all(s <= 1.1 * (target + small) for s in packed) and sum(s >= 0.8 * target for s in packed) >= len(packed) - len(parts) - 1
    got = spark.read.parquet(f"{tmp_table_dir}/out").select("id", "v").orderBy("id", "v")
    want = spark.read.parquet(f"{tmp_table_dir}/in").select("id", "v").orderBy("id", "v")
    assert got.collect() == want.collect()


def test_groups_are_running_sums_in_each_folder(spark):
    files = [(f"d{d}/f{i}", 10 * (i + 1), 1) for d in range(2) for i in range(6)]
    got = layout.rewrite_groups(spark.createDataFrame(files, "file string, bytes long, n_rows long"), small=50, target=60).collect()
    group = {r.file: r.group for r in got}
    for d in range(2):
        # 10 + 20 + 30 reach the target; 40 starts the next; 50 and 60 are large
        assert [group[f"d{d}/f{i}"] for i in range(6)] == ["small 0"] * 3 + ["small 1", f"d{d}/f4", f"d{d}/f5"]


def test_the_report_finds_overlaps_and_clustering_has_none(spark, tmp_table_dir):
    spec = TableSpec(name="t", keys=("id",), partition_by=("p",), key_scope="partition")
    table = CommitLogTable.create(spark, tmp_table_dir, spec)
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("p"))
    table.write(rows.repartition(6), "insert")
    stored = spark.read.parquet(f"{tmp_table_dir}/log")
    assert all(r.overlapping > 0 for r in layout.clustering_report(stored, ["x"]).collect())
    maintenance.cluster(table, ["x"], maintenance.table_bytes(spark, f"{tmp_table_dir}/log") // 12)
    base = spark.read.option("basePath", f"{tmp_table_dir}/base/{table.base_dir()}").parquet(*table.base_paths())
    got = layout.clustering_report(base, ["x", "id"], ["p"]).collect()
    assert len(got) == 3 and all(r.overlapping == 0 and r.n_files > 1 for r in got) and sum(r.n_rows for r in got) == 5000


def test_statistics_change_the_join_plan(spark, tmp_table_dir):
    """With column statistics the optimizer knows that a filter leaves few rows, and broadcasts that side."""
    n = 200_000
    spark.sql("DROP TABLE IF EXISTS stat_facts")
    spark.sql("DROP TABLE IF EXISTS stat_dims")
    spark.range(n).select("id", (F.col("id") % 1000).alias("k"), F.lit("x" * 60).alias("pad")).write.saveAsTable("stat_dims", path=f"{tmp_table_dir}/d")
    spark.range(n).select("id", F.lit("y" * 60).alias("pad")).write.saveAsTable("stat_facts", path=f"{tmp_table_dir}/f")
    sql = "SELECT count(*) FROM stat_facts f JOIN stat_dims d ON f.id = d.id WHERE d.k = 5 AND d.pad LIKE 'x%' AND f.pad IS NOT NULL"
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "64KB", "spark.sql.adaptive.enabled": "false",
                "spark.sql.statistics.histogram.enabled": "true"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = lambda: spark.sql(sql)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan()
        for t, cols in (("stat_dims", ["id", "k", "pad"]), ("stat_facts", ["id", "pad"])):
            maintenance.analyze(spark, t, cols)
        assert "BroadcastHashJoin" in plan() and "SortMergeJoin" not in plan()
        got = {r.column_name: r for r in maintenance.column_stats(spark, "stat_dims", ["id", "k", "pad"]).collect()}
        assert (got["id"].min, got["id"].max, got["k"].num_nulls, got["pad"].max_col_len, got["pad"].min) == ("0", str(n - 1), "0", "60", None)
        assert abs(int(got["k"].distinct_count) - 1000) <= 150
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.sql("DROP TABLE stat_facts")
        spark.sql("DROP TABLE stat_dims")


def test_the_checkpoint_is_observed_in_the_sinks_job(spark, tmp_table_dir):
    path = f"{tmp_table_dir}/feed"
    rows = spark.sql("SELECT id, DATE'2024-01-01' + CAST(id AS INT) AS d FROM range(10)")
    rows.write.parquet(path)
    store = CheckpointStore(spark, f"{tmp_table_dir}/checkpoints")
    reader = lambda: ObservedReader(store, ChangeFeedSource(spark.read.parquet(path), commit_time_of("d"), "feed", path, day_col="d"))

    def fails(df):
        df.write.parquet(f"{tmp_table_dir}/bad")
        raise RuntimeError("sink")

    with pytest.raises(RuntimeError):
        reader().deliver(fails)
    assert not store.exists("feed")
    assert reader().deliver(lambda df: df.write.parquet(f"{tmp_table_dir}/out")).last_processed_commit == "20240110"
    assert spark.read.parquet(f"{tmp_table_dir}/out").count() == 10
    assert reader().deliver(lambda df: df.write.parquet(f"{tmp_table_dir}/none")) is None
    spark.sql("SELECT 99 AS id, DATE'2024-02-01' AS d").write.mode("append").parquet(path)
    got = reader().deliver(lambda df: df.write.parquet(f"{tmp_table_dir}/more"))
    assert got.last_processed_commit == "20240201" and [r.id for r in spark.read.parquet(f"{tmp_table_dir}/more").collect()] == [99]
