"""Session helpers: shared scratch folder and partition sizing."""

from __future__ import annotations

from tidemark.session import ensure_checkpoint_dir, scale_conf, scratch_dir


def test_scratch_lives_under_the_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_scale_conf_sizes_partitions_from_input():
    tb = scale_conf(100 * 10**12)
    assert tb["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 * 2**20)))
    small = scale_conf(10 * 2**30)
    assert small["spark.sql.shuffle.partitions"] == "40"  # 10 GiB / 256 MiB
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
    assert small["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_scratch_scopes_clear_their_own_folders(spark):
    from tidemark import fs
    from tidemark.session import scratch_dir, scratch_scope

    outside = scratch_dir(spark, "outside")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        a = scratch_dir(spark, "a")
        spark.range(3).write.parquet(a)
        with scratch_scope(spark):
            b = scratch_dir(spark, "b")
            spark.range(3).write.parquet(b)
        assert fs.exists(spark, a) and not fs.exists(spark, b)
    assert not fs.exists(spark, a) and fs.exists(spark, outside)
