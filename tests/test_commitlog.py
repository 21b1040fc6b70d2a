"""Commit-log tables: writes, snapshots, increments, deletes, compaction."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.plans import maintenance

SCHEMA = "id string, state string, ts long, v string"


def table(spark, path, **kw):
    spec = TableSpec(name="t", keys=("id",), precombine="ts", tie_breakers=("v",), **kw)
    return CommitLogTable.create(spark, path, spec)


def rows(df, cols=("id", "ts", "v")):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_upsert_then_snapshot(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1"), ("b", "x", 1, "b1"), ("a", "x", 2, "a2")], SCHEMA))
    t.write(spark.createDataFrame([("b", "x", 0, "b-late")], SCHEMA))
    # incoming wins even though its pre-combine value is older
    assert rows(t.snapshot()) == [("a", 2, "a2"), ("b", 0, "b-late")]
    ev = t.with_spec(merge_mode="event_time")
    assert rows(ev.snapshot()) == [("a", 2, "a2"), ("b", 1, "b1")]


def test_empty_batch_creates_no_commit(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    assert t.write(spark.createDataFrame([], SCHEMA)) is None
    assert t.commits() == []
    assert not os.path.exists(f"{tmp_table_dir}/_staging") or not os.listdir(f"{tmp_table_dir}/_staging")
    assert t.snapshot().isEmpty()


def test_null_record_key_fails_the_write(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    with pytest.raises(Exception, match="NULL record key"):
        t.write(spark.createDataFrame([(None, "x", 1, "n")], SCHEMA))
    assert t.commits() == []


def test_unfinished_batch_is_invisible(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    batch = t.batches()[0]
    os.makedirs(f"{tmp_table_dir}/log/_batch=99999999999999999/_commit_time=99999999999999999")
    spark.createDataFrame([("a", "x", 9, "ghost", False)], SCHEMA + ", _deleted boolean").write.parquet(
        f"{tmp_table_dir}/log/_batch=99999999999999999/_commit_time=99999999999999999/part"
    )
    os.remove(f"{tmp_table_dir}/log/_batch=99999999999999999/_commit_time=99999999999999999/part/_SUCCESS")
    fresh = CommitLogTable.open(spark, tmp_table_dir)
    assert fresh.batches() == [batch]
    assert rows(fresh.snapshot()) == [("a", 1, "a1")]


def test_delete_and_reinsert(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 5, "a1"), ("b", "x", 1, "b1")], SCHEMA))
    t.delete(spark.createDataFrame([("a",)], "id string"))
    assert rows(t.snapshot()) == [("b", 1, "b1")]
    t.write(spark.createDataFrame([("a", "x", 1, "a-again")], SCHEMA))
    assert rows(t.snapshot()) == [("a", 1, "a-again"), ("b", 1, "b1")]
    # event time: versions before the tombstone never come back
    assert rows(t.with_spec(merge_mode="event_time").snapshot()) == [("a", 1, "a-again"), ("b", 1, "b1")]


def test_key_moving_partition(spark, tmp_table_dir):
    scoped = table(spark, tmp_table_dir, partition_by=("state",), key_scope="table")
    scoped.write(spark.createDataFrame([("a", "NY", 1, "first")], SCHEMA))
    scoped.write(spark.createDataFrame([("a", "CA", 2, "moved")], SCHEMA))
    assert rows(scoped.snapshot(), ("id", "state", "v")) == [("a", "CA", "moved")]
    per_partition = scoped.with_spec(key_scope="partition")
    assert rows(per_partition.snapshot(), ("id", "state", "v")) == [("a", "CA", "moved"), ("a", "NY", "first")]


def test_incremental_modes_and_as_of(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    c1 = t.write(spark.createDataFrame([("a", "x", 1, "a1"), ("b", "x", 1, "b1")], SCHEMA))
    c2 = t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    c3 = t.write(spark.createDataFrame([("a", "x", 3, "a3"), ("c", "x", 1, "c1")], SCHEMA))
    assert c1 < c2 < c3
    assert rows(t.incremental(c1, mode="changes")) == [("a", 2, "a2"), ("a", 3, "a3"), ("c", 1, "c1")]
    assert rows(t.incremental(c1)) == [("a", 3, "a3"), ("c", 1, "c1")]
    assert rows(t.incremental(c1, c2)) == [("a", 2, "a2")]
    assert rows(t.incremental(c3)) == []
    assert rows(t.snapshot(as_of=c2)) == [("a", 2, "a2"), ("b", 1, "b1")]


def test_event_time_increment_ranks_before_filtering(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir, merge_mode="event_time")
    c1 = t.write(spark.createDataFrame([("a", "x", 5, "a-new")], SCHEMA))
    t.write(spark.createDataFrame([("a", "x", 3, "a-late"), ("b", "x", 1, "b1")], SCHEMA))
    # the late row for a loses to the older commit, so only b changed
    assert rows(t.incremental(c1)) == [("b", 1, "b1")]


def test_compaction_keeps_snapshot_and_increments(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    c1 = t.write(spark.createDataFrame([("a", "x", 1, "a1"), ("b", "x", 1, "b1")], SCHEMA))
    t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    before = rows(t.snapshot())
    inc_before = rows(t.incremental(c1))
    end = t.compact()
    assert t.base_end() == end
    assert rows(t.snapshot()) == before
    assert rows(t.incremental(c1)) == inc_before
    t.write(spark.createDataFrame([("b", "x", 0, "b2")], SCHEMA))
    t.delete(spark.createDataFrame([("a",)], "id string"))
    assert rows(t.snapshot()) == [("b", 0, "b2")]
    # the log is still there: every change since c1 is readable
    assert rows(t.incremental(c1, mode="changes")) == [("a", 2, "a2"), ("b", 0, "b2")]
    # once retention removed the covered batches, older changes are refused
    t.drop_log_through(end)
    with pytest.raises(ValueError):
        t.incremental(c1, mode="changes")
    assert rows(t.snapshot()) == [("b", 0, "b2")]
    assert rows(t.incremental(c1)) == [("b", 0, "b2")]


def test_retention_keeps_n_versions_and_drops_log(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    for i in range(5):
        t.write(spark.createDataFrame([("a", "x", i, f"a{i}")], SCHEMA))
    kept = maintenance.retain_versions(t, 3)
    assert sorted(r["v"] for r in kept.collect()) == ["a2", "a3", "a4"]
    assert t.batches() == []
    assert rows(t.snapshot()) == [("a", 4, "a4")]


def test_more_than_fifty_commits(spark, tmp_table_dir):
    from tidemark.operators.timeline import commit_timeline

    t = table(spark, tmp_table_dir)
    df = spark.range(60).select(
        F.col("id").cast("string").alias("id"), F.lit("x").alias("state"), F.col("id").alias("ts"),
        F.lit("v").alias("v"), (F.lit(1000) + F.col("id")).cast("string").alias("ct"),
    )
    t.import_changelog(df, "ct")
    assert len(t.commits()) == 60
    first50 = [r[0] for r in commit_timeline(t.log(), "_commit_time", 50).collect()]
    assert first50 == [str(1000 + i) for i in range(50)]


def test_commit_filter_prunes_partitions(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    c1 = t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    plan = t.incremental(c1, mode="changes")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_time" in plan and c1 in plan


def test_schema_evolution_adds_columns(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    t.write(spark.createDataFrame([("b", "x", 1, "b1", 7)], SCHEMA + ", extra int"))
    snap = CommitLogTable.open(spark, tmp_table_dir).snapshot()
    assert sorted(tuple(r) for r in snap.select("id", "extra").collect()) == [("a", None), ("b", 7)]


def test_insert_keeps_duplicates_in_changes(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    c = t.write(spark.createDataFrame([("a", "x", 1, "a1"), ("a", "x", 2, "a2")], SCHEMA), operation="insert")
    assert len(t.incremental(None, mode="changes").collect()) == 2
    assert rows(t.snapshot()) == [("a", 2, "a2")]
    assert c is not None
    with pytest.raises(ValueError):
        t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA), operation="merge")


def test_exceptions_are_spark_errors_for_bad_schema(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    with pytest.raises((PySparkException, Exception)):
        t.write(spark.createDataFrame([("a",)], "nokey string"))


def _model(commits, mode):
    """Pure-Python snapshot of a sequence of (kind, rows) commits."""
    versions = []  # (key, commit_index, pre, v, deleted)
    for ci, (kind, rows) in enumerate(commits):
        if kind == "delete":
            versions += [(k, ci, None, None, True) for k in {r[0] for r in rows}]
        else:
            best = {}
            for k, pre, v in rows:  # in-batch pre-combine: greatest (pre, v)
                if k not in best or (pre, v) > best[k]:
                    best[k] = (pre, v)
            versions += [(k, ci, pre, v, False) for k, (pre, v) in best.items()]
    out = {}
    for k in {v[0] for v in versions}:
        mine = [v for v in versions if v[0] == k]
        tomb = max((v[1] for v in mine if v[4]), default=-1)
        live = [v for v in mine if not v[4] and v[1] > tomb]
        if mode == "incoming_wins":
            top = max(mine, key=lambda v: (v[1], v[2] if v[2] is not None else -1, v[3] or ""))
            if not top[4]:
                out[k] = (top[2], top[3])
            continue
        if live:
            top = max(live, key=lambda v: (v[2], v[1], v[3]))
            out[k] = (top[2], top[3])
    return sorted((k, *pv) for k, pv in out.items())


def test_random_histories_match_model(spark, tmp_table_dir):
    import random

    rng = random.Random(7)
    for trial in range(4):
        commits = []
        for _ in range(5):
            if commits and rng.random() < 0.3:
                commits.append(("delete", [(str(rng.randint(0, 3)),) for _ in range(2)]))
            else:
                # key "0" is hot: about a third of every batch
                rows = [("0" if rng.random() < 0.34 else str(rng.randint(1, 3)), rng.randint(0, 9), f"v{rng.randint(0, 99):02d}")
                        for _ in range(12)]
                commits.append(("upsert", rows))
        for mode in ("incoming_wins", "event_time"):
            spec = TableSpec(name="r", keys=("id",), precombine="ts", tie_breakers=("v",), merge_mode=mode)
            t = CommitLogTable.create(spark, f"{tmp_table_dir}/{trial}-{mode}", spec)
            for kind, rows in commits:
                if kind == "delete":
                    t.delete(spark.createDataFrame(rows, "id string"))
                else:
                    t.write(spark.createDataFrame([(k, "x", p, v) for k, p, v in rows], SCHEMA))
            assert rows_of(t.snapshot()) == _model(commits, mode), (trial, mode)


def rows_of(df):
    return sorted((r["id"], r["ts"], r["v"]) for r in df.collect())


def test_partition_filter_prunes_only_in_partition_scope(spark, tmp_table_dir):
    scoped = table(spark, tmp_table_dir, partition_by=("state",), key_scope="partition")
    scoped.write(spark.createDataFrame([("a", "NY", 1, "a-ny"), ("a", "CA", 1, "a-ca")], SCHEMA))
    df = scoped.snapshot().filter(F.col("state") == "NY")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan and "(state#" in plan
    assert rows(df, ("id", "state", "v")) == [("a", "NY", "a-ny")]
    # table scope: a key may have moved partitions, so the filter must wait
    # for resolution and is not pushed into the scan
    moved = scoped.with_spec(key_scope="table")
    plan_t = moved.snapshot().filter(F.col("state") == "NY")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" in plan_t


def test_compaction_rewrites_only_touched_partitions(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir, partition_by=("state",), key_scope="partition")
    t.write(spark.createDataFrame(
        [("a", "NY", 1, "a-ny"), ("b", "CA", 1, "b-ca"), ("c", "TX", 1, "c-tx")], SCHEMA))
    t.compact()
    first = t.base_dir()
    t.write(spark.createDataFrame([("a", "NY", 2, "a-ny2")], SCHEMA))
    t.delete(spark.createDataFrame([("CA", "b")], "state string, id string"))
    before = rows(t.snapshot(), ("id", "state", "v"))
    t.compact()
    second = t.base_dir()
    assert second != first
    paths = t.base_paths()
    assert sorted((p.rsplit("/", 2)[-2:] for p in paths), key=lambda x: x[1]) == [
        [second, "state=CA"], [second, "state=NY"], [first, "state=TX"],
    ]
    assert before == rows(t.snapshot(), ("id", "state", "v")) == [("a", "NY", "a-ny2"), ("c", "TX", "c-tx")]
    t.drop_log_through(t.base_end())
    assert rows(t.snapshot(), ("id", "state", "v")) == [("a", "NY", "a-ny2"), ("c", "TX", "c-tx")]


def test_latest_state_equals_snapshot_rows_in_range(spark, tmp_table_dir):
    import random

    rng = random.Random(11)
    for mode in ("incoming_wins", "event_time"):
        t = table(spark, f"{tmp_table_dir}/{mode}", merge_mode=mode)
        commits = []
        for step in range(6):
            batch = [(str(rng.randint(0, 5)), "x", rng.randint(0, 9), f"v{step}{i}") for i in range(6)]
            commits.append(t.write(spark.createDataFrame(batch, SCHEMA)))
            if step == 2:
                t.compact()
                t.drop_log_through(t.base_end())
        snap = t.snapshot(with_meta=True)
        for begin in (None, commits[0], commits[1], commits[3], commits[5]):
            want = snap if begin is None else snap.filter(F.col("_commit_time") > begin)
            assert rows(t.incremental(begin)) == rows(want), (mode, begin)


def test_random_compaction_matches_uncompacted_twin(spark, tmp_table_dir):
    import random

    rng = random.Random(23)
    for mode in ("incoming_wins", "event_time"):
        kw = dict(partition_by=("state",), key_scope="partition", merge_mode=mode)
        plain = table(spark, f"{tmp_table_dir}/{mode}-plain", **kw)
        compacted = table(spark, f"{tmp_table_dir}/{mode}-compacted", **kw)
        for step in range(7):
            if step and rng.random() < 0.3:
                keys = [(rng.choice("ABC"), str(rng.randint(0, 4))) for _ in range(3)]
                for t in (plain, compacted):
                    t.delete(spark.createDataFrame(keys, "state string, id string"))
            else:
                # state "A" is hot: most rows land in one partition
                fresh = [(str(rng.randint(0, 4)), "A" if rng.random() < 0.6 else rng.choice("BC"),
                          rng.randint(0, 9), f"s{step}r{i}") for i in range(8)]
                for t in (plain, compacted):
                    t.write(spark.createDataFrame(fresh, SCHEMA))
            if rng.random() < 0.5:
                compacted.compact()
                if rng.random() < 0.5:
                    compacted.drop_log_through(compacted.base_end())
            cols = ("id", "state", "ts", "v")
            assert rows(compacted.snapshot(), cols) == rows(plain.snapshot(), cols), (mode, step)


def test_retention_keeps_n_versions_across_runs_and_drops_deleted(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    for i in range(3):
        t.write(spark.createDataFrame([("a", "x", i, f"a{i}"), ("b", "x", i, f"b{i}")], SCHEMA))
    maintenance.retain_versions(t, 3)
    for i in range(3, 5):
        t.write(spark.createDataFrame([("a", "x", i, f"a{i}")], SCHEMA))
    t.delete(spark.createDataFrame([("b",)], "id string"))
    kept = maintenance.retain_versions(t, 3)
    # a: its three newest over both runs; b: deleted, so no versions linger
    assert sorted((r["id"], r["v"], r["version_rank"]) for r in kept.collect()) == [
        ("a", "a2", 3), ("a", "a3", 2), ("a", "a4", 1),
    ]
    assert len(os.listdir(f"{tmp_table_dir}/history")) == 1
    assert rows(t.snapshot()) == [("a", 4, "a4")]


def test_unused_bases_are_dropped(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir, partition_by=("state",), key_scope="partition")
    t.write(spark.createDataFrame([("a", "NY", 1, "a1"), ("b", "CA", 1, "b1")], SCHEMA))
    t.compact()
    first = t.base_dir()
    t.write(spark.createDataFrame([("a", "NY", 2, "a2")], SCHEMA))
    t.compact()  # NY rewritten; CA still read from the first base
    assert maintenance.drop_unused_bases(t) == []
    t.write(spark.createDataFrame([("b", "CA", 2, "b2")], SCHEMA))
    t.compact()  # now nothing is read from the first base
    assert maintenance.drop_unused_bases(t) == [first]
    assert rows(t.snapshot()) == [("a", 2, "a2"), ("b", 2, "b2")]


def test_snapshot_joins_only_touched_partitions_of_the_base(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir, partition_by=("state",), key_scope="partition")
    t.write(spark.createDataFrame([("a", "NY", 1, "a1"), ("b", "CA", 1, "b1"), ("c", "TX", 1, "c1")], SCHEMA))
    t.compact()
    t.write(spark.createDataFrame([("a", "NY", 2, "a2")], SCHEMA))
    snap = t.snapshot()
    plan = snap._jdf.queryExecution().executedPlan().toString()
    base_scans = [line for line in plan.splitlines() if "Scan parquet" in line and "/base/" in line]
    # every base scan is restricted by a partition filter on the touched value
    assert base_scans and all("PartitionFilters: [" in line and "NY" in line for line in base_scans)
    assert rows(snap, ("id", "state", "v")) == [("a", "NY", "a2"), ("b", "CA", "b1"), ("c", "TX", "c1")]


def test_explicit_commit_time_collision_fails_cleanly(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    c = t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    with pytest.raises(Exception):
        t.write(spark.createDataFrame([("b", "x", 1, "b1")], SCHEMA), commit_time=c)
    assert len(t.batches()) == 1 and t.batches()[0].startswith(f"_batch={c}")
    assert rows(t.snapshot()) == [("a", 1, "a1")]


def test_import_with_batch_id_is_idempotent(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    df = spark.createDataFrame([("a", "x", 1, "a1", "100"), ("b", "x", 1, "b1", "101")], SCHEMA + ", ct string")
    assert t.import_changelog(df, "ct", batch_id="replay-1") is not None
    assert t.import_changelog(df, "ct", batch_id="replay-1") is None  # the replay is a no-op
    assert len(t.incremental(None, mode="changes").collect()) == 2


def test_snapshot_after_compaction_lists_only_newer_batches(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    for i in range(3):
        t.write(spark.createDataFrame([(f"k{i}", "x", i, f"v{i}")], SCHEMA))
    t.compact()
    t.write(spark.createDataFrame([("k9", "x", 9, "v9")], SCHEMA))
    plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    log_scans = [line for line in plan.splitlines() if "Scan parquet" in line and "/log/" in line]
    # three older batches are covered by the base and never listed
    assert log_scans and all("InMemoryFileIndex(1 paths)" in line for line in log_scans)
    assert len(rows(t.snapshot())) == 4


def test_overtaken_batch_is_refused(spark, tmp_table_dir):
    from tidemark.functions.columns import COMMIT_COL, DELETED_COL
    from tidemark.plans.commitlog import WriteOptions

    t = table(spark, tmp_table_dir)
    stale = "20000101000000000"  # a commit time taken before another writer published
    newer = t.write(spark.createDataFrame([("b", "x", 1, "b1")], SCHEMA))
    staged = spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA).withColumn(DELETED_COL, F.lit(False))
    with pytest.raises(ValueError, match="published meanwhile"):
        t._write_batch(staged.withColumn(COMMIT_COL, F.lit(stale)), stale, WriteOptions(), newest=True)
    assert CommitLogTable.open(spark, tmp_table_dir).commits() == [newer]


def _import(spark, t, *rows):
    df = spark.createDataFrame([r[:-1] for r in rows], SCHEMA)
    times = {r[0]: r[-1] for r in rows}
    of = F.lit(None).cast("string")
    for k, c in times.items():
        of = F.when(F.col("id") == k, c).otherwise(of)
    return t.import_changelog(df.withColumn("c", of), "c")


def test_commit_order_is_refused_or_kept(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    _import(spark, t, ("a", "x", 1, "a1", "2024010105"))
    with pytest.raises(ValueError, match="widths"):
        _import(spark, t, ("b", "x", 1, "b1", "9"), ("c", "x", 1, "c1", "10"))
    t.compact()
    with pytest.raises(ValueError, match="compacted base"):
        _import(spark, t, ("b", "x", 1, "b1", "2024010103"))
    with pytest.raises(ValueError, match="does not sort after"):
        t.write(spark.createDataFrame([("b", "x", 1, "b1")], SCHEMA), commit_time="2024010105")
    t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    assert rows(t.snapshot()) == [("a", 2, "a2")]


def test_no_time_of_ours_after_other_letters(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    _import(spark, t, ("a", "x", 1, "a1", "c0001"))
    with pytest.raises(ValueError, match="pass commit_time"):
        t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA), commit_time="c0002")
    assert rows(t.snapshot()) == [("a", 2, "a2")]


def test_bounded_reads_after_compaction(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    commits = [t.write(spark.createDataFrame([("a", "x", i, f"a{i}"), (f"k{i}", "x", i, "k")], SCHEMA)) for i in range(4)]
    t.compact()
    got = t.incremental(commits[0], commits[1], mode="latest_state")
    assert sorted(r["v"] for r in got.collect()) == ["a1", "k"]
    t.drop_log_through(t.base_end())
    with pytest.raises(ValueError, match="removed"):
        t.incremental(commits[0], commits[1], mode="latest_state")
    with pytest.raises(ValueError, match="retention"):
        t.versions(2)


def test_retention_keeps_keys_of_the_base_and_counts_apart(spark, tmp_table_dir):
    from tidemark.plans.maintenance import retain_versions

    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("old", "x", 1, "o")], SCHEMA))
    t.compact()
    t.drop_log_through(t.base_end())
    for i in range(3):
        t.write(spark.createDataFrame([("a", "x", i, f"a{i}")], SCHEMA))
    assert sorted(r["v"] for r in retain_versions(t, 3).collect()) == ["a0", "a1", "a2", "o"]
    assert sorted(r["v"] for r in retain_versions(t, 1).collect()) == ["a2", "o"]


def test_type_drift_and_other_settings_are_refused(spark, tmp_table_dir):
    from dataclasses import replace

    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    with pytest.raises(ValueError, match="types differ"):
        t.write(spark.createDataFrame([("a", "x", 1, 5)], SCHEMA.replace("v string", "v long")))
    with pytest.raises(ValueError, match="other settings"):
        CommitLogTable.create(spark, tmp_table_dir, replace(t.spec, merge_mode="event_time"))


def test_keys_only_upsert(spark, tmp_table_dir):
    from tidemark.plans.commitlog import TableSpec

    t = CommitLogTable.create(spark, tmp_table_dir, TableSpec(name="keys", keys=("id",)))
    t.write(spark.createDataFrame([("a",), ("a",), ("b",)], "id string"))
    assert sorted(r["id"] for r in t.snapshot().collect()) == ["a", "b"]


def test_lookup_pushes_the_key_filter_into_the_scans(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([(f"k{i}", "x", i, f"v{i}") for i in range(20)], SCHEMA))
    t.compact()
    t.write(spark.createDataFrame([("k3", "x", 9, "v3b")], SCHEMA))
    found = t.lookup("id", ["k3", "k7"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "Scan parquet" in line]
    assert scans and all("PushedFilters: [" in line and "In(id, [k3,k7])" in line for line in scans)
    assert rows(found) == [("k3", 9, "v3b"), ("k7", 7, "v7")]
    with pytest.raises(ValueError):
        t.lookup("v", ["x"])


def test_half_written_metadata_is_ignored(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    with open(f"{tmp_table_dir}/_meta/.v99999999999999999.json.dead.tmp", "w") as fh:
        fh.write('{"version": "9999')  # a writer died mid-write
    assert rows(CommitLogTable.open(spark, tmp_table_dir).snapshot()) == [("a", 1, "a1")]


def test_reads_before_the_base_are_refused(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir, merge_mode="event_time")
    c1 = t.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    t.write(spark.createDataFrame([("a", "x", 2, "a2")], SCHEMA))
    t.compact()
    with pytest.raises(ValueError):
        t.snapshot(as_of=c1)  # the versions before the base end are folded
    # a bounded increment is answered from the log while that is whole
    assert rows(t.incremental(None, end=c1)) == [("a", 1, "a1")]
    assert rows(t.snapshot(as_of=t.base_end())) == [("a", 2, "a2")]


def test_single_upsert_batch_snapshot_skips_the_window(spark, tmp_table_dir):
    t = table(spark, tmp_table_dir)
    t.write(spark.createDataFrame([("a", "x", 1, "a1"), ("a", "x", 2, "a2"), ("b", "x", 1, "b1")], SCHEMA))
    plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert rows(t.snapshot()) == [("a", 2, "a2"), ("b", 1, "b1")]
    # a second commit, an insert batch or another key scope all use the ranking
    t.write(spark.createDataFrame([("a", "x", 0, "a0")], SCHEMA))
    assert "Window" in t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert rows(t.snapshot()) == [("a", 0, "a0"), ("b", 1, "b1")]
    view = table(spark, f"{tmp_table_dir}-2").with_spec(key_scope="table")
    assert view._fast_path is False


def test_writes_keep_columns_added_by_another_instance(spark, tmp_table_dir):
    first = table(spark, tmp_table_dir)
    first.write(spark.createDataFrame([("a", "x", 1, "a1")], SCHEMA))
    other = CommitLogTable.open(spark, tmp_table_dir)
    other.write(spark.createDataFrame([("b", "x", 1, "b1", 7)], SCHEMA + ", extra int"))
    first.write(spark.createDataFrame([("c", "x", 1, "c1")], SCHEMA))  # its cached schema lacks `extra`
    snap = CommitLogTable.open(spark, tmp_table_dir).snapshot()
    assert sorted(tuple(r) for r in snap.select("id", "extra").collect()) == [("a", None), ("b", 7), ("c", None)]


def test_late_imports_are_refused(spark, tmp_table_dir):
    """A commit before the newest would be in the snapshot but in no later increment."""
    table = CommitLogTable.create(spark, f"{tmp_table_dir}/late", TableSpec(name="late", keys=("k",)))
    rows = spark.createDataFrame([(1, "2024010105")], "k int, c string")
    assert table.import_changelog(rows, "c")
    late = spark.createDataFrame([(2, "2024010103")], "k int, c string")
    with pytest.raises(ValueError, match="does not sort after"):
        table.import_changelog(late, "c")
    assert [r.k for r in table.snapshot().collect()] == [1] and table.commits() == ["2024010105"]
    assert table.import_changelog(spark.createDataFrame([(3, "2024010106")], "k int, c string"), "c")


def test_null_partitions_are_deleted_and_overwritten_like_others(spark, tmp_table_dir):
    """A NULL partition value equals itself in every key join: deletes, compacted bases, increments, retention."""
    for mode in ("incoming_wins", "event_time"):
        t = table(spark, f"{tmp_table_dir}/{mode}", partition_by=("state",), merge_mode=mode)
        t.write(spark.createDataFrame([("a", None, 1, "a1"), ("b", None, 1, "b1"), ("c", "x", 1, "c1")], SCHEMA))
        t.compact()
        t.write(spark.createDataFrame([("a", None, 2, "a2")], SCHEMA))
        t.delete(spark.createDataFrame([("b", None)], "id string, state string"))
        assert rows(t.snapshot()) == [("a", 2, "a2"), ("c", 1, "c1")]
        assert rows(t.incremental(t.commits()[0])) == [("a", 2, "a2")]
        assert rows(maintenance.retain_versions(t, 1)) == [("a", 2, "a2"), ("c", 1, "c1")]
