"""Items scanned by segments and put by a data source's tasks."""

from __future__ import annotations

import gzip
import io
import json
import os
import random
import subprocess
import sys
import textwrap

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources.item_files import committed_files, current_items, cut_segments, lines_in, put_items, scan_items
from tidemark.sources.loaders import Loaders

SCHEMA = "k long, v string, x double"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text("ab{é", max_size=9), max_size=8), max_size=4), st.integers(1, 12), st.integers(1, 7), st.booleans())
def test_every_line_is_in_one_segment(files, segments, block, ends):
    data = {str(i): ("\n".join(lines) + ("\n" if ends and lines else "")).encode() for i, lines in enumerate(files)}
    found = []
    for s in cut_segments([(p, len(d), None) for p, d in data.items()], segments):
        for path, lo, hi, _ in s.ranges:
            found += b"".join(lines_in(io.BytesIO(data[path]), lo, hi, block)).split(b"\n") if hi > lo else []
    want = [x for d in data.values() for x in d.split(b"\n")]
    assert sorted(x for x in found if x) == sorted(x for x in want if x)


def test_segments_are_even_and_cover_everything():
    files = [("a", 1000, None), ("b", 10, None), ("c", 90, None)]
    cut = cut_segments(files, 5)
    sizes = [sum(hi - lo for _, lo, hi, _ in s.ranges) for s in cut]
    assert sizes == [220] * 5 and cut_segments([], 3)[0].ranges == []


def export(path, n=500):
    r = random.Random(1)
    rows = [(i, None if i % 7 == 0 else f"v{i}é" * r.randint(1, 30), i / 4) for i in range(n)]
    os.makedirs(path)
    for part, name in enumerate(("a.json", "b.json", "c.json.gz", "_hidden.json", ".d.json")):
        lines = "\n\n".join(json.dumps({"x": x, "k": k, "other": [1], **({"v": v} if v else {})}) for k, v, x in rows[part::3]) if part < 3 else "broken"
        with gzip.open(f"{path}/{name}", "wt") if name.endswith("gz") else open(f"{path}/{name}", "w") as f:
            f.write(lines)
    return sorted(rows)


@pytest.mark.parametrize("segments", [1, 3, 40, None])
def test_the_number_of_segments_does_not_change_the_rows(spark, tmp_table_dir, segments):
    rows = export(f"{tmp_table_dir}/export")
    df = scan_items(spark, f"{tmp_table_dir}/export", SCHEMA, segments)
    assert sorted(map(tuple, df.collect())) == rows
    if segments:
        assert df.rdd.getNumPartitions() <= segments


def test_local_uris_are_paths(spark, tmp_table_dir):
    put_items(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), f"file://{tmp_table_dir}/items", "1")
    for path in (f"file:{tmp_table_dir}/items", f"file://{tmp_table_dir}/items/", f"{tmp_table_dir}/items"):
        assert [r.k for r in scan_items(spark, path, SCHEMA).collect()] == [1]


def test_loader_scans_items_by_segments(spark, tmp_table_dir):
    rows = export(f"{tmp_table_dir}/export", 60)
    Loaders({"source": [{"source_type": "ITEMS", "spark_table_name": "seg_items", "path": f"{tmp_table_dir}/export", "schema": SCHEMA, "segments": 4}]}, spark).load()
    assert spark.table("seg_items").count() == len(rows)


def test_puts_and_their_edges(spark, tmp_table_dir):
    path = f"{tmp_table_dir}/items"
    first = spark.createDataFrame([(i, "a", 1.0) for i in range(50)] + [(7, "z", 1.0)], SCHEMA).repartition(4)
    put_items(first, path, "1")
    put_items(spark.createDataFrame([(i, None if i else "é\n\"", 2.0) for i in range(0, 50, 5)], SCHEMA), path, "2")
    put_items(spark.createDataFrame([], SCHEMA), path, "3")
    want = {i: ("a", 1.0) for i in range(50)} | {7: ("z", 1.0)} | {i: (None if i else "é\n\"", 2.0) for i in range(0, 50, 5)}
    assert {r.k: (r.v, r.x) for r in current_items(spark, path, SCHEMA, ["k"], 3).collect()} == want
    before = committed_files(path)
    put_items(first, path, "1")  # a replay of a published put changes nothing
    assert committed_files(path) == before and {f for _, _, f in before} == {"1", "2"}
    stored = {f"{d}/{f}" for d, _, names in os.walk(f"{path}/items") for f in names if not f.endswith(".crc")}
    assert stored == {f for f, _, _ in before}
    with pytest.raises(PySparkException):
        scan_items(spark, path, "k string, v string").collect()
    with pytest.raises(PySparkException):
        first.write.format("tidemark_items").mode("append").option("commit", "4").save(path)


def test_a_failed_put_leaves_nothing(spark, tmp_table_dir):
    path = f"{tmp_table_dir}/items"
    put_items(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), path, "1")
    bad = spark.range(100, numPartitions=4).select(F.col("id").alias("k"), F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise("b").alias("v"), F.lit(0.0).alias("x"))
    with pytest.raises(PySparkException):
        put_items(bad, path, "2")
    assert [r.k for r in scan_items(spark, path, SCHEMA).collect()] == [1]
    assert not os.path.exists(f"{path}/_puts/2.json") and not os.path.exists(f"{path}/items/2")


def test_a_killed_task_attempt_leaves_no_partial_or_double_item(tmp_table_dir):
    """One worker dies after half of its rows; the retried attempt's file alone is published."""
    code = f"""
        import os, signal
        from pyspark.sql import functions as F
        from tidemark.session import build_session
        from tidemark.sources.item_files import put_items, scan_items, committed_files
        spark = build_session("local[2,3]", conf={{"spark.sql.shuffle.partitions": "2", "spark.sql.execution.arrow.maxRecordsPerBatch": "50"}})

        def dies_once(batches):
            from pyspark import TaskContext
            for i, b in enumerate(batches):
                if i == 2 and TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
                    open({tmp_table_dir!r} + "/killed", "w").close()
                    os.kill(os.getpid(), signal.SIGKILL)
                yield b

        rows = spark.range(0, 1000, 1, 2).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        path = {tmp_table_dir!r} + "/items"
        put_items(rows.mapInArrow(dies_once, rows.schema), path, "1")
        got = sorted(r.k for r in scan_items(spark, path, "k long", 5).collect())
        assert got == list(range(1000)), len(got)
        stored = [f for f in os.listdir(path + "/items/1") if not f.endswith(".crc")]
        assert sorted(stored) == sorted(os.path.basename(f) for f, _, _ in committed_files(path)) and len(stored) == 2
    """
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert os.path.exists(f"{tmp_table_dir}/killed")
