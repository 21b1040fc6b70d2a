"""Checkpoints, the two-phase incremental reader, loaders, sinks, streaming."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.checkpoint import CheckpointStore
from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.plans.incremental import ChangeFeedSource, CommitLogSource, IncrementalReader
from tidemark.sinks.keyed import KeyedSink, put_partitions
from tidemark.sources.loaders import Loaders
from tidemark.streaming.incremental import upsert_stream

SCHEMA = "id string, ts long, v string"


def mk_table(spark, path):
    spec = TableSpec(name="t", keys=("id",), precombine="ts", tie_breakers=("v",), table_type="MERGE_ON_READ")
    return CommitLogTable.create(spark, path, spec)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_checkpoint_store_roundtrip(spark, tmp_table_dir):
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    assert store.read("t") is None and not store.exists("t")
    store.write("t", "/p", "100")
    store.write("t", "/p", "200")
    assert store.read("t").last_processed_commit == "200"
    store.reset("t")
    assert store.read("t") is None


def test_reader_first_later_empty_and_failed_sink(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    reader = IncrementalReader(store, CommitLogSource(t, mode="changes"))

    t.write(spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA))
    rows, pending = reader.read()  # first run: everything
    assert ids(rows) == ["a", "b"]
    pending.commit()

    rows, pending = reader.read()  # nothing new
    assert rows.isEmpty() and pending is None

    t.write(spark.createDataFrame([("c", 1, "c1")], SCHEMA))
    rows, pending = reader.read()
    assert ids(rows) == ["c"]
    # the sink fails: no commit, so the next run sees the same rows
    rows, pending = reader.read()
    assert ids(rows) == ["c"]
    pending.commit()
    assert reader.read()[1] is None


def test_reader_caps_commits(spark, tmp_table_dir):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), (F.lit(100) + F.col("id")).alias("c"))
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    reader = IncrementalReader(store, ChangeFeedSource(df, "c", "feed"), max_commits=4)
    seen = []
    while True:
        rows, pending = reader.read()
        if pending is None:
            break
        seen.append(ids(rows))
        pending.commit()
    assert seen == [["0", "1", "2", "3"], ["4", "5", "6", "7"], ["8", "9"]]


def test_loader_statuses_and_errors(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    t.write(spark.createDataFrame([("a", 1, "a1")], SCHEMA))
    payload = {
        "check_point_buckets": f"{tmp_table_dir}/ckpt",
        "source": [
            {"source_type": "TABLE", "table_name": "t", "spark_table_name": "t_full", "path": t.path, "type": "FULL"},
            {"source_type": "TABLE", "table_name": "t", "spark_table_name": "t_inc", "path": t.path, "type": "INC"},
            {"source_type": "TABLE", "table_name": "x", "spark_table_name": "missing",
             "path": f"{tmp_table_dir}/nope", "type": "FULL"},
        ],
    }
    result = Loaders(payload, spark, on_error="skip").load()
    assert result.status == {"t_full": True, "t_inc": True, "missing": False}
    assert ids(spark.table("t_inc")) == ["a"]
    result.commit()
    assert CheckpointStore(spark, f"{tmp_table_dir}/ckpt").exists("t")
    with pytest.raises(FileNotFoundError):
        Loaders(payload, spark).load()
    with pytest.raises(ValueError):
        Loaders({"source": [{"source_type": "KEYVALUE", "spark_table_name": "x"}]}, spark)


def test_items_source(spark, tmp_table_dir):
    path = f"{tmp_table_dir}/items.jsonl"
    with open(path, "w") as fh:
        fh.write(json.dumps({"customer_id": "c1", "order_id": "o1", "n": 1.5, "tags": ["x"]}) + "\n")
        fh.write(json.dumps({"customer_id": "c2", "order_id": "o2", "nested": {"a": 1}}) + "\n")
        fh.write('{"customer_id": "c3", "order_id": "o3", "n": 12.25}\n')
    payload = {"source": [{"source_type": "ITEMS", "spark_table_name": "items_v", "path": path}]}
    Loaders(payload, spark).load()
    df = spark.table("items_v")
    assert set(df.columns) == {"customer_id", "order_id", "n", "tags", "nested"}
    assert df.filter("customer_id = 'c2'").first()["n"] is None
    assert dict(df.dtypes)["n"].startswith("decimal")  # amounts keep exact decimals
    assert str(df.filter("customer_id = 'c3'").first()["n"]) == "12.25"


def test_keyed_sink_last_write_wins_and_replay(spark, tmp_table_dir):
    sink = KeyedSink(spark, f"{tmp_table_dir}/kv", "customer_id", "order_id", order_by=["seq"])
    batch = spark.createDataFrame(
        [(1, 10, 5.0, 1), (1, 10, 6.0, 2), (2, 20, None, 1)], "customer_id long, order_id long, value double, seq int"
    )
    sink.put(batch)
    sink.put(batch)  # replay: same items
    got = sorted(tuple(r) for r in sink.items().select("customer_id", "order_id", "value").collect())
    assert got == [(1, 10, "6.0"), (2, 20, None)]


def test_put_partitions_sends_every_item_once(spark, tmp_table_dir):
    out = f"{tmp_table_dir}/ext"
    os.makedirs(out)
    df = spark.range(100).select((F.col("id") % 10).alias("h"), F.col("id").alias("r"), F.lit(1).alias("x"))

    def make_client(root=out):
        # test double for an external store: one JSON-lines file per client
        import json as _json
        import os as _os
        import uuid as _uuid

        class FileClient:
            def __init__(self):
                self.path = _os.path.join(root, f"{_uuid.uuid4().hex}.jsonl")

            def put_batch(self, items):
                with open(self.path, "a") as fh:
                    for it in items:
                        fh.write(_json.dumps(it) + "\n")

        return FileClient()

    put_partitions(df, make_client, "h", "r", batch_size=7)
    items = [json.loads(line) for f in os.listdir(out) for line in open(os.path.join(out, f))]
    assert sorted((i["h"], i["r"]) for i in items) == sorted((r % 10, r) for r in range(100))


def test_stream_replica_equals_snapshot(spark, tmp_table_dir):
    src = mk_table(spark, f"{tmp_table_dir}/src")
    dst = CommitLogTable.create(spark, f"{tmp_table_dir}/dst", src.spec)
    ckpt = f"{tmp_table_dir}/stream"
    src.write(spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA))
    src.write(spark.createDataFrame([("a", 0, "a-late")], SCHEMA))
    upsert_stream(src, dst, ckpt).awaitTermination()
    snap = lambda t: sorted((r["id"], r["v"]) for r in t.snapshot().collect())
    assert snap(dst) == snap(src) == [("a", "a-late"), ("b", "b1")]
    # restart: only the new commit is processed
    src.write(spark.createDataFrame([("c", 1, "c1")], SCHEMA))
    src.delete(spark.createDataFrame([("b",)], "id string"))
    upsert_stream(src, dst, ckpt).awaitTermination()
    assert snap(dst) == snap(src) == [("a", "a-late"), ("c", "c1")]


def test_stream_delete_then_reinsert_in_one_batch(spark, tmp_table_dir):
    src = mk_table(spark, f"{tmp_table_dir}/src")
    dst = CommitLogTable.create(spark, f"{tmp_table_dir}/dst", src.spec)
    src.write(spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA))
    src.delete(spark.createDataFrame([("a",), ("b",)], "id string"))
    src.write(spark.createDataFrame([("a", 0, "a-back")], SCHEMA))
    upsert_stream(src, dst, f"{tmp_table_dir}/stream").awaitTermination()
    snap = lambda t: sorted((r["id"], r["v"]) for r in t.snapshot().collect())
    assert snap(dst) == snap(src) == [("a", "a-back")]


def test_checkpoint_prune_keeps_latest(spark, tmp_table_dir):
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    for c in ("100", "200", "300", "400"):
        store.write("t", "/p", c)
    assert len(store.prune("t", keep=2)) == 2
    assert store.read("t").last_processed_commit == "400"
    assert store.frame("t").count() == 2


def test_stream_mirror_is_exact_in_small_micro_batches(spark, tmp_table_dir):
    src = mk_table(spark, f"{tmp_table_dir}/src")
    dst = CommitLogTable.create(spark, f"{tmp_table_dir}/dst", src.spec)
    # an insert commit with several versions of one key, spread over files
    many = spark.createDataFrame([("a", i, f"a{i}") for i in range(8)] + [("b", 1, "b1")], SCHEMA).repartition(4)
    src.write(many, operation="insert")
    src.delete(spark.createDataFrame([("b",)], "id string"))
    src.write(spark.createDataFrame([("c", 1, "c1")], SCHEMA))
    upsert_stream(src, dst, f"{tmp_table_dir}/stream", max_files_per_trigger=1).awaitTermination()
    snap = lambda t: sorted((r["id"], r["v"], r["_commit_time"]) for r in t.snapshot(with_meta=True).collect())
    assert snap(dst) == snap(src)
    assert sorted(r["id"] for r in dst.snapshot().collect()) == ["a", "c"]


def test_reader_never_skips_a_batch_finished_mid_read(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    store = CheckpointStore(spark, f"{tmp_table_dir}/ckpt")
    source = CommitLogSource(t, mode="changes")
    t.write(spark.createDataFrame([("a", 1, "a1")], SCHEMA))
    end = source.last_after(None, None)  # the cycle has chosen its range end ...
    CommitLogTable.open(spark, t.path).write(spark.createDataFrame([("b", 1, "b1")], SCHEMA))  # ... a batch lands
    assert ids(source.read_range(None, end)) == ["a"]  # not in this cycle
    store.write(source.table_name, source.path, end)
    rows, _ = IncrementalReader(store, source).read()
    assert ids(rows) == ["b"]  # picked up by the next cycle, not lost


def test_sinks_never_collect_to_the_driver(spark, tmp_table_dir, monkeypatch):
    from pyspark.sql import DataFrame

    df = spark.range(1000).select(
        (F.col("id") % 7).alias("customer_id"), F.col("id").alias("order_id"), (F.col("id") * 1.5).alias("value")
    )
    out = f"{tmp_table_dir}/ext"
    os.makedirs(out)

    def make_client(root=out):
        import os as _os
        import uuid as _uuid

        class Client:
            def put_batch(self, items):
                with open(_os.path.join(root, _uuid.uuid4().hex), "w") as fh:
                    fh.write(str(len(items)))

        return Client()

    def refuse(*_a, **_k):
        raise AssertionError("rows were pulled to the driver")

    for name in ("collect", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refuse)
    KeyedSink(spark, f"{tmp_table_dir}/kv", "customer_id", "order_id").put(df)
    put_partitions(df, make_client, "customer_id", "order_id", batch_size=100)
    monkeypatch.undo()
    assert sum(int(open(os.path.join(out, f)).read()) for f in os.listdir(out)) == 1000
    assert KeyedSink(spark, f"{tmp_table_dir}/kv", "customer_id", "order_id").items().count() == 1000


def test_new_mirror_bootstraps_from_a_compacted_source(spark, tmp_table_dir):
    src = mk_table(spark, f"{tmp_table_dir}/src")
    dst = CommitLogTable.create(spark, f"{tmp_table_dir}/dst", src.spec)
    src.write(spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA))
    src.write(spark.createDataFrame([("a", 2, "a2")], SCHEMA))
    src.compact()
    src.drop_log_through(src.base_end())  # the early log is gone
    src.write(spark.createDataFrame([("c", 1, "c1")], SCHEMA))
    ckpt = f"{tmp_table_dir}/stream"
    upsert_stream(src, dst, ckpt).awaitTermination()
    snap = lambda t: sorted((r["id"], r["v"], r["_commit_time"]) for r in t.snapshot(with_meta=True).collect())
    assert snap(dst) == snap(src)
    # restart after more commits: the bootstrap is not repeated
    src.write(spark.createDataFrame([("b", 5, "b5")], SCHEMA))
    upsert_stream(src, dst, ckpt).awaitTermination()
    assert snap(dst) == snap(src)
    assert len(dst.incremental(None, mode="changes").collect()) == 4  # a2, b1 (base), c1, b5: no duplicates


def test_expand_heterogeneous_items(spark):
    from tidemark.sources.items import expand_items

    df = spark.createDataFrame(
        [(1, '{"k": 1, "tags": [{"a": 1}]}'), (2, '{"k": "x", "amt": 1.5}'), (3, '{"amt": 10.25, "m": {"z": true}}')],
        "id long, props string",
    )
    out = expand_items(df, "props", keep=["id"])
    types = dict(out.dtypes)
    # missing keys are NULL, mixed types stay whole as VARIANT, amounts exact
    assert types["amt"] == "decimal(4,2)" and types["k"] == "variant"
    assert types["m"] == "struct<z:boolean>" and types["tags"] == "array<struct<a:bigint>>"
    got = {r["id"]: r for r in out.collect()}
    assert str(got[3]["amt"]) == "10.25" and got[1]["amt"] is None and got[3]["k"] is None


def test_item_field_reads_typed_attributes(spark):
    from tidemark.sources.items import item_field

    df = spark.createDataFrame([(1, '{"k": 69, "s": "x"}'), (2, '{"s": 5}')], "id long, props string")
    got = {r["id"]: (r["k"], r["s"]) for r in df.select(
        "id", item_field("props", "$.k", "bigint").alias("k"), item_field("props", "$.s", "string").alias("s")
    ).collect()}
    assert got == {1: (69, "x"), 2: (None, "5")}


def test_unique_keys_put_gives_the_same_items_even_with_duplicates(spark, tmp_table_dir):
    batch = spark.createDataFrame(
        [(1, 10, "a"), (1, 10, "b"), (2, 20, "c"), (2, 21, "d")], "customer_id long, order_id long, value string"
    )
    plain = KeyedSink(spark, f"{tmp_table_dir}/plain", "customer_id", "order_id")
    fast = KeyedSink(spark, f"{tmp_table_dir}/fast", "customer_id", "order_id")
    plain.put(batch)
    fast.put(batch, unique_keys=True)
    as_rows = lambda s: sorted(tuple(r) for r in s.items().collect())
    assert as_rows(fast) == as_rows(plain) == [(1, 10, "b"), (2, 20, "c"), (2, 21, "d")]


def test_sink_put_if_absent_keeps_stored_items(spark, tmp_table_dir):
    sink = KeyedSink(spark, f"{tmp_table_dir}/kv", "customer_id", "order_id")
    schema = "customer_id long, order_id long, value string"
    sink.put(spark.createDataFrame([(1, 10, "stored")], schema))
    sink.put_if_absent(spark.createDataFrame([(1, 10, "new"), (2, 20, "added")], schema))
    assert sink.put_if_absent(spark.createDataFrame([(2, 20, "again")], schema)) is None
    assert sorted(tuple(r) for r in sink.items().collect()) == [(1, 10, "stored"), (2, 20, "added")]


def test_loader_type_aliases(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    t.write(spark.createDataFrame([("a", 1, "a1")], SCHEMA))
    payload = {"source": [{"source_type": "LAKE", "table_name": "t", "spark_table_name": "aliased",
                           "path": t.path, "type": "FULL"}]}
    with pytest.raises(ValueError):
        Loaders(payload, spark)
    Loaders(payload, spark, type_aliases={"LAKE": "TABLE"}).load()
    assert ids(spark.table("aliased")) == ["a"]


def test_long_lived_reader_sees_other_writers(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    t.write(spark.createDataFrame([("a", 1, "a1")], SCHEMA))
    reader = IncrementalReader(CheckpointStore(spark, f"{tmp_table_dir}/ckpt"), CommitLogSource(t, "changes"))
    rows, pending = reader.read()
    pending.commit()
    CommitLogTable.open(spark, t.path).write(spark.createDataFrame([("b", 1, "b1")], SCHEMA))  # another writer
    rows, pending = reader.read()
    assert ids(rows) == ["b"]


def test_loader_caps_an_incremental_catch_up(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    for i in range(5):
        t.write(spark.createDataFrame([(f"k{i}", i, f"v{i}")], SCHEMA))
    payload = {"check_point_buckets": f"{tmp_table_dir}/ckpt",
               "source": [{"source_type": "TABLE", "table_name": "t", "spark_table_name": "capped",
                           "path": t.path, "type": "INC", "increment_mode": "changes", "max_commits": 2}]}
    seen = []
    for _ in range(4):
        result = Loaders(payload, spark).load()
        seen.append(ids(spark.table("capped")))
        result.commit()
    assert seen == [["k0", "k1"], ["k2", "k3"], ["k4"], []]


def test_loader_projects_table_sources(spark, tmp_table_dir):
    t = mk_table(spark, f"{tmp_table_dir}/t")
    t.write(spark.createDataFrame([("a", 1, "a1")], SCHEMA))
    payload = {"source": [{"source_type": "TABLE", "table_name": "t", "spark_table_name": "projected",
                           "path": t.path, "type": "FULL", "select": ["id", "upper(v) AS v_upper"]}]}
    Loaders(payload, spark).load()
    assert [tuple(r) for r in spark.table("projected").collect()] == [("a", "A1")]


def test_keyed_sink_with_hash_key_only(spark, tmp_table_dir):
    sink = KeyedSink(spark, f"{tmp_table_dir}/kv", "customer_id", attributes=["total"], order_by=["seq"])
    df = spark.createDataFrame([(1, 10.0, 1, "x"), (1, 12.5, 2, "y"), (2, 3.0, 1, "z")],
                               "customer_id long, total double, seq int, other string")
    sink.put(df)
    got = sorted(tuple(r) for r in sink.items().collect())
    assert got == [(1, "12.5"), (2, "3.0")] and sink.items().columns == ["customer_id", "total"]
