"""Metrics kept up to date from increments, and the stream-static join."""

from __future__ import annotations

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.plans.commitlog import CommitLogTable, TableSpec
from tidemark.plans.metrics_view import MaintainedMetrics
from tidemark.sinks.keyed import KeyedSink
from tidemark.streaming.join import join_stream

ORDERS = "order_id long, customer_id long, order_value string, order_date date"


def orders_table(spark, path, **kw):
    return CommitLogTable.create(spark, path, TableSpec(name="orders", keys=("order_id",), key_scope="table", table_type="MERGE_ON_READ", **kw))


def whole(table):
    rows = metrics.order_metrics(table.refresh().snapshot().filter("customer_id is not null"))
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_metrics_equal_a_recomputation_after_every_commit(spark, tmp_table_dir, seed):
    r = random.Random(seed)
    table = orders_table(spark, f"{tmp_table_dir}/orders")
    kept = MaintainedMetrics(spark, table, f"{tmp_table_dir}/metrics")
    assert kept.refresh() is None

    def row(i):
        return (i, r.choice([None, 1, 2, 3, 4]), r.choice([None, "10.5", "3", "0.0000000001"]), r.choice([None] + [date(2024, 1, 1) + timedelta(d) for d in range(4)]))

    known = set()
    for step in range(5):
        ids = r.sample(range(14), r.randint(1, 6))
        if step % 3 == 2:
            table.delete(spark.createDataFrame([(i,) for i in ids], "order_id long"))
            known -= set(ids)
        else:
            table.write(spark.createDataFrame([row(i) for i in ids], ORDERS))
            known |= set(ids)
        kept.refresh()
        got = sorted(map(tuple, kept.read().collect()), key=str)
        assert got == whole(table)
    assert kept.refresh() is None and len(known) > 0


def test_only_customers_whose_extreme_left_are_read_again(spark):
    state = spark.createDataFrame(
        [(c, 3, 30.0, 3, date(2024, 1, 1), date(2024, 1, 9)) for c in range(1, 6)],
        "customer_id long, n_orders long, total_value double, n_amounts long, first_order date, last_order date")
    before = [(1, "10", date(2024, 1, 1)), (2, "10", date(2024, 1, 5)), (3, "10", date(2024, 1, 9)), (4, "10", date(2024, 1, 1))]
    after = [(3, "11", date(2024, 1, 9)), (4, "1", date(2023, 1, 1)), (9, "7", date(2024, 1, 5))]
    schema = "customer_id long, order_value string, order_date date"
    delta = metrics.metrics_delta(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema))
    got = {r.customer_id: r for r in metrics.apply_delta(state, delta).collect()}
    assert {c for c, r in got.items() if r.lost} == {1}
    assert (got[2].n_orders, float(got[2].total_value)) == (2, 20.0) and float(got[3].total_value) == 31.0
    assert got[4].first_order == date(2023, 1, 1) and got[9].n_orders == 1 and 5 not in got


def test_images_are_summed_in_stages_of_their_own(spark):
    """No task sorts and sums the old and the new images both: each has its exchange by customer, and sums meet sums."""
    schema = "customer_id long, order_value string, order_date date"
    before = [(1, "10.0000000001", date(2024, 1, 1)), (1, None, date(2024, 1, 2)), (2, "3", None), (None, "5", date(2024, 1, 5))]
    after = [(1, "4", date(2024, 1, 3)), (3, "7", date(2024, 1, 4)), (None, "5", date(2024, 1, 5))]
    delta = metrics.metrics_delta(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema))
    assert delta.schema["d_value"].dataType.simpleString() == "decimal(38,10)"
    got = sorted((r.customer_id, r.d_orders, str(r.d_value), r.added_amounts, r.taken_amounts, r.added_first, r.added_last, r.taken_first, r.taken_last) for r in delta.collect())
    assert got == [
        (1, -1, "-6.0000000001", 1, 1, date(2024, 1, 3), date(2024, 1, 3), date(2024, 1, 1), date(2024, 1, 2)),
        (2, -1, "-3.0000000000", 0, 1, None, None, None, None),
        (3, 1, "7.0000000000", 1, 0, date(2024, 1, 4), date(2024, 1, 4), None, None)]
    plan = delta._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.index("Join FullOuter") < plan.index("Aggregate [") and plan.count("Aggregate [") == 2


@pytest.mark.parametrize("mode", ["incoming_wins", "event_time"])
def test_new_images_come_from_the_increment(spark, tmp_table_dir, monkeypatch, mode):
    """Where the newest commit wins, only the old images read the history; late orders still need both."""
    read = []
    plain = CommitLogTable.snapshot
    monkeypatch.setattr(CommitLogTable, "snapshot", lambda self, as_of=None, with_meta=False, of=None: read.append((self.path, as_of)) or plain(self, as_of, with_meta, of))
    path = f"{tmp_table_dir}/orders"
    table = orders_table(spark, path, merge_mode=mode, precombine="order_date")
    kept = MaintainedMetrics(spark, table, f"{tmp_table_dir}/metrics")
    day = lambda d: date(2024, 1, d)
    steps = [[(1, 1, "5", day(5)), (2, 2, "5", day(5)), (3, 2, "1", day(9))], [(1, 2, "6", day(4)), (4, 3, "1", day(1))], None, [(2, 1, "7", day(3)), (3, 3, "8", day(7))]]
    for step in steps:
        table.write(spark.createDataFrame(step, ORDERS)) if step else table.delete(spark.createDataFrame([(2,), (4,)], "order_id long"))
        kept.refresh()
        assert sorted(map(tuple, kept.read().collect()), key=str) == whole(table)
    # customer 3's new order loses no date, so nothing else reads the table as of its end
    table.write(spark.createDataFrame([(5, 3, "2", day(8))], ORDERS))
    del read[:]
    kept.refresh()
    assert sorted(map(tuple, kept.read().collect()), key=str) == whole(table)
    assert read.count((path, table.last_commit())) == (0 if mode == "incoming_wins" else 1)


def test_metrics_after_compaction_start_from_the_whole_table(spark, tmp_table_dir):
    """The old images are in a newer base, so customers without orders are found by comparison."""
    table = orders_table(spark, f"{tmp_table_dir}/orders")
    kept = MaintainedMetrics(spark, table, f"{tmp_table_dir}/metrics")
    table.write(spark.createDataFrame([(1, 1, "5", date(2024, 1, 1)), (2, 2, "5", date(2024, 1, 1))], ORDERS))
    kept.refresh()
    table.delete(spark.createDataFrame([(1,)], "order_id long"))
    table.compact()
    kept.refresh()
    assert sorted(map(tuple, kept.read().collect())) == whole(table) and [x[0] for x in whole(table)] == [2]


def test_ranking_sees_changed_customers_only(spark, tmp_table_dir):
    """The semi-join to the changed orders is below the window that ranks versions."""
    table = orders_table(spark, f"{tmp_table_dir}/orders")
    for i in range(3):
        table.write(spark.createDataFrame([(i, 1, "5", date(2024, 1, 1)), (9, 2, str(i), date(2024, 1, 1))], ORDERS))
    changed = table.log(after=table.commits()[0]).select("order_id").distinct()
    plan = table.snapshot(as_of=table.commits()[1], of=changed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [") < plan.index("Join LeftSemi")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_amounts_fail_in_every_mode(spark, ansi):
    df = spark.createDataFrame([(1, "1.5", "x"), (1, "twelve", "x")], "customer_id long, order_value string, order_date string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="twelve"):
            metrics.order_metrics(df).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_stream_join_restarts_and_replays(spark, tmp_table_dir):
    table = orders_table(spark, f"{tmp_table_dir}/orders").with_spec()
    rows = lambda *x: spark.createDataFrame([(i, c, n, v, date(2024, 1, 1)) for i, c, n, v in x], "order_id long, customer_id long, name string, order_value string, order_date date")
    customers = spark.createDataFrame([(1, "ann", "x", "a@x"), (2, "bob", "y", "b@y"), (None, "nil", "z", "z")], "customer_id long, name string, city string, email string")
    sink = KeyedSink(spark, f"{tmp_table_dir}/items", "customer_id", "order_id")

    def run():
        join_stream(table, customers, sink, f"{tmp_table_dir}/progress", max_files_per_trigger=1).awaitTermination()
        return sorted((r.customer_id, r.order_id, r.order_value, r.customer_name) for r in sink.items().collect())

    table.write(rows((10, 1, "p", "1"), (11, 2, "p", "2"), (12, 7, "p", "3"), (13, None, "p", "4")))
    table.write(rows((10, 1, "p", "5")))
    assert run() == [(1, 10, "5", "ann"), (2, 11, "2", "bob")]
    commits = CommitLogTable.open(spark, sink.path).commits()
    assert run() == [(1, 10, "5", "ann"), (2, 11, "2", "bob")]
    assert CommitLogTable.open(spark, sink.path).commits() == commits == table.refresh().commits()
    table.delete(rows((10, 1, "p", "5")))
    table.write(rows((11, 2, "p", "9")))
    assert run() == [(1, 10, "5", "ann"), (2, 11, "9", "bob")]
    # progress lost after delivery: everything is replayed and nothing is added
    batches = CommitLogTable.open(spark, sink.path).batches()
    done = f"{tmp_table_dir}/progress/commits"
    newest = max(int(f) for f in os.listdir(done) if f.isdigit())
    for f in (f"{newest}", f".{newest}.crc"):
        if os.path.exists(f"{done}/{f}"):
            os.remove(f"{done}/{f}")
    assert run() == [(1, 10, "5", "ann"), (2, 11, "9", "bob")]
    assert CommitLogTable.open(spark, sink.path).batches() == batches


def test_stream_joins_inside_the_streaming_plan(spark, tmp_table_dir):
    from tidemark.streaming.incremental import change_stream
    from tidemark.streaming.join import _items_of

    table = orders_table(spark, f"{tmp_table_dir}/orders")
    table.write(spark.createDataFrame([(1, 1, "n", "5", date(2024, 1, 1))], "order_id long, customer_id long, name string, order_value string, order_date date"))
    customers = spark.createDataFrame([(1, "ann", "x", "a@x")], "customer_id long, name string, city string, email string")
    assert _items_of(customers, change_stream(table)).isStreaming
