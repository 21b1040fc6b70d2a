"""Property tests on the keyed operators and the commit log."""

from __future__ import annotations

import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import keyed
from tidemark.plans.commitlog import CommitLogTable, TableSpec

SCHEMA = "k int, pre int, v int"
rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 99)), min_size=0, max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(base=rows_st, inc=rows_st)
def test_upsert_is_idempotent(spark, base, inc):
    b = keyed.precombine(spark.createDataFrame(base, SCHEMA), ["k"], "pre", ["v"])
    i = spark.createDataFrame(inc, SCHEMA)
    once = keyed.upsert(b, i, ["k"], "pre", ["v"])
    twice = keyed.upsert(once, i, ["k"], "pre", ["v"])
    assert as_set(once) == as_set(twice)


unique_rows_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 99)), max_size=12, unique_by=lambda r: r[:2]
)


@SETTINGS
@given(rows=unique_rows_st, cut=st.integers(0, 12))
def test_event_time_upsert_is_order_independent(spark, rows, cut):
    # with distinct (key, pre-combine) the greatest version wins whatever the
    # arrival order; ties go to the incoming batch by design
    a, b = rows[:cut], rows[cut:]
    empty = spark.createDataFrame([], SCHEMA)
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    ab = keyed.upsert(keyed.upsert(empty, da, ["k"], "pre", ["v"], "event_time"), db, ["k"], "pre", ["v"], "event_time")
    ba = keyed.upsert(keyed.upsert(empty, db, ["k"], "pre", ["v"], "event_time"), da, ["k"], "pre", ["v"], "event_time")
    assert as_set(ab) == as_set(ba)


@SETTINGS
@given(batches=st.lists(rows_st, min_size=1, max_size=3))
def test_replayed_increments_reproduce_snapshot(spark, batches):
    spec = TableSpec(name="p", keys=("k",), precombine="pre", tie_breakers=("v",), table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, tempfile.mkdtemp(prefix="tidemark-prop-"), spec)
    replica = keyed.precombine(spark.createDataFrame([], SCHEMA), ["k"], "pre", ["v"])
    begin = None
    for rows in batches:
        commit = table.write(spark.createDataFrame(rows, SCHEMA))
        if commit is None:
            continue
        inc = table.incremental(begin, commit, with_meta=False)
        snap = table.snapshot()
        assert set(as_set(inc)) <= set(as_set(snap))  # latest_state ⊆ snapshot
        replica = keyed.upsert(replica, inc, ["k"], "pre", ["v"])
        begin = commit
    assert as_set(replica) == as_set(table.snapshot())


part_rows_st = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from(["A", "B"]), st.integers(0, 5), st.integers(0, 99)),
    min_size=1, max_size=12,
)


@SETTINGS
@given(rows=part_rows_st, scope=st.sampled_from(["partition", "table"]))
def test_single_upsert_fast_path_equals_precombine(spark, rows, scope):
    schema = "k int, p string, pre int, v int"
    spec = TableSpec(name="f", keys=("k",), precombine="pre", tie_breakers=("v",), partition_by=("p",),
                     key_scope=scope, table_type="MERGE_ON_READ")
    table = CommitLogTable.create(spark, tempfile.mkdtemp(prefix="tidemark-fast-"), spec)
    df = spark.createDataFrame(rows, schema)
    table.write(df)
    keys = ["p", "k"] if scope == "partition" else ["k"]
    want = keyed.precombine(df, keys, "pre", ["v"]).select("k", "p", "pre", "v")
    assert as_set(table.snapshot().select("k", "p", "pre", "v")) == as_set(want)
