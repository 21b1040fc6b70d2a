"""Pure keyed operators on hand-made frames (FIXTURES.md §4)."""

from __future__ import annotations

import pytest

from tidemark.functions.flags import parse_flag
from tidemark.operators import keyed

SCHEMA = "k string, pre long, v string"


def rows(df, cols=None):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_precombine_keeps_greatest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], SCHEMA)
    assert rows(keyed.precombine(df, ["k"], "pre", ["v"])) == [("a", 3, "y"), ("b", 2, "z")]


def test_precombine_tie_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], SCHEMA)
    # default tie-breakers: every remaining orderable column, descending
    assert rows(keyed.precombine(df, ["k"], "pre")) == [("a", 1, "y")]
    again = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x")], SCHEMA)
    assert rows(keyed.precombine(again, ["k"], "pre")) == [("a", 1, "y")]


def test_null_precombine_ranks_last(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 0, "y")], SCHEMA)
    assert rows(keyed.precombine(df, ["k"], "pre", ["v"])) == [("a", 0, "y")]


def test_string_precombine_compares_as_text(spark):
    # decision D9: '9' > '10' as strings; cast first for numeric order
    df = spark.createDataFrame([("a", "9"), ("a", "10")], "k string, pre string")
    assert rows(keyed.precombine(df, ["k"], "pre", [])) == [("a", "9")]
    cast = df.selectExpr("k", "CAST(pre AS INT) AS pre")
    assert rows(keyed.precombine(cast, ["k"], "pre", [])) == [("a", 10)]


def test_upsert_modes_differ_on_late_update(spark):
    base = spark.createDataFrame([("a", 5, "stored"), ("b", 1, "stored")], SCHEMA)
    late = spark.createDataFrame([("a", 3, "late"), ("c", 1, "new")], SCHEMA)
    wins = keyed.upsert(base, late, ["k"], "pre", ["v"], mode="incoming_wins")
    assert rows(wins) == [("a", 3, "late"), ("b", 1, "stored"), ("c", 1, "new")]
    event = keyed.upsert(base, late, ["k"], "pre", ["v"], mode="event_time")
    assert rows(event) == [("a", 5, "stored"), ("b", 1, "stored"), ("c", 1, "new")]


def test_event_time_tie_goes_to_incoming(spark):
    base = spark.createDataFrame([("a", 5, "stored")], SCHEMA)
    same = spark.createDataFrame([("a", 5, "incoming")], SCHEMA)
    assert rows(keyed.upsert(base, same, ["k"], "pre", [], mode="event_time")) == [("a", 5, "incoming")]


def test_null_keys_group_together_in_pure_ops(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y")], SCHEMA)
    assert rows(keyed.precombine(df, ["k"], "pre", ["v"])) == [(None, 2, "y")]


def test_put_if_absent_and_delete(spark):
    have = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    new = spark.createDataFrame([("a", 2, "new"), ("b", 2, "new")], SCHEMA)
    assert rows(keyed.put_if_absent(have, new, ["k"])) == [("a", 1, "old"), ("b", 2, "new")]
    assert rows(keyed.delete_keys(new, have, ["k"])) == [("b", 2, "new")]


def test_retain_latest_versions(spark):
    df = spark.createDataFrame([("a", i, str(i)) for i in range(5)], SCHEMA)
    out = keyed.retain_latest_versions(df, ["k"], ["pre"], 3)
    assert rows(out, ["pre", "version_rank"]) == [(2, 3), (3, 2), (4, 1)]
    with pytest.raises(ValueError):
        keyed.retain_latest_versions(df, ["k"], ["pre"], 0)


def test_scoped_keys():
    assert keyed.scoped_keys(["id"], ["state"], "partition") == ["state", "id"]
    assert keyed.scoped_keys(["id"], ["state"], "table") == ["id"]
    with pytest.raises(ValueError):
        keyed.scoped_keys(["id"], [], "nowhere")


def test_parse_flag():
    assert all(parse_flag(v) for v in (True, "True", "true", 1))
    assert not any(parse_flag(v) for v in (False, "False", "yes", "1", None, 0))


def test_empty_input_gives_empty_output(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert keyed.precombine(empty, ["k"], "pre", ["v"]).isEmpty()


def test_join_drops_orphans_and_null_keys(spark):
    from tidemark.operators.joins import customer_orders

    customers = spark.createDataFrame(
        [(1, "ann", "NY", "ny-city", "a@x"), (2, "bob", "CA", "ca-city", "b@x"), (None, "nul", "TX", "tx", "n@x")],
        "customer_id int, name string, state string, city string, email string",
    )
    orders = spark.createDataFrame(
        [(10, 1, "LOW", "100", "2024-01-01"), (11, 99, "HIGH", "5", "2024-01-02"), (12, None, "LOW", "7", "2024-01-03")],
        "order_id int, customer_id int, name string, order_value string, order_date string",
    )
    got = customer_orders(customers, orders).collect()
    # orphan order 11, customer 2 without orders and both NULL keys produce nothing
    assert [tuple(r) for r in got] == [(1, 10, "ny-city", "ann", "a@x", "LOW", "100", "2024-01-01")]


def test_job_args():
    from tidemark.session import job_args

    assert job_args(["--JOB_NAME", "etl", "--x", "1"], ["JOB_NAME"]) == {"JOB_NAME": "etl", "x": "1"}
    with pytest.raises(ValueError):
        job_args(["--x", "1"], ["JOB_NAME"])


def test_metrics_sum_text_amounts_and_refuse_what_is_none(spark):
    from tidemark.operators.metrics import order_metrics

    schema = "customer_id int, order_value string, order_date string"
    joined = spark.createDataFrame(
        [(1, "10.50", "2024-01-01"), (1, "123456789012345678", "2024-01-03"), (1, "1.005", "2024-01-03"), (2, "7", "2024-01-02")], schema
    )
    got = {r["customer_id"]: (r["n_orders"], str(r["total_value"])) for r in order_metrics(joined, total_type="decimal(38,3)").collect()}
    assert got == {1: (3, "123456789012345689.505"), 2: (1, "7.000")}
    bad = joined.unionByName(spark.createDataFrame([(1, "oops", "2024-01-03")], schema))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        order_metrics(bad).collect()
