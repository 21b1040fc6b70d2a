"""


The Spark side is implemented by the ``tidemark`` package
(``tidemark/queries.py``); the SQL below is an independent DuckDB statement
of the same semantics over the whole tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import queries as _q  # noqa: E402

try:  # the subpackage is optional: everything else works without it
    import corpus_pipeline as _pipeline  # noqa: E402
    from tidemark.llm.oracles import ORACLES as _LLM_ORACLES  # noqa: E402
    from tidemark.llm.queries import QUERIES as _LLM_QUERIES  # noqa: E402
except ImportError:
    _pipeline, _LLM_ORACLES, _LLM_QUERIES = None, {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return _q.customer_orders_join(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = dict(_LLM_QUERIES)
    if _pipeline is not None:
        llm["pipeline"] = _pipeline.run
    return {**_q.QUERIES, **llm}


# --------------------------------------------------------------- oracle SQL
_EV = "SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y%m%d') AS commit_time FROM events"
_B_SRC = f"SELECT * FROM ({_EV}) WHERE event_type IS NULL OR event_type NOT IN ('error', 'signup')"
_I_SRC = f"SELECT * FROM ({_EV}) WHERE event_type IN ('error', 'signup')"
_LATEST_USER = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
_BI = (
    f"WITH b_src AS ({_B_SRC}), i_src AS ({_I_SRC}), "
    f"b AS (SELECT * FROM b_src {_LATEST_USER}), "
    f"i AS (SELECT * FROM i_src {_LATEST_USER}) "
)
_LOG = (
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, "
    "CAST(2024010100 + o_orderkey % 10 AS VARCHAR) AS commit_time FROM orders"
)
_LOG_ORDER = "ORDER BY commit_time DESC, o_orderdate DESC, o_orderkey DESC"
_OC = "strftime(o_orderdate, '%Y%m%d')"
_SNAPSHOT = f"SELECT * FROM ({_LOG}) QUALIFY row_number() OVER (PARTITION BY o_custkey {_LOG_ORDER}) = 1"

_ORACLES: dict[str, str] = {
    "customer_orders_join": (
        "SELECT c.c_custkey AS customer_id, o.o_orderkey AS order_id, n.n_name AS city, "
        "c.c_name AS customer_name, concat('c', CAST(c.c_custkey AS VARCHAR), '@example.com') AS email, "
        "o.o_orderpriority AS order_name, o.o_totalprice AS order_value, o.o_orderdate AS order_date "
        "FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey "
        "JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "precombine_latest": f"SELECT * FROM ({_EV}) {_LATEST_USER}",
    "upsert_incoming_wins": (
        _BI + "SELECT * FROM i UNION ALL "
        "SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_id = b.user_id)"
    ),
    "upsert_event_time": (
        _BI + "SELECT event_id, ts, user_id, event_type, value, commit_time FROM "
        "(SELECT *, 0 AS src FROM b UNION ALL SELECT *, 1 AS src FROM i) "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, src DESC, event_id DESC) = 1"
    ),
    "upsert_partition_scope": (
        f"SELECT * FROM ({_EV}) QUALIFY row_number() OVER "
        "(PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1"
    ),
    "upsert_table_scope": (
        _BI + "SELECT * FROM i UNION ALL "
        "SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_id = b.user_id)"
    ),
    "put_if_absent": (
        _BI + "SELECT * FROM b UNION ALL "
        "SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = i.user_id)"
    ),
    "keyed_delete": (
        _BI + "SELECT * FROM b WHERE NOT EXISTS "
        "(SELECT 1 FROM i_src WHERE i_src.user_id = b.user_id AND i_src.value > 200)"
    ),
    "event_time_delete_reinsert": (
        _BI + ", d AS (SELECT DISTINCT user_id FROM i_src WHERE value > 200) "
        "SELECT event_id, ts, user_id, event_type, value, commit_time FROM "
        "(SELECT *, 0 AS src FROM b WHERE user_id NOT IN (SELECT user_id FROM d) "
        "UNION ALL SELECT *, 1 AS src FROM i) "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, src DESC, event_id DESC) = 1"
    ),
    "snapshot_read": _SNAPSHOT,
    "incremental_latest_state": (
        f"SELECT * FROM ({_LOG}) WHERE commit_time > '2024010107' "
        f"QUALIFY row_number() OVER (PARTITION BY o_custkey {_LOG_ORDER}) = 1"
    ),
    "incremental_changes": f"SELECT * FROM ({_LOG}) WHERE commit_time > '2024010107'",
    "incremental_after_compaction": f"SELECT * FROM ({_SNAPSHOT}) WHERE commit_time > '2024010103'",
    "incremental_event_time": (
        f"SELECT * FROM (SELECT * FROM ({_LOG}) QUALIFY row_number() OVER "
        "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, commit_time DESC, o_orderkey DESC) = 1) "
        "WHERE commit_time > '2024010107'"
    ),
    "retain_latest_versions": (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey {_LOG_ORDER}) AS INTEGER) AS version_rank "
        f"FROM ({_LOG}) QUALIFY version_rank <= 3"
    ),
    "compacted_snapshot": (
        f"WITH snap AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM ({_SNAPSHOT})), "
        "late AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders "
        "WHERE o_orderstatus = 'O' QUALIFY row_number() OVER "
        "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) "
        "SELECT * FROM late UNION ALL "
        "SELECT * FROM snap WHERE NOT EXISTS (SELECT 1 FROM late WHERE late.o_custkey = snap.o_custkey)"
    ),
    "commit_timeline": f"SELECT DISTINCT {_OC} AS commit_time FROM orders ORDER BY commit_time LIMIT 50",
    "begin_instant": f"SELECT CAST(min({_OC}) AS BIGINT) - 1 AS begin_time FROM orders",
    "checkpoint_advance": (
        f"SELECT 'orders' AS table_name, max({_OC}) AS last_processed_commit "
        f"FROM orders WHERE {_OC} > '20001231'"
    ),
    "checkpoint_advance_capped": (
        "SELECT 'orders' AS table_name, max(oc) AS last_processed_commit FROM "
        f"(SELECT DISTINCT {_OC} AS oc FROM orders WHERE {_OC} > '20001231' ORDER BY oc LIMIT 50)"
    ),
    "incremental_join_full": (
        "SELECT c.c_custkey AS customer_id, o.o_orderkey AS order_id, c.c_name AS customer_name, "
        "o.o_totalprice AS order_value FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey "
        f"WHERE {_OC.replace('o_orderdate', 'o.o_orderdate')} > '20001231'"
    ),
    "kv_items": (
        "SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS order_id, "
        "CAST(o_totalprice AS VARCHAR) AS order_value, CAST(o_orderdate AS VARCHAR) AS order_date FROM orders"
    ),
    "kv_put_last_write_wins": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate "
        "FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1"
    ),
    "schemaless_items": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "sql_transform": (
        "SELECT o_orderkey, o_custkey, o_totalprice, upper(o_orderstatus) AS status "
        "FROM orders WHERE o_totalprice > 100000"
    ),
    "partitioned_write_counts": (
        "SELECT n.n_name AS state, count(*) AS n_rows FROM customer c "
        "JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"
    ),
    "gen_customers": (
        "SELECT c_custkey AS customer_id, concat('name_', CAST(c_custkey AS VARCHAR)) AS name, "
        "concat('state_', CAST((c_custkey * 37 + 11) % 50 AS VARCHAR)) AS state, "
        "concat('city_', CAST((c_custkey * 53 + 7) % 200 AS VARCHAR)) AS city, "
        "concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email, "
        "strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey), '%Y-%m-%dT%H:%M:%S') AS created_at, "
        "concat(CAST((c_custkey * 7 + 1) % 9999 AS VARCHAR), ' Main St, ', 'city_', "
        "CAST((c_custkey * 53 + 7) % 200 AS VARCHAR)) AS address FROM customer"
    ),
    "gen_orders": (
        "SELECT o_orderkey AS order_id, substring(concat('order ', CAST(o_orderkey AS VARCHAR)), 1, 20) AS name, "
        "CAST(10 + (o_orderkey * 104729 + 7) % 991 AS VARCHAR) AS order_value, "
        "['LOW', 'MEDIUM', 'HIGH'][CAST((o_orderkey * 31 + 5) % 3 AS INTEGER) + 1] AS priority, "
        "strftime(DATE '2024-01-30' - CAST((o_orderkey * 17 + 3) % 31 AS INTEGER), '%Y-%m-%d') AS order_date, "
        "(o_orderkey * 7919 + 13) % (SELECT count(*) FROM customer) AS customer_id FROM orders"
    ),
    "customer_order_metrics": (
        "SELECT c.c_custkey AS customer_id, count(*) AS n_orders, "
        "CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_value, "
        "min(o.o_orderdate) AS first_order, max(o.o_orderdate) AS last_order "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey"
    ),
    "load_join_items": (
        "SELECT c.c_custkey AS customer_id, o.o_orderkey AS order_id, n.n_name AS city, "
        "c.c_name AS customer_name, concat('c', CAST(c.c_custkey AS VARCHAR), '@example.com') AS email, "
        "o.o_orderpriority AS order_name, CAST(o.o_totalprice AS VARCHAR) AS order_value, "
        "CAST(o.o_orderdate AS VARCHAR) AS order_date "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "JOIN orders o ON c.c_custkey = o.o_custkey"
    ),
    "load_join_items_incremental": (
        "SELECT c.c_custkey AS customer_id, o.o_orderkey AS order_id, n.n_name AS city, "
        "c.c_name AS customer_name, concat('c', CAST(c.c_custkey AS VARCHAR), '@example.com') AS email, "
        "o.o_orderpriority AS order_name, CAST(o.o_totalprice AS VARCHAR) AS order_value, "
        "CAST(o.o_orderdate AS VARCHAR) AS order_date "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'O'"
    ),
    "customer_metrics_items": (
        "SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, CAST(count(*) AS VARCHAR) AS n_orders, "
        "CAST(CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS VARCHAR) AS total_value, "
        "CAST(min(o.o_orderdate) AS VARCHAR) AS first_order, CAST(max(o.o_orderdate) AS VARCHAR) AS last_order "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey"
    ),
    "clustered_rewrite": "SELECT * FROM events",
    "stream_upsert": _SNAPSHOT,
    "object_inventory": f"SELECT DISTINCT commit_time, true AS has_files FROM ({_LOG})",
    "retention_job": (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey {_LOG_ORDER}) AS INTEGER) AS version_rank "
        f"FROM ({_LOG}) QUALIFY version_rank <= 3"
    ),
    "capped_catch_up_after_compaction": (
        f"SELECT * FROM ({_LOG}) WHERE commit_time > '2024010103' AND commit_time <= '2024010105' "
        f"QUALIFY row_number() OVER (PARTITION BY o_custkey {_LOG_ORDER}) = 1"
    ),
    "catalog_after_second_upsert": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, "
        "CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders"
    ),
    "checkpoint_reset": "SELECT o_orderkey, o_orderdate FROM orders",
    "empty_increment": (
        f"SELECT count(*) AS n_rows, false AS has_checkpoint FROM orders WHERE {_OC} > (SELECT max({_OC}) FROM orders)"
    ),
    "empty_write_guard": f"SELECT *, true AS unchanged FROM ({_SNAPSHOT})",
    "metrics_after_changes": (
        "SELECT o.o_custkey AS customer_id, count(*) AS n_orders, "
        "CAST(sum(CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS DECIMAL(18, 2))) AS DOUBLE) AS total_value, "
        "min(CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END) AS first_order, "
        "max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END) AS last_order "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN orders o ON c.c_custkey = o.o_custkey "
        "WHERE o_orderstatus IS DISTINCT FROM 'P' GROUP BY o.o_custkey"
    ),
    "gen_orders_for_customers": (
        "WITH c AS (SELECT o_custkey AS id, row_number() OVER (ORDER BY o_custkey) - 1 AS number FROM "
        "(SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)) "
        "SELECT o_orderkey AS order_id, substring(concat('order ', CAST(o_orderkey AS VARCHAR)), 1, 20) AS name, "
        "CAST(10 + (o_orderkey * 104729 + 7) % 991 AS VARCHAR) AS order_value, "
        "['LOW', 'MEDIUM', 'HIGH'][CAST((o_orderkey * 31 + 5) % 3 AS INTEGER) + 1] AS priority, "
        "strftime(DATE '2024-01-30' - CAST((o_orderkey * 17 + 3) % 31 AS INTEGER), '%Y-%m-%d') AS order_date, "
        "c.id AS customer_id FROM orders JOIN c ON c.number = (o_orderkey * 7919 + 13) % (SELECT count(*) FROM c)"
    ),
    "small_file_rewrite": "SELECT * FROM orders",
    "clustered_layout": (
        "SELECT event_type, count(*) AS n_rows, CAST(0 AS BIGINT) AS overlapping FROM events GROUP BY event_type"
    ),
    "column_stats": (
        "SELECT 'o_orderkey' AS column_name, CAST(min(o_orderkey) AS VARCHAR) AS min, CAST(max(o_orderkey) AS VARCHAR) AS max, "
        "count(*) - count(o_orderkey) AS num_nulls, true AS distinct_near FROM orders "
        "UNION ALL SELECT 'o_custkey', CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR), count(*) - count(o_custkey), true FROM orders "
        "UNION ALL SELECT 'o_orderstatus', NULL, NULL, count(*) - count(o_orderstatus), true FROM orders"
    ),
    "checkpoint_observed": (
        f"SELECT count(*) AS n_rows, max({_OC}) AS last_processed_commit FROM orders WHERE {_OC} > '20001231'"
    ),
    "partitioned_write_rows": (
        "SELECT c_custkey AS customer_id, c_name AS name, n_name AS state, n_name AS city, "
        "concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email FROM customer JOIN nation ON c_nationkey = n_nationkey"
    ),
    "sink_last_write_wins": (
        "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, CAST(l_partkey AS VARCHAR) AS l_partkey, "
        "CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice, CAST(l_quantity AS VARCHAR) AS l_quantity "
        "FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY lineitem.l_shipdate DESC, lineitem.l_partkey DESC, lineitem.l_suppkey DESC, lineitem.l_extendedprice DESC, lineitem.l_quantity DESC) = 1"
    ),
    "gold_upsert": (
        "SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 100000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, 'gz' AS codec FROM orders"
    ),
    "local_rows_join": "SELECT c_custkey, c_name, n_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "item_writer_put": (
        "SELECT o_custkey AS customer_id, o_orderkey AS order_id, "
        "CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS VARCHAR) AS order_value, "
        "CAST(o_orderdate AS VARCHAR) AS order_date FROM orders"
    ),
    "item_attribute_subset": (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer"
    ),
}


_ORACLES["item_segments_join"] = _ORACLES["customer_orders_join"]
_ORACLES["stream_join_items"] = _ORACLES["load_join_items_incremental"]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query that SQL can express."""
    llm = dict(_LLM_ORACLES)
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        llm["pipeline"] = _pipeline.ORACLE_SQL
    return {**_ORACLES, **llm}
