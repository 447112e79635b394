"""For each query the SQL that gives the same rows from the same tables."""

from __future__ import annotations

ALL_ORDERS = "SELECT * FROM orders"
ALL_LINEITEM = "SELECT * FROM lineitem"
NEW_ORDERS = "SELECT * FROM orders WHERE o_orderkey >= 7500"
ORDERS_OF_DAY = "SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1998-06-15 00:00:00'"
DATED_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders
"""
TEXT_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders
"""
CONFORMED_ORDERS = """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice,
           o_orderpriority
    FROM orders
"""
MOVED_ORDERS = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 2 = 0 THEN 'moved' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
"""
COUNTS = """
    SELECT 'orders' AS table_name, COUNT(*) AS "rows" FROM orders
    UNION ALL SELECT 'nation', COUNT(*) FROM nation
"""
# A run without rows keeps its last value; at sf0.001 there are none.
HIGHEST_KEY = """
    SELECT COALESCE(MAX(o_orderkey), 7500) AS last_value FROM orders WHERE o_orderkey >= 7500
"""

ORACLE: dict[str, str] = {
    "ingest_completely": ALL_ORDERS,
    "ingest_incremental": NEW_ORDERS,
    "ingest_incremental_strict": "SELECT * FROM orders WHERE o_orderkey > 7500",
    "ingest_incremental_time": (
        "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-25 12:00:00'"
    ),
    "ingest_incremental_text_files": (
        f"SELECT * FROM ({TEXT_ORDERS}) AS t WHERE o_orderdate >= '1998-06-15'"
    ),
    "ingest_daily": ORDERS_OF_DAY,
    "ingest_daily_date": (
        f"SELECT * FROM ({DATED_ORDERS}) AS t WHERE o_orderdate = DATE '1998-06-15'"
    ),
    "ingest_daily_range": (
        "SELECT * FROM events"
        " WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"
    ),
    "ingest_daily_text_files": (
        f"SELECT * FROM ({TEXT_ORDERS}) AS t WHERE o_orderdate = '1998-06-15'"
    ),
    "ingest_completely_files": ALL_LINEITEM,
    "ingest_incremental_files": "SELECT * FROM lineitem WHERE l_orderkey >= 7500",
    "ingest_incremental_strict_files": "SELECT * FROM lineitem WHERE l_orderkey > 7500",
    "ingest_daily_files": (
        "SELECT * FROM lineitem WHERE l_shipdate = TIMESTAMP '1998-06-15 00:00:00'"
    ),
    "ingest_partitioned_numeric": ALL_ORDERS,
    "ingest_partitioned_time": ALL_ORDERS,
    "ingest_partitioned_date": DATED_ORDERS,
    "ingest_partitioned_narrow": ALL_ORDERS,
    "ingest_partitioned_daily": ORDERS_OF_DAY,
    "ingest_partitioned_incremental": NEW_ORDERS,
    "ingest_partitioned_balanced": NEW_ORDERS,
    "ingest_partitioned_hot": ALL_LINEITEM,
    "ingest_partitioned_text": "SELECT * FROM customer",
    "ingest_partitioned_names": "SELECT * FROM customer",
    "ingest_partitioned_skewed": "SELECT o_orderkey, o_custkey FROM orders",
    "conform_schema": CONFORMED_ORDERS,
    "conform_schema_lenient": (
        "SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7, 2)) AS o_totalprice FROM orders"
    ),
    # Spark cuts off decimals when it casts to whole numbers.
    "conform_types": """
        SELECT CAST(l_shipdate AS DATE) AS l_shipdate,
               CAST(l_orderkey AS INTEGER) AS l_orderkey,
               CAST(l_partkey AS VARCHAR) AS l_partkey,
               l_suppkey,
               CAST(l_linenumber AS BOOLEAN) AS l_linenumber,
               CAST(TRUNC(l_quantity) AS BIGINT) AS l_quantity,
               CAST(l_extendedprice AS DECIMAL(15, 2)) AS l_extendedprice,
               CAST(l_discount AS FLOAT) AS l_discount,
               l_tax,
               l_returnflag
        FROM lineitem
    """,
    "day_functions": """
        SELECT event_id,
               CAST(ts AS DATE) - 1 AS previous_day,
               strftime(ts, '%Y-%m-%d') AS day_text,
               CAST(ts AS DATE) AS parsed_day
        FROM events
    """,
    "sink_parquet": ALL_LINEITEM,
    "sink_orc": ALL_LINEITEM,
    "sink_avro": ALL_LINEITEM,
    "sink_json": ALL_ORDERS,
    "sink_csv": ALL_ORDERS,
    "sink_overwrite_twice": ALL_ORDERS,
    "sink_append_twice": f"{ALL_ORDERS} UNION ALL {ALL_ORDERS}",
    "sink_partitioned_one": ALL_ORDERS,
    "sink_partitioned_many": ALL_ORDERS,
    "sink_partitioned_rebalanced": ALL_LINEITEM,
    "sink_replace_day": (
        "SELECT * FROM orders WHERE o_orderdate"
        " IN (TIMESTAMP '1998-06-14 00:00:00', TIMESTAMP '1998-06-15 00:00:00')"
    ),
    "replace_day_moved_keys": f"""
        SELECT * FROM ({MOVED_ORDERS}) AS t
        WHERE o_orderdate IN (TIMESTAMP '1998-06-14 00:00:00', TIMESTAMP '1998-06-15 00:00:00')
    """,
    "replace_day_emptied": (
        f"SELECT * FROM ({MOVED_ORDERS}) AS t WHERE o_orderdate = TIMESTAMP '1998-06-14 00:00:00'"
    ),
    "source_evolved_files": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "source_partitioned_files": (
        "SELECT o_orderkey, lpad(CAST(o_custkey % 12 AS VARCHAR), 3, '0') AS k FROM orders"
    ),
    "daily_whole_day_partitioned": (
        "SELECT * FROM events"
        " WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"
    ),
    "incremental_text_continues": """
        SELECT o_orderkey,
               concat(' ', chr(39), lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), chr(39), ' ') AS mark
        FROM orders
    """,
    "incremental_instant_continues": """
        SELECT o_orderkey,
               strftime(TIMESTAMP '2024-06-01 12:00:00' + to_seconds(o_orderkey), '%Y-%m-%d %H:%M:%S')
                   AS mark
        FROM orders
    """,
    # NaN is above every mark, so the second run takes it again.
    "incremental_double_continues": """
        SELECT o_orderkey, CASE WHEN o_orderkey = 699 THEN 'NaN' ELSE o_orderkey || '.0' END AS mark
        FROM orders
        UNION ALL SELECT o_orderkey, 'NaN' FROM orders WHERE o_orderkey = 699
    """,
    "job_targets_files": "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey",
    "job_daily": ORDERS_OF_DAY,
    "job_daily_files": ORDERS_OF_DAY,
    "job_by_mode": COUNTS,
    "job_by_mode_files": COUNTS,
    "job_configured_files": COUNTS,
    "job_conformed_files": f"{CONFORMED_ORDERS} WHERE o_custkey >= 100",
    "next_last_value": HIGHEST_KEY,
    "job_next_last_value": HIGHEST_KEY,
}
