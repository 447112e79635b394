"""One query per operator, over the given tables.

Those built with ``from_database``, ``dated_orders`` or ``derby.with_tables`` read an embedded
database, which is filled from the given tables first; all others read the Parquet files.
Queries that write return the target as read back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import (
    Endpoint,
    TableJob,
    avro_to_struct,
    conform,
    daily_filter,
    incremental_filter,
    ingest_table,
    read_table,
    read_target,
    run,
    run_from_files,
    target_path,
)
from sluice.functions.days import format_day, parse_day, previous_day_of
from sluice.functions.shared import fresh_folder
from sluice.plans.specs import COMPLETELY, DAILY, INCREMENTALLY
from sluice_checks import derby

Query = Callable[[SparkSession, str], DataFrame]

ORDER_DAY_AFTER = "1998-06-16"
EVENT_DAY_AFTER = "2024-01-11"
# Half of the keys at sf0.01.
LAST_KEY = "7500"

ORDERS_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "orders",
        "fields": [
            {"name": "o_orderkey", "type": "int"},
            {"name": "o_orderdate", "type": {"type": "int", "logicalType": "date"}},
            {
                "name": "o_totalprice",
                "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2},
            },
            {"name": "o_orderpriority", "type": ["null", "string"]},
        ],
    }
)
NARROW_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "orders",
        "fields": [
            {"name": "o_orderkey", "type": "long"},
            {
                "name": "o_totalprice",
                "type": {"type": "bytes", "logicalType": "decimal", "precision": 7, "scale": 2},
            },
        ],
    }
)
LINEITEM_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "lineitem",
        "fields": [
            {"name": "l_shipdate", "type": {"type": "int", "logicalType": "date"}},
            {"name": "l_orderkey", "type": "int"},
            {"name": "l_partkey", "type": ["null", "string"]},
            {"name": "l_suppkey", "type": ["int", "long"]},
            {"name": "l_linenumber", "type": "boolean"},
            {"name": "l_quantity", "type": "long"},
            {
                "name": "l_extendedprice",
                "type": {"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2},
            },
            {"name": "l_discount", "type": "float"},
            {"name": "l_tax", "type": "double"},
            {
                "name": "l_returnflag",
                "type": {"type": "enum", "name": "flag", "symbols": ["A", "N", "R"]},
            },
        ],
    }
)


def exported(sf_dir: str) -> Endpoint:
    return Endpoint("exported", {"format": "parquet", "location": f"{sf_dir}/{{table}}.parquet"})


def job(table: str, mode: str = COMPLETELY, **options: str) -> TableJob:
    return TableJob(f"{table}_{mode}", {"tableName": table, "mode": mode, **options})


def new_sink(spark: SparkSession, format: str = "parquet", **options: str) -> Endpoint:
    return Endpoint("target", {"format": format, "location": fresh_folder(spark), **options})


def read_back(spark: SparkSession, sink: Endpoint, of: TableJob, like: DataFrame) -> DataFrame:
    """The target in the column order and types of ``like``; partition columns would otherwise
    come last, with types guessed from folder names."""
    return read_target(spark, target_path(sink, of), sink.require("format"), like.schema, of.partition_keys)


# Reading from a database


def from_database(table: str, mode: str, as_of: str | None = None, **options: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = derby.with_tables(spark, sf_dir, table)
        return read_table(spark, source, job(table, mode, **options), mode, as_of)

    return query


def from_files(table: str, mode: str, as_of: str | None = None, **options: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_table(spark, exported(sf_dir), job(table, mode, **options), mode, as_of)

    return query


def dated_orders(spark: SparkSession, sf_dir: str) -> tuple[Endpoint, str]:
    """Orders in the database with a DATE column."""
    source, table = derby.endpoint(spark, sf_dir), "dated_orders"
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    derby.fill(spark, source, table, orders)
    return source, table


def ingest_partitioned_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, table = dated_orders(spark, sf_dir)
    split = {
        "partitionColumn": "o_orderdate",
        "numPartitions": "4",
    }
    return read_table(spark, source, job(table, **split), COMPLETELY)


def ingest_partitioned_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by a value that grows exponentially with their place."""
    source, table = derby.endpoint(spark, sf_dir), "skewed_orders"
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    largest = orders.count() - 1
    skew = F.exp(F.col("o_orderkey") * (40.0 / max(largest, 1))).cast("bigint")
    derby.fill(spark, source, table, orders.select("o_orderkey", "o_custkey", skew.alias("skew")))
    split = {"partitionColumn": "skew", "numPartitions": "8", "balanceReads": "true"}
    return read_table(spark, source, job(table, **split), COMPLETELY).select("o_orderkey", "o_custkey")


def ingest_daily_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, table = dated_orders(spark, sf_dir)
    daily = job(table, DAILY, checkColumn="o_orderdate")
    return read_table(spark, source, daily, DAILY, ORDER_DAY_AFTER)


def text_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.withColumn("o_orderdate", format_day(F.col("o_orderdate")))


def ingest_daily_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_filter(text_days(spark, sf_dir), "o_orderdate", "1998-06-15")


def ingest_incremental_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_filter(text_days(spark, sf_dir), "o_orderdate", "'1998-06-15'")


# Conforming to a schema


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return conform(orders, avro_to_struct(spark, ORDERS_SCHEMA))


def conform_schema_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return conform(orders, avro_to_struct(spark, NARROW_SCHEMA), on_error="null")


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return conform(lineitem, avro_to_struct(spark, LINEITEM_SCHEMA))


def day_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, events = F.col("ts"), spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        previous_day_of(ts).alias("previous_day"),
        format_day(ts).alias("day_text"),
        parse_day(format_day(ts)).alias("parsed_day"),
    )


# Writing


def round_trip(
    table: str, format: str = "parquet", mode: str = COMPLETELY, times: int = 1, **options: str
) -> Query:
    """Write the table ``times`` times and read the target."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, sink, copy = exported(sf_dir), new_sink(spark, format), job(table, mode, **options)
        for _ in range(times):
            ingest_table(spark, copy, source, sink, mode)
        return read_back(spark, sink, copy, read_table(spark, source, copy, COMPLETELY))

    return query


def sink_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, one of them twice: the repeated day is replaced, the other one stays."""
    source, sink = exported(sf_dir), new_sink(spark)
    daily = job(
        "orders",
        DAILY,
        checkColumn="o_orderdate",
        partitionKeys="o_orderdate",
        replacePartitions="true",
    )
    for as_of in ("1998-06-15", ORDER_DAY_AFTER, ORDER_DAY_AFTER):
        ingest_table(spark, daily, source, sink, DAILY, as_of=as_of)
    return read_back(spark, sink, daily, read_table(spark, source, daily, COMPLETELY))


def moved_day(spark: SparkSession, sf_dir: str, second: str) -> DataFrame:
    """Two days copied twice with the order status below them; in between the rows change."""
    sink, source = new_sink(spark), new_sink(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    daily = job(
        "orders",
        DAILY,
        checkColumn="o_orderdate",
        partitionKeys="o_orderdate,o_orderstatus",
        replacePartitions="true",
    )
    status = F.when(F.col("o_orderkey") % 2 == 0, "moved").otherwise(F.col("o_orderstatus"))
    for rows in (orders, orders.withColumn("o_orderstatus", status).where(second)):
        rows.write.mode("overwrite").parquet(target_path(source, daily))
        for as_of in ("1998-06-15", ORDER_DAY_AFTER):
            ingest_table(spark, daily, source, sink, DAILY, as_of=as_of)
    return read_back(spark, sink, daily, orders)


def replace_day_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moved_day(spark, sf_dir, "true")


def replace_day_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moved_day(spark, sf_dir, "o_orderdate <> TIMESTAMP '1998-06-15 00:00:00'")


def source_evolved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset whose later files have a column more."""
    source, orders = new_sink(spark), spark.read.parquet(f"{sf_dir}/orders.parquet")
    copy, half = job("orders"), F.col("o_orderkey") % 2 == 0
    orders.where(half).drop("o_orderpriority").write.parquet(target_path(source, copy))
    orders.where(~half).write.mode("append").parquet(target_path(source, copy))
    return read_table(spark, source, copy, COMPLETELY).select(orders.columns)


def source_partitioned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset in folders whose names look like numbers but are not."""
    source, orders = new_sink(spark), spark.read.parquet(f"{sf_dir}/orders.parquet")
    copy, key = job("orders"), F.format_string("%03d", F.col("o_custkey") % 12)
    rows = orders.select("o_orderkey", key.alias("k"))
    rows.write.partitionBy("k").parquet(target_path(source, copy))
    return read_table(spark, source, copy, COMPLETELY)


def daily_whole_day_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink = exported(sf_dir), new_sink(spark)
    daily = job("events", DAILY, checkColumn="ts", wholeDay="true", partitionKeys="ts")
    ingest_table(spark, daily, source, sink, DAILY, as_of=EVENT_DAY_AFTER)
    return read_back(spark, sink, daily, read_table(spark, source, daily, COMPLETELY))


def continued(check: str, first: str, *zones: str) -> Query:
    """Two strict runs over orders that arrive in two halves: the target is the whole."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, sink = new_sink(spark), new_sink(spark)
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        orders = orders.select("o_orderkey", F.expr(check).alias("mark"))
        last, zone = first, spark.conf.get("spark.sql.session.timeZone")
        halves = (F.col("o_orderkey") < SPLIT_KEY, F.col("o_orderkey") >= SPLIT_KEY)
        for half, own_zone in zip(halves, zones):
            strict = {"checkColumn": "mark", "lastValue": last, "inclusive": "false"}
            copy = job("orders", INCREMENTALLY, **strict)
            orders.where(half).write.mode("append").parquet(target_path(source, copy))
            spark.conf.set("spark.sql.session.timeZone", own_zone)
            try:
                last = ingest_table(spark, copy, source, sink, INCREMENTALLY).last_value
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)
        rows = read_back(spark, sink, copy, orders)
        return rows.select("o_orderkey", rows["mark"].cast("string").alias("mark"))

    return query


SPLIT_KEY = 700
# Blanks and quotes around the text, in the order of the keys.
QUOTED = """concat(" '", format_string('%09d', o_orderkey), "' ")"""
MOMENT = "timestamp_seconds(o_orderkey + 1717243200)"
# The highest value of the first half is NaN.
MEASURE = f"if(o_orderkey = {SPLIT_KEY - 1}, double('NaN'), double(o_orderkey))"


# Whole runs


def write_file(spark: SparkSession, name: str, text: str) -> str:
    """Put a configuration file where all executors reach it; returns its folder."""
    folder = fresh_folder(spark)
    spark.range(1).select(F.lit(text)).write.text(f"{folder}/{name}")
    return folder


def daily_run(spark: SparkSession, source: Endpoint, like: DataFrame) -> DataFrame:
    sink, daily = new_sink(spark), job("orders", DAILY, checkColumn="o_orderdate")
    ingest_table(spark, daily, source, sink, DAILY, as_of=ORDER_DAY_AFTER)
    return read_back(spark, sink, daily, like)


def job_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return daily_run(spark, derby.with_tables(spark, sf_dir, "orders"), orders)


def job_daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_run(spark, exported(sf_dir), spark.read.parquet(f"{sf_dir}/orders.parquet"))


def complete_run(spark: SparkSession, source: Endpoint) -> DataFrame:
    """The job of another mode must not run: its table is not even there."""
    endpoints = {"source": source, "sink": new_sink(spark)}
    tables = [
        job("orders"),
        job("not_there", DAILY, checkColumn="ts"),
        job("nation"),
    ]
    result = run(spark, endpoints, tables, "source", "sink", COMPLETELY)
    return result.select("table_name", "rows")


def job_targets_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over several tables has written."""
    source, sink = exported(sf_dir), new_sink(spark, "orc")
    tables = [job("region"), job("nation")]
    run(spark, {"source": source, "sink": sink}, tables, "source", "sink", COMPLETELY)
    region, nation = (spark.read.orc(target_path(sink, table)) for table in tables)
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"])


def job_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_run(spark, derby.with_tables(spark, sf_dir, "orders", "nation"))


def job_by_mode_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_run(spark, exported(sf_dir))


def as_json(key: str, *specs: Endpoint | TableJob) -> str:
    def item(spec: Endpoint | TableJob) -> dict:
        options = [{"name": name, "value": value} for name, value in spec.options.items()]
        return {"name": spec.name, "options": options}

    return json.dumps({key: [item(spec) for spec in specs]})


def job_configured_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose endpoints and table jobs come from JSON files, two tables at a time."""
    endpoints = as_json("endpoints", exported(sf_dir), new_sink(spark, "orc"))
    tables = as_json("tables", job("orders"), job("nation"), job("x", DAILY, checkColumn="y"))
    result = run_from_files(
        spark,
        endpointsConfigPath=f"{write_file(spark, 'endpoints.json', endpoints)}/endpoints.json",
        tablesConfigPath=f"{write_file(spark, 'tables.json', tables)}/tables.json",
        sourceName="exported",
        sinkName="target",
        mode=COMPLETELY,
        tables_at_once=2,
    )
    return result.select("table_name", "rows")


def incremental_run(spark: SparkSession, source: Endpoint) -> DataFrame:
    endpoints = {"source": source, "sink": new_sink(spark)}
    tables = [job("orders", INCREMENTALLY, checkColumn="o_orderkey", lastValue=LAST_KEY)]
    result = run(spark, endpoints, tables, "source", "sink", INCREMENTALLY)
    return result.select(F.col("last_value").cast("bigint"))


def next_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_run(spark, exported(sf_dir))


def job_next_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_run(spark, derby.with_tables(spark, sf_dir, "orders"))


def job_conformed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run with filter, Avro schema and partitioned target."""
    folder = write_file(spark, "orders.avsc", ORDERS_SCHEMA)
    endpoints = {"source": exported(sf_dir), "sink": new_sink(spark, "avro")}
    copy = job(
        "orders",
        INCREMENTALLY,
        checkColumn="o_custkey",
        lastValue="100",
        schema="orders.avsc",
        partitionKeys="o_orderpriority",
        rebalance="true",
    )
    run(spark, endpoints, [copy], "source", "sink", INCREMENTALLY, schemas_path=folder)
    return read_back(spark, endpoints["sink"], copy, conform_schema(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "ingest_completely": from_database("orders", COMPLETELY, batchSize="2000"),
    "ingest_incremental": from_database(
        "orders", INCREMENTALLY, checkColumn="o_orderkey", lastValue=LAST_KEY
    ),
    "ingest_incremental_strict": from_database(
        "orders", INCREMENTALLY, checkColumn="o_orderkey", lastValue=LAST_KEY, inclusive="false"
    ),
    "ingest_incremental_time": from_files(
        "events", INCREMENTALLY, checkColumn="ts", lastValue="2024-01-25 12:00:00"
    ),
    "ingest_incremental_text_files": ingest_incremental_text_files,
    "ingest_daily": from_database(
        "orders", DAILY, as_of=ORDER_DAY_AFTER, checkColumn="o_orderdate"
    ),
    "ingest_daily_date": ingest_daily_date,
    "ingest_daily_range": from_files(
        "events", DAILY, as_of=EVENT_DAY_AFTER, checkColumn="ts", wholeDay="true"
    ),
    "ingest_daily_text_files": ingest_daily_text_files,
    "ingest_completely_files": from_files("lineitem", COMPLETELY),
    "ingest_incremental_files": from_files(
        "lineitem", INCREMENTALLY, checkColumn="l_orderkey", lastValue=LAST_KEY
    ),
    "ingest_incremental_strict_files": from_files(
        "lineitem", INCREMENTALLY, checkColumn="l_orderkey", lastValue=LAST_KEY, inclusive="false"
    ),
    "ingest_daily_files": from_files(
        "lineitem", DAILY, as_of=ORDER_DAY_AFTER, checkColumn="l_shipdate"
    ),
    "ingest_partitioned_numeric": from_database(
        "orders",
        COMPLETELY,
        partitionColumn="o_orderkey",
        numPartitions="4",
    ),
    "ingest_partitioned_time": from_database(
        "orders",
        COMPLETELY,
        partitionColumn="o_orderdate",
        lowerBound="1996-06-01",
        upperBound="1996-06-04",
        numPartitions="4",
    ),
    "ingest_partitioned_date": ingest_partitioned_date,
    # Bounds far inside the values: the outer ranges are open, so all rows come.
    "ingest_partitioned_narrow": from_database(
        "orders",
        COMPLETELY,
        partitionColumn="o_orderkey",
        lowerBound="100",
        upperBound="200",
        numPartitions="4",
    ),
    "ingest_partitioned_daily": from_database(
        "orders",
        DAILY,
        as_of=ORDER_DAY_AFTER,
        checkColumn="o_orderdate",
        partitionColumn="o_orderkey",
        numPartitions="4",
    ),
    "ingest_partitioned_incremental": from_database(
        "orders",
        INCREMENTALLY,
        checkColumn="o_orderkey",
        lastValue=LAST_KEY,
        partitionColumn="o_orderkey",
        numPartitions="4",
    ),
    "ingest_partitioned_balanced": from_database(
        "orders",
        INCREMENTALLY,
        checkColumn="o_orderkey",
        lastValue=LAST_KEY,
        partitionColumn="o_orderdate",
        numPartitions="4",
        balanceReads="true",
    ),
    "ingest_partitioned_hot": from_database(
        "lineitem",
        COMPLETELY,
        partitionColumn="l_linenumber,l_orderkey",
        numPartitions="16",
        balanceReads="true",
    ),
    # A few values that many rows share, split by a number.
    "ingest_partitioned_text": from_database(
        "customer", COMPLETELY, partitionColumn="c_mktsegment,c_custkey", numPartitions="16", balanceReads="true"
    ),
    # A text key with a long head that all share.
    "ingest_partitioned_names": from_database(
        "customer", COMPLETELY, partitionColumn="c_name", numPartitions="8", balanceReads="true"
    ),
    # Most rows lie in a small part of the values.
    "ingest_partitioned_skewed": ingest_partitioned_skewed,
    "conform_schema": conform_schema,
    "conform_schema_lenient": conform_schema_lenient,
    "conform_types": conform_types,
    "day_functions": day_functions,
    "sink_parquet": round_trip("lineitem", "parquet"),
    "sink_orc": round_trip("lineitem", "orc"),
    "sink_avro": round_trip("lineitem", "avro"),
    "sink_json": round_trip("orders", "json"),
    "sink_csv": round_trip("orders", "csv"),
    "sink_overwrite_twice": round_trip("orders", times=2),
    "sink_append_twice": round_trip(
        "orders", mode=INCREMENTALLY, times=2, checkColumn="o_orderkey", lastValue="0"
    ),
    "sink_partitioned_one": round_trip("orders", partitionKeys="o_orderstatus"),
    "sink_partitioned_many": round_trip("orders", partitionKeys="o_orderstatus,o_orderpriority"),
    "sink_partitioned_rebalanced": round_trip(
        "lineitem", partitionKeys="l_returnflag, l_linestatus", rebalance="true"
    ),
    "sink_replace_day": sink_replace_day,
    "replace_day_moved_keys": replace_day_moved_keys,
    "replace_day_emptied": replace_day_emptied,
    "source_evolved_files": source_evolved_files,
    "source_partitioned_files": source_partitioned_files,
    "daily_whole_day_partitioned": daily_whole_day_partitioned,
    "incremental_text_continues": continued(QUOTED, "''", "UTC", "UTC"),
    "incremental_instant_continues": continued(
        MOMENT, "2000-01-01 00:00:00Z", "UTC", "America/New_York"
    ),
    "incremental_double_continues": continued(MEASURE, "-1", "UTC", "UTC"),
    "job_targets_files": job_targets_files,
    "job_daily": job_daily,
    "job_daily_files": job_daily_files,
    "job_by_mode": job_by_mode,
    "job_by_mode_files": job_by_mode_files,
    "job_conformed_files": job_conformed_files,
    "job_configured_files": job_configured_files,
    "next_last_value": next_last_value,
    "job_next_last_value": job_next_last_value,
}
