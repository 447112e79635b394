"""Conforming to Avro schemas: every kind of type, records within records, rows that do not fit.

``KINDS`` has one field for each kind of Avro type: the type, the field as the source has it, what is
shown of the conformed value, and the same in plain SQL.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import avro_to_struct, conform, ingest_table, read_table, target_path
from sluice.plans.specs import COMPLETELY
from sluice_checks.queries import Query, job, new_sink, read_back

KEY, PRICE = "o_orderkey", "o_totalprice"
DECIMAL = {"logicalType": "decimal", "precision": 12, "scale": 2}
INNER = {
    "type": "record",
    "name": "inner",
    "fields": [{"name": "day", "type": {"type": "int", "logicalType": "date"}}, {"name": "key", "type": "long"}],
}
TEXT = "cast(o_orderkey AS string)"
MOMENT = "timestamp_seconds(o_orderkey + 1717243200)"
CLOCK = "cast('2024-06-01 12:00:00' AS timestamp_ntz) + make_dt_interval(0, 0, 0, o_orderkey)"
SECONDS = "1717243200 + o_orderkey"

KINDS: dict[str, tuple[object, str, dict[str, str], dict[str, str]]] = {
    "as_int": ("int", TEXT, {"as_int": "as_int"}, {"as_int": "CAST(o_orderkey AS INTEGER)"}),
    "as_long": ("long", TEXT, {"as_long": "as_long"}, {"as_long": KEY}),
    "as_float": ("float", "o_orderkey % 100", {"as_float": "as_float"}, {"as_float": "CAST(o_orderkey % 100 AS FLOAT)"}),
    "as_double": ("double", TEXT, {"as_double": "as_double"}, {"as_double": "CAST(o_orderkey AS DOUBLE)"}),
    "as_boolean": ("boolean", "if(o_orderkey % 2 = 0, 'true', 'no')", {"as_boolean": "as_boolean"}, {"as_boolean": "o_orderkey % 2 = 0"}),
    "as_string": ("string", KEY, {"as_string": "as_string"}, {"as_string": "CAST(o_orderkey AS VARCHAR)"}),
    "as_bytes": ("bytes", "o_orderpriority", {"as_bytes": "hex(as_bytes)"}, {"as_bytes": "hex(encode(o_orderpriority))"}),
    "as_fixed": (
        {"type": "fixed", "name": "four", "size": 4},
        "lpad(cast(o_orderkey % 10000 AS string), 4, '0')",
        {"as_fixed": "cast(as_fixed AS string)"},
        {"as_fixed": "lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')"},
    ),
    "as_enum": (
        {"type": "enum", "name": "state", "symbols": ["F", "O", "P"]},
        "o_orderstatus",
        {"as_enum": "as_enum"},
        {"as_enum": "o_orderstatus"},
    ),
    "as_date": (
        {"type": "int", "logicalType": "date"},
        "date_format(o_orderdate, 'yyyy-MM-dd')",
        {"as_date": "as_date"},
        {"as_date": "CAST(o_orderdate AS DATE)"},
    ),
    "as_millis": (
        {"type": "long", "logicalType": "timestamp-millis"},
        MOMENT,
        {"as_millis": "unix_millis(as_millis)"},
        {"as_millis": f"1000 * ({SECONDS})"},
    ),
    "as_micros": (
        {"type": "long", "logicalType": "timestamp-micros"},
        f"date_format({MOMENT}, \"yyyy-MM-dd'T'HH:mm:ssXXX\")",
        {"as_micros": "unix_micros(as_micros)"},
        {"as_micros": f"1000000 * ({SECONDS})"},
    ),
    "as_local_millis": (
        {"type": "long", "logicalType": "local-timestamp-millis"},
        f"cast({CLOCK} AS string)",
        {"as_local_millis": "as_local_millis"},
        {"as_local_millis": "TIMESTAMP '2024-06-01 12:00:00' + to_seconds(o_orderkey)"},
    ),
    "as_local_micros": (
        {"type": "long", "logicalType": "local-timestamp-micros"},
        CLOCK,
        {"as_local_micros": "as_local_micros"},
        {"as_local_micros": "TIMESTAMP '2024-06-01 12:00:00' + to_seconds(o_orderkey)"},
    ),
    "as_decimal": (
        {"type": "bytes", **DECIMAL},
        PRICE,
        {"as_decimal": "as_decimal"},
        {"as_decimal": "CAST(o_totalprice AS DECIMAL(12, 2))"},
    ),
    "as_fixed_decimal": (
        {"type": "fixed", "name": "eight", "size": 8, **DECIMAL},
        PRICE,
        {"as_fixed_decimal": "as_fixed_decimal"},
        {"as_fixed_decimal": "CAST(o_totalprice AS DECIMAL(12, 2))"},
    ),
    "as_record": (
        INNER,
        "named_struct('key', cast(o_custkey AS string), 'other', 1, 'day', cast(o_orderdate AS date))",
        {"record_day": "as_record.day", "record_key": "as_record.key"},
        {"record_day": "CAST(o_orderdate AS DATE)", "record_key": "o_custkey"},
    ),
    "as_array": (
        {"type": "array", "items": ["null", "int"]},
        "array(cast(o_orderkey AS string), NULL, '7')",
        {"array_size": "size(as_array)", "array_sum": "as_array[0] + as_array[2]", "array_null": "as_array[1] IS NULL"},
        {"array_size": "3", "array_sum": "CAST(o_orderkey + 7 AS INTEGER)", "array_null": "TRUE"},
    ),
    "as_map": (
        {"type": "map", "values": "double"},
        "map(o_orderstatus, cast(o_custkey AS string))",
        {"map_size": "size(as_map)", "map_value": "as_map[as_enum]"},
        {"map_size": "1", "map_value": "CAST(o_custkey AS DOUBLE)"},
    ),
    "as_optional": (
        ["null", "string"],
        "if(o_orderkey % 3 = 0, NULL, o_orderpriority)",
        {"as_optional": "as_optional"},
        {"as_optional": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END"},
    ),
    "as_wider": (["int", "long"], TEXT, {"as_wider": "as_wider"}, {"as_wider": KEY}),
    "as_either": (
        ["int", "string"],
        KEY,
        {"either_number": "as_either.member0", "either_text": "as_either.member1"},
        {"either_number": "CAST(o_orderkey AS INTEGER)", "either_text": "CAST(NULL AS VARCHAR)"},
    ),
    "as_other": (
        ["int", "string"],
        "o_orderpriority",
        {"other_number": "as_other.member0", "other_text": "as_other.member1"},
        {"other_number": "CAST(NULL AS INTEGER)", "other_text": "o_orderpriority"},
    ),
}


def record(fields: dict[str, object], name: str = "r") -> str:
    listed = [{"name": field, "type": kind} for field, kind in fields.items()]
    return json.dumps({"type": "record", "name": name, "fields": listed})


def all_kinds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A source column for each kind, in an order of its own, and the schema of all."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    given = orders.select(*[F.expr(source).alias(name) for name, (_, source, _, _) in reversed(KINDS.items())])
    return given, record({name: kind for name, (kind, _, _, _) in KINDS.items()})


def shown(rows: DataFrame) -> DataFrame:
    views = {name: view for _, _, some, _ in KINDS.values() for name, view in some.items()}
    return rows.select(*[F.expr(view).alias(name) for name, view in views.items()])


def conform_avro_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    given, schema = all_kinds(spark, sf_dir)
    return shown(conform(given, avro_to_struct(spark, schema)))


def sink_avro_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a whole table job, written as Avro and read back."""
    given, schema = all_kinds(spark, sf_dir)
    source, sink, copy = new_sink(spark), new_sink(spark, "avro"), job("kinds")
    given.write.parquet(target_path(source, copy))
    columns = avro_to_struct(spark, schema)
    ingest_table(spark, copy, source, sink, COMPLETELY, columns)
    return shown(read_back(spark, sink, copy, conform(given, columns)))


NESTED = {
    "o_orderkey": "int",
    "place": {
        "type": "record",
        "name": "place",
        "fields": [
            {"name": "status", "type": "string"},
            {"name": "price", "type": {"type": "bytes", **DECIMAL}},
            {
                "name": "days",
                "type": {
                    "type": "array",
                    "items": {
                        "type": "record",
                        "name": "step",
                        "fields": [{"name": "later", "type": "int"}, {"name": "day", "type": {"type": "int", "logicalType": "date"}}],
                    },
                },
            },
        ],
    },
    "marks": {"type": "map", "values": {"type": "record", "name": "mark", "fields": [{"name": "b", "type": "long"}, {"name": "a", "type": "string"}]}},
}


def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose fields come in another order than the schema has them, on three levels."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    step = "named_struct('day', cast(o_orderdate AS date) + {0}, 'later', '{0}')"
    given = orders.selectExpr(
        f"map(o_orderstatus, named_struct('a', o_orderpriority, 'b', {TEXT})) AS marks",
        f"named_struct('days', array({step.format(0)}, {step.format(5)}), 'unused', 1,"
        " 'PRICE', o_totalprice, 'status', o_orderstatus) AS place",
        "o_orderkey",
    )
    found = conform(given, avro_to_struct(spark, record(NESTED)))
    return found.selectExpr(
        "o_orderkey",
        "place.status AS status",
        "place.price AS price",
        "place.days[0].day AS first_day",
        "place.days[1].day AS last_day",
        "place.days[1].later AS later",
        "marks[place.status].a AS mark",
        "marks[place.status].b AS mark_key",
    )


UNFIT = "if(o_orderkey % 7 = 0, concat('x', o_orderkey), cast(o_orderkey AS string))"


def conform_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has a text for a number, on two levels: both parts are the source."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    given = orders.selectExpr("o_orderkey", f"{UNFIT} AS number", f"array({TEXT}, {UNFIT}) AS numbers")
    source, sink, copy = new_sink(spark), new_sink(spark), job("orders", schema="s", quarantine="true")
    given.write.parquet(target_path(source, copy))
    kinds = {"o_orderkey": "long", "number": "int", "numbers": {"type": "array", "items": "long"}}
    ingest_table(spark, copy, source, sink, COMPLETELY, avro_to_struct(spark, record(kinds)))
    good = spark.read.parquet(target_path(sink, copy)).selectExpr("o_orderkey", "number", "numbers[1] AS second", "CAST(NULL AS string) AS field", "CAST(NULL AS string) AS value")
    bad = read_table(spark, sink, job("orders__rejected"), COMPLETELY).select("o_orderkey", F.explode("rejected").alias("one"))
    return good.unionAll(bad.selectExpr("o_orderkey", "CAST(NULL AS int)", "CAST(NULL AS bigint)", "one.field", "one.value"))


QUERIES: dict[str, Query] = {
    "conform_nested": conform_nested,
    "conform_avro_kinds": conform_avro_kinds,
    "sink_avro_kinds": sink_avro_kinds,
    "conform_quarantine": conform_quarantine,
}

ALL_KINDS = "SELECT " + ", ".join(f"{sql} AS {name}" for *_, some in KINDS.values() for name, sql in some.items()) + " FROM orders"

ORACLE: dict[str, str] = {
    "conform_nested": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus AS status,
               CAST(o_totalprice AS DECIMAL(12, 2)) AS price, CAST(o_orderdate AS DATE) AS first_day,
               CAST(o_orderdate AS DATE) + 5 AS last_day, 5 AS later, o_orderpriority AS mark, o_orderkey AS mark_key
        FROM orders
    """,
    "conform_avro_kinds": ALL_KINDS,
    "sink_avro_kinds": ALL_KINDS,
    "conform_quarantine": """
        SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS number, o_orderkey AS second,
               CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS value
        FROM orders WHERE o_orderkey % 7 <> 0
        UNION ALL
        SELECT o_orderkey, NULL, NULL, field, 'x' || o_orderkey
        FROM orders, (VALUES ('number'), ('numbers[]')) AS t(field) WHERE o_orderkey % 7 = 0
    """,
}
