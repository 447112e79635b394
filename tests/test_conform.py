from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice import avro_to_struct, conform, conform_apart, load_avro_schema

RECORD = {"type": "record", "name": "inner", "fields": [{"name": "x", "type": "int"}]}

TYPES = {
    "int": ("int", "int"),
    "long": ("long", "bigint"),
    "float": ("float", "float"),
    "double": ("double", "double"),
    "boolean": ("boolean", "boolean"),
    "string": ("string", "string"),
    "bytes": ("bytes", "binary"),
    "fixed": ({"type": "fixed", "name": "f4", "size": 4}, "binary"),
    "enum": ({"type": "enum", "name": "e", "symbols": ["A", "B"]}, "string"),
    "date": ({"type": "int", "logicalType": "date"}, "date"),
    "millis": ({"type": "long", "logicalType": "timestamp-millis"}, "timestamp"),
    "micros": ({"type": "long", "logicalType": "timestamp-micros"}, "timestamp"),
    "local": ({"type": "long", "logicalType": "local-timestamp-micros"}, "timestamp_ntz"),
    "decimal": (
        {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2},
        "decimal(12,2)",
    ),
    "record": (RECORD, "struct<x:int>"),
    "array": ({"type": "array", "items": "long"}, "array<bigint>"),
    "map": ({"type": "map", "values": "double"}, "map<string,double>"),
    "optional": (["null", "string"], "string"),
    "wider": (["int", "long"], "bigint"),
    "either": (["int", "string"], "struct<member0:int,member1:string>"),
}


def avro(**fields):
    listed = [{"name": name, "type": kind} for name, kind in fields.items()]
    return json.dumps({"type": "record", "name": "r", "fields": listed})


def test_avro_types(spark):
    struct = avro_to_struct(spark, avro(**{name: kind for name, (kind, _) in TYPES.items()}))
    assert {f.name: f.dataType.simpleString() for f in struct} == {
        name: spark_type for name, (_, spark_type) in TYPES.items()
    }
    assert list(struct.names) == list(TYPES)
    assert all(f.nullable for f in struct)


def test_casts_to_every_type(spark):
    schema = avro_to_struct(spark, avro(**{n: k for n, (k, _) in TYPES.items() if n != "either"}))
    as_text = {"array": "array('1')", "map": "map('k', '1.5')", "record": "named_struct('x', '3')"}
    plain = {"boolean": "'true'", "date": "'2024-01-02'", "enum": "'A'", "optional": "'x'"}
    times = dict.fromkeys(("millis", "micros", "local"), "'2024-01-02 03:04:05'")
    given = {name: "'7'" for name in schema.names} | as_text | plain | times
    df = spark.range(1).select(*[F.expr(text).alias(name) for name, text in given.items()])
    for on_error in ("fail", "null"):
        row = conform(df, schema, on_error).first()
        assert row.int == 7 and row.wider == 7 and row.decimal == Decimal("7.00")
        assert row.bytes == b"7" and row.boolean is True and str(row.date) == "2024-01-02"
        assert row.array == [1] and row.map == {"k": 1.5} and row.record.x == 3
        assert row.local.isoformat() == "2024-01-02T03:04:05"


@pytest.mark.parametrize("text", ['"int"', '{"type": "array", "items": "int"}'])
def test_schema_must_be_a_record(spark, text):
    with pytest.raises(ValueError, match="must be a record"):
        avro_to_struct(spark, text)


def test_unreadable_schema(spark, tmp_path):
    path = tmp_path / "broken.avsc"
    path.write_text('{"type": "recor')
    with pytest.raises(ValueError, match="broken.avsc: not a usable Avro schema"):
        load_avro_schema(spark, str(path))


def test_schema_from_file(spark, tmp_path):
    path = tmp_path / "t.avsc"
    path.write_text(avro(a="int", b="string"))
    assert load_avro_schema(spark, str(path)).simpleString() == "struct<a:int,b:string>"


def test_order_spelling_and_dropped_columns(spark):
    df = spark.createDataFrame([("1", 2, 3)], "A string, B long, C long")
    result = conform(df, StructType.fromDDL("b int, a int"))
    assert result.dtypes == [("b", "int"), ("a", "int")]
    assert result.collect() == [(2, 1)]


def test_missing_column(spark):
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        conform(spark.range(1), StructType.fromDDL("nope int"))


def test_columns_with_dots(spark):
    df = spark.range(1).withColumnRenamed("id", "a.b")
    assert conform(df, StructType.fromDDL("`a.b` int")).dtypes == [("a.b", "int")]


def test_bad_values(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "c string")
    schema = StructType.fromDDL("c int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, schema).collect()
    assert [row.c for row in conform(df, schema, "null").collect()] == [1, None, None]
    with pytest.raises(ValueError, match="on_error"):
        conform(df, schema, "ignore")


BORDERS = {
    "double": [
        *(0.0, -0.0, 99999.994, 99999.995, 99999.996, 100000.0, -99999.994, -99999.995),
        *(2147483647.0, 2147483647.9, 2147483648.0, -2147483648.0, -2147483648.9, -2147483649.0),
        *(9.223372036854775e18, 9.223372036854776e18, -9.223372036854776e18, 9.3e18),
        *(float("nan"), float("inf"), float("-inf"), 1e30, None),
    ],
    "bigint": [2**63 - 1, -(2**63), 2**31 - 1, 2**31, -(2**31), -(2**31) - 1, 99999, 100000, None],
    "decimal(38,3)": [Decimal(t) for t in ("99999.994", "99999.995", "100000.000", "-1e20")],
}


@pytest.mark.parametrize("source", BORDERS)
@pytest.mark.parametrize("target", ["decimal(7,2)", "decimal(38,0)", "int", "bigint", "float"])
def test_lenient_casts_equal_plain_ones_at_the_borders(spark, source, target):
    df = spark.createDataFrame([(value,) for value in BORDERS[source]], f"c {source}")
    found = conform(df, StructType.fromDDL(f"c {target}"), "null").select(F.hash("c"), "c")
    plain = df.select(F.col("c").try_cast(target).alias("c")).select(F.hash("c"), "c")
    assert str(found.collect()) == str(plain.collect())


# Records within records


def nested(spark):
    return spark.sql("""
        SELECT * FROM VALUES
          (1, named_struct('b', 'x', 'A', '1'), array(named_struct('q', '2', 'p', 'y'), NULL), map('k', named_struct('v', array('3', 'z')))),
          (2, NULL, NULL, NULL),
          (3, named_struct('b', NULL, 'A', 'one'), array(), map())
        AS t(id, r, a, m)""")


NESTED = "r struct<a:int,B:string>, a array<struct<p:string,q:long>>, m map<string,struct<v:array<int>>>"


def test_fields_of_records_are_found_by_name(spark):
    found = conform(nested(spark), StructType.fromDDL(NESTED), "null")
    assert found.schema.simpleString() == f"struct<{NESTED.replace(' ', ':', 1).replace(', a ', ',a:').replace(', m ', ',m:').replace('long', 'bigint')}>"
    rows = [r.asDict(recursive=True) for r in found.collect()]
    assert rows[0] == {"r": {"a": 1, "B": "x"}, "a": [{"p": "y", "q": 2}, None], "m": {"k": {"v": [3, None]}}}
    assert rows[1] == {"r": None, "a": None, "m": None}
    assert rows[2] == {"r": {"a": None, "B": None}, "a": [], "m": {}}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(nested(spark), StructType.fromDDL(NESTED)).collect()


@pytest.mark.parametrize(
    "target, path",
    [
        ("r struct<a:int,c:int>", "'r.c'"),
        ("a array<struct<z:int>>", r"'a\[\].z'"),
        ("m map<string,struct<w:int>>", r"'m\{\}.w'"),
    ],
)
def test_a_missing_field_of_a_record_is_refused(spark, target, path):
    with pytest.raises(ValueError, match=f"{path} is not in the source"):
        conform(nested(spark), StructType.fromDDL(target))


def test_records_that_fit_are_left_alone(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', array(map('k', 2L))) AS r")
    assert "transform" not in conform(df, df.schema)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("source, member", [("1", 0), ("1L", 0), ("'x'", 1), ("true", 1), ("1.5D", 2), ("NULL", None)])
def test_plain_values_go_to_their_member_of_a_union(spark, source, member):
    union = StructType.fromDDL("u struct<member0:int,member1:string,member2:double>")
    value = conform(spark.sql(f"SELECT {source} AS u"), union).first().u
    assert (value is None and member is None) or [i for i, v in enumerate(value) if v is not None] == [member]


def test_keys_of_maps_are_cast(spark):
    found = conform(spark.sql("SELECT map(1, '2') AS m"), StructType.fromDDL("m map<string,int>")).first()
    assert found.m == {"1": 2}


def test_what_does_not_fit_is_listed_by_place(spark):
    apart = conform_apart(nested(spark), StructType.fromDDL(NESTED))
    assert apart.columns == ["source", "conformed", "rejected"]
    rows = {r.source.id: [tuple(x) for x in r.rejected] for r in apart.collect()}
    assert rows == {1: [("m{}.v[]", "z")], 2: [], 3: [("r.a", "one")]}
    same = spark.range(2)
    assert [r.rejected for r in conform_apart(same, same.schema).collect()] == [[], []]
