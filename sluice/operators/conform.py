"""Conforming rows to an Avro schema: pick, order and cast its fields, on all levels."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from sluice.functions.columns import column, find_field

_NULL_FLAGS = ("nullable", "containsNull", "valueContainsNull")


def load_avro_schema(spark: SparkSession, path: str) -> StructType:
    """The columns described by an Avro schema file on any path Spark can read."""
    rows = spark.read.text(path, wholetext=True).take(2)
    if not rows:
        raise ValueError(f"the Avro schema '{path}' is empty")
    if len(rows) > 1:
        raise ValueError(f"'{path}' matches several files; an Avro schema is one")
    try:
        return avro_to_struct(spark, rows[0].value)
    except ValueError as error:
        raise ValueError(f"{path}: {error}") from error


def avro_to_struct(spark: SparkSession, avro_schema: str) -> StructType:
    """Spark's own mapping of an Avro record schema. Nothing is enforced as non-null."""
    jvm = spark._jvm
    try:
        parsed = jvm.org.apache.avro.Schema.Parser().parse(avro_schema)
        dtype = jvm.org.apache.spark.sql.avro.SchemaConverters.toSqlType(parsed).dataType()
    except Py4JJavaError as error:
        reason = error.java_exception.getMessage()
        raise ValueError(f"not a usable Avro schema: {reason}") from error
    described = json.loads(dtype.json(), object_hook=_allow_nulls)
    if not isinstance(described, dict) or described.get("type") != "struct":
        raise ValueError(f"the Avro schema must be a record, not {described}")
    return StructType.fromJson(described)


def _allow_nulls(described: dict) -> dict:
    """Without this a source that allows NULLs inside an array or struct could not be cast."""
    return described | {key: True for key in _NULL_FLAGS if key in described}


def conform(df: DataFrame, schema: StructType, on_error: str = "fail") -> DataFrame:
    """Exactly the fields of ``schema``, in its order and spelling, cast to its types.

    Fields of records are found by name, as columns are, also those in arrays and maps; a record
    that lacks one is refused. A value that cannot be cast fails the run, or becomes NULL by itself with
    ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not '{on_error}'")
    lenient = on_error == "null"
    return df.select(*[_field(df, field, lenient).alias(field.name) for field in schema.fields])


#: The column with what could not be cast, and its type: which field, and its value as text.
REJECTED = "rejected"


def conform_apart(df: DataFrame, schema: StructType, rejected: str = REJECTED) -> DataFrame:
    """``conform`` with NULL for what cannot be cast, and a column ``rejected`` that lists it:
    an array of ``field`` and ``value``, empty for rows that fit. The rows as they were are in the
    struct column ``source``."""
    whole = F.struct(*[column(name) for name in df.columns]).alias("source")
    values = F.struct(*[_field(df, field, True).alias(field.name) for field in schema.fields])
    both = df.select(whole, values.alias("conformed"))
    found = []
    for field in schema.fields:
        source = find_field(df.schema, field.name)
        before, after = F.col("source").getField(source.name), F.col("conformed").getField(field.name)
        found.append(_lost(before, after, source.dataType, field.dataType, field.name))
    lists = [one for one in found if one is not None] or [F.array().cast(_LOST)]
    return both.select("source", "conformed", F.concat(*lists).alias(rejected))


_LOST = "array<struct<field:string,value:string>>"


def _field(df: DataFrame, field: StructField, lenient: bool) -> Column:
    value, source = column(field.name), find_field(df.schema, field.name)
    if source is None:  # Spark says so
        return value.cast(field.dataType)
    return _converted(value, source.dataType, field.dataType, field.name, lenient)


def _converted(value: Column, source: DataType, target: DataType, path: str, lenient: bool) -> Column:
    """``value`` as ``target``. A plain cast would go by the position of a record's fields."""
    if _alike(source, target):
        return value
    if isinstance(source, StructType) and isinstance(target, StructType):
        fields = []
        for field in target.fields:
            own = _inner(source, field, path)
            inner = _converted(value.getField(own.name), own.dataType, field.dataType, f"{path}.{field.name}", lenient)
            fields.append(inner.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        kinds = source.elementType, target.elementType
        return F.transform(value, lambda item: _converted(item, *kinds, f"{path}[]", lenient))
    if isinstance(source, MapType) and isinstance(target, MapType):
        if not _alike(source.keyType, target.keyType):
            value = F.transform_keys(value, lambda key, _: key.cast(target.keyType))
        kinds = source.valueType, target.valueType
        return F.transform_values(value, lambda _, item: _converted(item, *kinds, f"{path}{{}}", lenient))
    if _is_union(target) and not isinstance(source, StructType):
        chosen = _member(source, target)
        members = []
        for field in target.fields:
            inner = F.lit(None).cast(field.dataType)
            if field.name == chosen.name:
                inner = _converted(value, source, field.dataType, path, lenient)
            members.append(inner.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*members))
    return _try_cast(value, source, target) if lenient else value.cast(target)


def _lost(before: Column, after: Column, source: DataType, target: DataType, path: str) -> Column | None:
    """What was a value and is NULL now, as an array; None where nothing can be."""
    if _alike(source, target):
        return None
    if isinstance(source, StructType) and isinstance(target, StructType):
        found = []
        for field in target.fields:
            own = _inner(source, field, path)
            values = before.getField(own.name), after.getField(field.name)
            found.append(_lost(*values, own.dataType, field.dataType, f"{path}.{field.name}"))
        lists = [one for one in found if one is not None]
        return F.concat(*lists) if lists else None
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return _lost_in(before, after, source.elementType, target.elementType, f"{path}[]")
    if isinstance(source, MapType) and isinstance(target, MapType):
        values = F.map_values(before), F.map_values(after)
        return _lost_in(*values, source.valueType, target.valueType, f"{path}{{}}")
    if _is_union(target) and not isinstance(source, StructType):
        chosen = _member(source, target)
        return _lost(before, after.getField(chosen.name), source, chosen.dataType, path)
    one = F.struct(F.lit(path).alias("field"), before.cast("string").alias("value"))
    lost = F.when(before.isNotNull() & after.isNull(), F.array(one))
    return F.coalesce(lost.cast(_LOST), F.array().cast(_LOST))


def _lost_in(before: Column, after: Column, source: DataType, target: DataType, path: str) -> Column | None:
    if _alike(source, target):
        return None
    each = F.zip_with(before, after, lambda x, y: _lost(x, y, source, target, path))
    return F.coalesce(F.flatten(each), F.array().cast(_LOST))


def _alike(source: DataType, target: DataType) -> bool:
    return source.simpleString() == target.simpleString()


def _inner(source: StructType, field: StructField, path: str) -> StructField:
    own = find_field(source, field.name)
    if own is None:
        raise ValueError(f"'{path}.{field.name}' is not in the source, whose '{path}' has {source.names}")
    return own


def _is_union(target: DataType) -> bool:
    """Avro unions of several types become records with these names."""
    return isinstance(target, StructType) and target.names == [f"member{i}" for i in range(len(target))]


def _member(source: DataType, union: StructType) -> StructField:
    """Where a plain value of a union belongs: with its own type, else a number with the first
    numbers, else with the text, else with the first."""
    wanted = [
        [f for f in union if _alike(source, f.dataType)],
        [f for f in union if isinstance(source, NumericType) and isinstance(f.dataType, NumericType)],
        [f for f in union if isinstance(f.dataType, StringType)],
        union.fields,
    ]
    return next(fields[0] for fields in wanted if fields)


def _try_cast(value: Column, source: DataType, target: DataType) -> Column:
    """A cast that gives NULL for what does not fit.

    Spark's own does so by raising and catching an exception per value, some twenty times the
    cost of a cast that succeeds. Numbers that are clearly too large skip it.
    """
    cast, limit = value.try_cast(target), _magnitude(target)
    if limit is None or not isinstance(source, NumericType):
        return cast
    # As doubles both sides may be rounded, but never past each other: whatever fits gets by.
    return F.when(F.abs(value.cast("double")) <= F.lit(limit), cast)


def _magnitude(dtype: DataType) -> float | None:
    """A number that nothing of this type exceeds."""
    if isinstance(dtype, DecimalType):
        return 10.0 ** (dtype.precision - dtype.scale)
    bits = {IntegerType: 31, LongType: 63}.get(type(dtype))
    # Fractions are cut off, so a little more than the highest whole number still fits.
    return 2.0**bits + 1 if bits else None
