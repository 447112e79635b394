"""Comparing rows that were sent with rows that have arrived, by count and checksum.

The checksum is a sum of one hash per row: it does not depend on order, is added up within the tasks that
write, and tells lost, doubled and changed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from sluice.functions.columns import column


class Mismatch(RuntimeError):
    """What was written is not what was read."""


def checksum(df: DataFrame, folder_keys: list[str]) -> Column:
    """The sum of the hashes of all rows of ``df``; ``folder_keys`` become folders where they are written."""
    keys = {key.lower() for key in folder_keys}
    values = []
    for field in df.schema.fields:
        value = column(field.name)
        if field.name.lower() in keys and isinstance(field.dataType, StringType):
            value = F.when(value != "", value)  # as a folder an empty text is NULL
        values.append(_hashable(value, field.dataType))
    return F.coalesce(F.sum(F.xxhash64(*values).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def _hashable(value: Column, dtype: DataType) -> Column:
    """Maps as sorted lists of their entries: their own order says nothing."""
    if not _has_map(dtype):
        return value
    if isinstance(dtype, MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda pair: F.struct(
                _hashable(pair["key"], dtype.keyType).alias("key"),
                _hashable(pair["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.array_sort(F.transform(pairs, lambda pair: F.xxhash64(pair)))
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda item: _hashable(item, dtype.elementType))
    fields = [_hashable(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _has_map(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_map(field.dataType) for field in dtype.fields)
    return isinstance(dtype, MapType)


def compare(arrived: DataFrame, folder_keys: list[str], rows: int, total: object, where: str) -> None:
    """Raises if ``arrived`` are not that many rows with that checksum."""
    found = arrived.agg(F.count(F.lit(1)).alias("rows"), checksum(arrived, folder_keys).alias("total")).first()
    if found.rows != rows:
        raise Mismatch(f"{rows} rows were written for '{where}', {found.rows} have arrived")
    if found.total != total:
        raise Mismatch(f"{rows} rows were written for '{where}', but some have arrived changed")
