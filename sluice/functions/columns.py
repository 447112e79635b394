"""Small helpers for naming and looking up columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def column(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_field(schema: StructType, name: str) -> StructField | None:
    """The field with this name, upper and lower case alike as in Spark's resolver."""
    exact = [f for f in schema.fields if f.name == name]
    alike = [f for f in schema.fields if f.name.lower() == name.lower()]
    return (exact or alike or [None])[0]


def require_field(df: DataFrame, name: str, role: str) -> StructField:
    field = find_field(df.schema, name)
    if field is None:
        raise ValueError(f"{role} '{name}' is not a column of the source; it has {df.columns}")
    return field
