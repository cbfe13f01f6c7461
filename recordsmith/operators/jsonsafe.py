"""Dates and timestamps as ISO text, at any nesting of a table's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _iso_timestamp(c: Column) -> Column:
    """``isoformat()``: seconds always, six digits of a second only where they are not zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(
        F.concat(whole, F.lit("."), F.date_format(c, "SSSSSS")))


def _holds_time(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_time(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_time(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_time(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def iso(c: Column, kind: T.DataType) -> Column:
    """``c`` with every date and timestamp in it as text; nulls stay null."""
    if not _holds_time(kind):
        return c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: iso(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: iso(x, kind.valueType))
    if isinstance(kind, T.StructType):
        made = F.struct(*[iso(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), made)
    return F.date_format(c, "yyyy-MM-dd") if isinstance(kind, T.DateType) else _iso_timestamp(c)


def json_safe(df: DataFrame) -> DataFrame:
    """Every column with its dates and timestamps as ISO text; a projection, no shuffle."""
    return df.select(*[iso(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
