"""Which types components and plain tables hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factview.errors import UnsupportedTypeError
from factview.functions.names import column

HELD = (T.LongType, T.IntegerType, T.ShortType, T.DoubleType, T.FloatType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType)
#: Types compared with a tolerance.
INEXACT = (T.DoubleType, T.FloatType, T.DecimalType)


def _held(field: T.StructField, strict: bool) -> object:
    c = column(field.name)
    if isinstance(field.dataType, T.ByteType):
        return c.cast("smallint").alias(field.name)
    if isinstance(field.dataType, HELD):
        return c
    if strict:
        raise UnsupportedTypeError(f"column {field.name!r} has type {field.dataType.simpleString()}, which a component cannot hold")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return (F.to_json(c) if nested else c.cast("string")).alias(field.name)


def for_table(df: DataFrame) -> DataFrame:
    """``df`` as a plain table holds it: bytes widened, other types as text."""
    return df.select(*[_held(f, False) for f in df.schema.fields])


def for_component(df: DataFrame) -> DataFrame:
    """``df`` as a component holds it; a type it cannot hold is an error that names the column."""
    return df.select(*[_held(f, True) for f in df.schema.fields])
