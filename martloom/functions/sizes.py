"""Measured sizes, for deciding whether a frame may be broadcast.

Spark estimates the size of a table from its files, but that of a join as the product of its
inputs and that of exploded rows as if there were one per input row. Where such an estimate would
decide, the size is measured.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted

BROADCAST_BYTES = 64 << 20
FIELD_BYTES = 16


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of ``df`` take at most ``limit`` bytes in memory.

    Counts rows first, which reads no column, so that a large frame is turned down cheaply.
    """
    return may_fit(df, limit) and measured_bytes(df) <= limit


def may_fit(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """False if the number of rows alone is too large, or broadcast joins are switched off."""
    if df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    return df.count() * FIELD_BYTES * len(df.columns) <= limit


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(_row_bytes(df.schema))).first()[0] or 0


def _row_bytes(schema: T.StructType) -> Column:
    varying = [
        F.coalesce(F.octet_length(_as_text(field)), F.lit(0))
        for field in schema
        if not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))
    ]
    return reduce(add, varying, F.lit(FIELD_BYTES * len(schema)).cast("long"))


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(quoted(field.name))
    if isinstance(field.dataType, T.BinaryType):
        return quoted(field.name)
    return quoted(field.name).cast("string")
