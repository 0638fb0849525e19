"""Measure a table before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound for one broadcast side. Spark refuses broadcasts above 8 GB; an executor
# holds one copy, so this stays far below its memory.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_OVERHEAD = 32


def row_width(df: DataFrame) -> Column:
    """An estimate of a row's bytes in memory."""
    width = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"{field.name}: nested columns are not measured")
        else:
            width = width + F.lit(16)
    return width.cast("long")


def expected_bytes(schema: T.StructType, rows: int, text_bytes: int) -> int:
    """:func:`row_width` of ``rows`` rows that are still text; its ``text_bytes`` count in full."""
    wide = sum(8 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 16 for f in schema.fields)
    return rows * (_ROW_OVERHEAD + wide) + text_bytes


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and an estimate of their size in memory, from one aggregate."""
    row = df.agg(F.count("*").alias("n"), F.sum(row_width(df)).alias("b")).first()
    return row["n"], row["b"] or 0
