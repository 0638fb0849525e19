"""Profiles and rule checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, ``(column, nulls)``, in one pass over all columns."""
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns
    ])))


def null_total(df: DataFrame) -> DataFrame:
    """Missing values over all columns."""
    return null_profile(df).agg(F.sum("nulls").alias("null_total"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one (nulls are equal), as ``(rows, duplicates)``."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicates"),
    )


def profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, columns, missing values and duplicates, per value of ``by``.

    All four come from one grouping of equal rows: copies collapse within each task, and a
    group's counts are then added up, so one hot file is not one task. Rows are equal if two 64-bit
    hashes of all their values are, so that 16 bytes of a row are shuffled and not the row.
    """
    columns = [c for c in df.columns if c not in by]
    if "map<" in df.schema.simpleString() or "variant" in df.schema.simpleString():
        grouped = df.groupBy(*by, *columns)  # Spark hashes no such values
    else:
        # With its null flags, a row's hash does not depend on where its nulls are left out.
        row = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
        grouped = df.groupBy(*by, F.xxhash64(*row).alias("__first"), F.xxhash64(F.lit(1), *row).alias("__second"))
    # Rows of a group are equal, so any of them tells what is missing.
    copies = grouped.agg(F.count("*").alias("__copies"), *[F.any_value(is_missing(df, c)).alias(f"__missing_{i}") for i, c in enumerate(columns)])
    missing = [
        F.sum(F.when(F.col(f"__missing_{i}"), F.col("__copies")).otherwise(0)).alias(f"__null_{i}") for i in range(len(columns))
    ]
    totals = copies.groupBy(*by).agg(
        F.sum("__copies").alias("rows"),
        F.sum(F.col("__copies") - 1).alias("duplicates"),
        *missing,
    )
    entries = [e for i, c in enumerate(columns) for e in (F.lit(c), F.col(f"__null_{i}"))]
    return totals.select(
        *by,
        "rows",
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        F.create_map(*entries).alias("nulls"),
        "duplicates",
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for several tables."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are null or occur more than once, ``(key, copies)``."""
    return (
        df.groupBy(key).agg(F.count("*").alias("copies"))
        .where((F.col("copies") > 1) | F.col(key).isNull())
    )


def fingerprint(df: DataFrame) -> str:
    """Count and sum of row hashes: equal for equal rows in any order, whatever their partitioning."""
    hashed = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
    row = hashed.agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0)).alias("s")).first()
    return f"{row['n']}-{int(row['s']) % (1 << 64):016x}"


def same_rows(before: DataFrame, after: DataFrame) -> bool:
    """True if both tables have the same number of rows."""
    counts = {r["table"]: r["rows"] for r in row_counts({"before": before, "after": after}).collect()}
    return counts["before"] == counts["after"]
