"""Row ids and the stable split of a table into increments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.session import materialise

# monotonically_increasing_id keeps the row number of a partition in its lower 33 bits.
_ROW_BITS = 33


def surrogate_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Put a unique id, from 1 and with gaps, in front; costs no shuffle."""
    return df.select((F.monotonically_increasing_id() + 1).alias(name), "*")


def dense_id(df: DataFrame, order_by: Sequence[str | Column] | None = None,
             name: str = "id") -> DataFrame:
    """Put the id 1..n in front, in scan order or in the given order.

    Rows keep the number they have within their task; the sizes of the tasks, one row per
    task, give the offset to add. No single task sees all rows. The numbers are written
    before they are used, so a retried task cannot change them.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    numbered = materialise(
        ordered.withColumn("__slot", F.monotonically_increasing_id()), "numbered"
    )
    numbered = numbered.withColumn("__part", F.shiftright("__slot", _ROW_BITS))
    sizes = numbered.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    in_part = F.col("__slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.join(F.broadcast(offsets), "__part").select(
        (F.col("__offset") + in_part + 1).alias(name), *df.columns
    )


def slice_of(n: int, *key: str, integer: bool = False) -> Column:
    """Slice 0..n-1 of a row, from its own values and not from its position."""
    value = F.col(key[0]) if integer else F.xxhash64(*key)
    return F.pmod(value, F.lit(n)).cast("int")


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Running sum of a progress table, which has one row per increment or export part."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(upto))
