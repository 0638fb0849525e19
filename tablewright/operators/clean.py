"""Row cleaning: normalise columns, remove copies, require values."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import clean_text, fill_number, fill_text, round_number
from tablewright.operators.lookups import BUCKET_BYTES, HEAVY_FILL, MOST_BUCKETS, MOST_FILES, SKETCHED
from tablewright.operators.sizing import row_width
from tablewright.session import dealt, materialise

# Up to this size in memory, rows are deduplicated by a shuffle.
SHUFFLED_BYTES = 1024 * 1024 * 1024


def normalise(df: DataFrame, text: Sequence[str] = (), numbers: Sequence[str] = (),
              text_fill: Mapping[str, str] | None = None,
              number_fill: Mapping[str, float] | None = None, digits: int = 2) -> DataFrame:
    """Clean text, round numbers, then fill nulls, in one projection.

    A number is rounded before it is filled. Column order is kept.
    """
    columns = {c: clean_text(c) for c in text}
    columns.update({c: round_number(c, digits) for c in numbers})
    for c, sentinel in (text_fill or {}).items():
        columns[c] = fill_text(columns.get(c, c), sentinel)
    for c, value in (number_fill or {}).items():
        columns[c] = fill_number(columns.get(c, c), value)
    return df.withColumns(columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup; nulls are equal.

    The plan is a partial and a final hash aggregate keyed by all columns: each task drops
    its own copies first, so a row that makes up a third of the table reaches the shuffle
    at most once per task.
    """
    return df.dropDuplicates()


def distinct_rows_in_buckets(df: DataFrame, shuffled_bytes: int = SHUFFLED_BYTES, buckets: int | None = None) -> DataFrame:
    """:func:`distinct_rows` of a large table, which is written here and read from then on.

    Every task writes its rows into buckets by a hash of all their values, as compressed columns:
    about a fifth of the bytes of shuffled rows. Copies meet in one bucket and are dropped there, by
    all their values; nothing else moves. Rows whose copies would fill half a bucket are left to
    :func:`distinct_rows`, of which each task drops its own copies first. Up to ``shuffled_bytes``,
    measured, and where the buckets would be too many files, all rows are.
    """
    mark = "__row"
    while mark in {c.lower() for c in df.columns}:
        mark += "_"
    # With its null flags, a row's hash does not depend on where its nulls are left out.
    values = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    rows = materialise(df.withColumn(mark, F.xxhash64(*values)), "rows")
    found = rows.agg(
        F.count("*").alias("rows"), F.sum(row_width(df)).alias("bytes"),
        F.expr(f"approx_top_k({mark}, {2 * MOST_BUCKETS}, {SKETCHED})").alias("heavy"),
    ).first()
    buckets = buckets or max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((found["bytes"] or 0) / BUCKET_BYTES))
    files = rows.rdd.getNumPartitions() * buckets
    if (found["bytes"] or 0) <= shuffled_bytes or buckets > MOST_BUCKETS or files > MOST_FILES:
        return distinct_rows(rows.drop(mark))
    least = max(2, HEAVY_FILL * found["rows"] / buckets)
    heavy = F.col(mark).isin([h["item"] for h in found["heavy"] or [] if h["count"] >= least])
    # Rows in buckets are grouped by the hash and all values, which shuffles nothing.
    light = distinct_rows(dealt(rows.where(~heavy), [mark], buckets))
    return distinct_rows(rows.where(heavy).drop(mark)).unionByName(light.drop(mark))


def require_values(df: DataFrame, columns: Sequence[str],
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Rows where every one of ``columns`` is present, narrowed to ``keep``.

    Plain null tests reach the Parquet or JDBC scan. NaN is a value here, as in SQL.
    """
    for c in columns:
        df = df.where(df[c].isNotNull())
    return df.select(*keep) if keep else df
