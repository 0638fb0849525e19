"""Inner joins of many rows with tables that describe their keys."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.sizing import MAX_BROADCAST_BYTES, measured_bytes, row_width
from tablewright.session import dealt

# Bytes of rows in one bucket, by the estimate of :func:`row_width`.
BUCKET_BYTES = 512 * 1024 * 1024
# The most buckets that one task writes at a time, and the most files of one table; beyond them
# rows are shuffled.
MOST_BUCKETS, MOST_FILES = 200, 20_000
# A key is heavy if it would fill this share of a bucket. The sketch holds so many keys at a time
# that it misses none of those.
HEAVY_FILL, SKETCHED = 0.5, 20_000
# Parts of a heavy key for each bucket; a hash deals them out.
PARTS = 16


class Lookup(NamedTuple):
    """A table joined where its ``other_key`` equals the rows' ``key``."""

    key: str
    table: DataFrame
    other_key: str


def join_lookups(df: DataFrame, lookups: Sequence[Lookup], max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                 buckets: int | None = None) -> DataFrame:
    """``df`` inner joined with every lookup; all columns of all tables, whose names must differ.

    A measured small lookup is broadcast. For a larger one, every task writes its rows into buckets
    by key, as compressed columns: about a third of the bytes of shuffled rows. The join reads the
    buckets and moves nothing; it holds a bucket of the lookup, not of ``df``. Rows of a heavy key
    are spread over the buckets, and its lookup rows repeated there. ``df`` is read once more to
    find heavy keys, so pass a scan. Narrow lookups come first, so that few bytes travel on. Tables
    that would make too many files, and keys of two types, are joined by a shuffle.
    """
    sized = [(lookup, *measured_bytes(lookup.table)) for lookup in lookups]
    large = sorted((s for s in sized if s[2] > max_broadcast_bytes), key=lambda s: s[2] / s[1])
    if large:
        present = df
        for lookup in lookups:
            present = present.where(F.col(lookup.key).isNotNull())
        found = present.agg(
            F.count("*").alias("rows"), F.sum(row_width(df)).alias("bytes"),
            *[F.expr(f"approx_top_k(xxhash64(`{s[0].key}`), {2 * MOST_BUCKETS}, {SKETCHED})").alias(f"heavy_{i}") for i, s in enumerate(large)],
        ).first()
        most = max(found["bytes"] or 0, *(size for _, _, size in large))
        cores = df.sparkSession.sparkContext.defaultParallelism
        buckets = buckets or max(cores, math.ceil(most / BUCKET_BYTES))
        least = max(2, HEAVY_FILL * found["rows"] / buckets)
        tasks, df = present.rdd.getNumPartitions(), present
        for i, (lookup, _, _) in enumerate(large):
            alike = df.schema[lookup.key].dataType == lookup.table.schema[lookup.other_key].dataType
            if not alike or buckets > MOST_BUCKETS or tasks * buckets > MOST_FILES:
                df = df.join(lookup.table, F.col(lookup.key) == F.col(lookup.other_key))
                continue
            heavy = [h["item"] for h in found[f"heavy_{i}"] or [] if h["count"] >= least]
            df, tasks = _join_in_buckets(df, lookup, buckets, heavy), buckets
    for lookup, _, size in sized:
        if size <= max_broadcast_bytes:
            df = df.join(F.broadcast(lookup.table), F.col(lookup.key) == F.col(lookup.other_key))
    return df


def _join_in_buckets(df: DataFrame, lookup: Lookup, buckets: int, heavy: list[int]) -> DataFrame:
    """``heavy`` are hashes of keys; an equal hash of another key does no harm."""
    table = lookup.table.where(F.col(lookup.other_key).isNotNull())
    left, right = [lookup.key], [lookup.other_key]
    if heavy:
        marked = lambda c: F.xxhash64(c).isin(heavy)
        turn = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS * buckets))
        df = df.withColumn("__turn", F.when(marked(lookup.key), turn).otherwise(F.lit(0)).cast("int"))
        copies = F.when(marked(lookup.other_key), F.sequence(F.lit(0), F.lit(PARTS * buckets - 1))).otherwise(F.array(F.lit(0)))
        table = table.withColumn("__copy", F.explode(copies))
        left, right = [*left, "__turn"], [*right, "__copy"]
    rows, known = dealt(df, left, buckets), dealt(table, right, buckets)
    equal = [F.col(a) == F.col(b) for a, b in zip(left, right)]
    return rows.join(known.hint("shuffle_hash"), equal).drop("__turn", "__copy")
