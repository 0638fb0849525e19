"""Left join of rows with statistics of their own group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.rollup import Metric, Rollup, rollup
from tablewright.operators.sizing import MAX_BROADCAST_BYTES, measured_bytes, row_width
from tablewright.session import MOST_PARTITIONS, bucketed, materialise, shuffle_partitions

# A key is hot when it would fill this share of a shuffle partition; there are at most so many
# hot keys as partitions divided by the share.
HOT_FILL = 0.5
# Keys that a sketch of heavy keys holds at a time: it misses no key with more than one row in
# 18,000, so of the largest number of buckets a key outside of it fills less than two.
SKETCHED = 100_000
# The most heavy keys that a sketch returns; only half as many can fill half a bucket.
MOST_HOT = 2 * MOST_PARTITIONS


def enrich_with_group_stats(df: DataFrame, key: str, metrics: Sequence[Metric],
                            max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add group metrics to every row; ``key`` becomes the first column.

    ``df`` is read twice (metrics, join), so pass a written table. Rows with a null key
    keep null metrics: the join is an equality. One of ``metrics`` must be a row count.
    """
    stats = materialise(rollup(df, Rollup("stats", key, tuple(metrics))), "group_stats")
    counter = next((m.name for m in metrics if m.kind == "count"), None)
    if counter is None:
        raise ValueError("enrichment needs a row count among its metrics")
    return attach_stats(df, stats, key, counter, max_broadcast_bytes)


def attach_stats(df: DataFrame, stats: DataFrame, key: str, counter: str,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left join ``df`` with ``stats`` (one row per key, ``counter`` = rows of that key).

    Measured small stats are broadcast and no row of ``df`` is shuffled. Larger stats are
    split: keys that would fill half a shuffle partition are broadcast, at most twice as many as
    there are partitions; the other rows are joined by a sorted shuffle.
    """
    known = stats.where(F.col(key).isNotNull())
    _, size = measured_bytes(known)
    if size <= max_broadcast_bytes:
        return df.join(F.broadcast(known), key, "left")

    total = known.agg(F.sum(counter)).first()[0]
    partitions = int(
        df.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    )
    is_hot = F.col(counter) >= F.lit(HOT_FILL * total / partitions)
    hot = known.where(is_hot)
    columns = [key, *[c for c in df.columns if c != key], *[c for c in stats.columns if c != key]]
    unshuffled = (
        df.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
        .where(F.col("__hot") | F.col(key).isNull())
        .select(*columns)
    )
    shuffled = (
        df.where(F.col(key).isNotNull())
        .join(F.broadcast(hot.select(key)), key, "left_anti")
        .join(known.where(~is_hot).hint("merge"), key, "left")
        .select(*columns)
    )
    return unshuffled.unionByName(shuffled)


def enrich(df: DataFrame, key: str, metrics: Sequence[Metric],
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """:func:`enrich_with_group_stats` or, for many keys, :func:`enrich_in_buckets`.

    One pass over the keys estimates how large the statistics will be.
    """
    width = F.coalesce(F.avg(F.octet_length(F.col(key).cast("string"))), F.lit(0))
    found = df.agg(F.approx_count_distinct(key).alias("keys"), width.alias("width")).first()
    expected = found["keys"] * (found["width"] + 16 * len(metrics) + 48)
    if expected <= max_broadcast_bytes:
        return enrich_with_group_stats(df, key, metrics, max_broadcast_bytes)
    return enrich_in_buckets(df, key, metrics)


def enrich_in_buckets(df: DataFrame, key: str, metrics: Sequence[Metric],
                      buckets: int | None = None) -> DataFrame:
    """Same rows as :func:`enrich_with_group_stats`, with one shuffle for statistics and join.

    For statistics too large to broadcast. A sketch finds the heavy keys; the rows of the others
    are shuffled once into a table with buckets by key, over which grouping and join move nothing.
    Rows of heavy keys are not shuffled: tasks add up their statistics, at most ``MOST_HOT`` keys,
    and get them broadcast. ``df`` is read four times, the heavy keys' rows not from the buckets,
    so pass a written table.
    """
    hashed = F.xxhash64(key)
    present = df.where(F.col(key).isNotNull())
    found = present.agg(
        F.count("*").alias("rows"), F.sum(row_width(df)).alias("bytes"),
        F.expr(f"approx_top_k(xxhash64(`{key}`), {SKETCHED}, {SKETCHED})").alias("heavy"),
    ).first()
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or min(MOST_PARTITIONS, shuffle_partitions(found["bytes"] or 0, configured))
    least = max(2, HOT_FILL * found["rows"] / buckets)
    heavy = [h["item"] for h in found["heavy"] or [] if h["count"] >= least][:MOST_HOT]
    spec = Rollup("stats", key, tuple(metrics))
    columns = [key, *[c for c in df.columns if c != key], *[m.name for m in metrics]]

    marks = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in heavy], "__hash long"))
    hot = present.join(marks, hashed == F.col("__hash"), "left_semi")
    hot_stats = materialise(rollup(hot, spec), "hot_stats")
    unshuffled = hot.join(F.broadcast(hot_stats), key, "left").select(*columns)
    without = df.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(hot_stats.schema[m.name].dataType).alias(m.name) for m in metrics])
    cold = bucketed(present.join(marks, hashed == F.col("__hash"), "left_anti"), key, buckets)
    joined = cold.join(rollup(cold, spec).hint("merge"), key, "left").select(*columns)
    return unshuffled.unionByName(without.select(*columns)).unionByName(joined)
