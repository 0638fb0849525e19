"""Splits, unions and the incremental job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import all_true, band, round_mean
from tablewright.operators.ids import running_total, slice_of, surrogate_id
from tablewright.session import workspace
from tablewright.streaming import (
    BATCH,
    process_increments,
    read_increments,
    recorded_progress,
    stage_increments,
)
from tablewright.workload.tables import Query, half_up, table

SLICES = 5


def _sliced(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return events.withColumn(BATCH, slice_of(SLICES, "event_id", integer=True))


def stable_split(spark: SparkSession, folder: str) -> DataFrame:
    return _sliced(spark, folder)


def each_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Every increment selected by its own filter and summed up."""
    sliced = _sliced(spark, folder)
    return reduce(DataFrame.unionByName, [
        sliced.where(F.col(BATCH) == i).drop(BATCH).agg(
            F.lit(i).alias("batch"), F.count("*").alias("input_rows"),
            F.max("event_id").alias("last_event"), round_mean(F.avg("value")).alias("avg_value"),
        )
        for i in range(SLICES)
    ])


def split_counts_running(spark: SparkSession, folder: str) -> DataFrame:
    counts = _sliced(spark, folder).groupBy(BATCH).agg(F.count("*").alias("input_rows"))
    return running_total(counts, BATCH, "input_rows", "output_rows")


def union_parts(spark: SparkSession, folder: str) -> DataFrame:
    sliced = _sliced(spark, folder)
    parts = [sliced.where(F.col(BATCH) == i).drop(BATCH) for i in range(SLICES)]
    return reduce(DataFrame.unionByName, parts)


def row_id_unique(spark: SparkSession, folder: str) -> DataFrame:
    numbered = surrogate_id(table(spark, folder, "lineitem"), "row_id")
    ids = numbered.groupBy("row_id").agg(F.count("*").alias("n"))
    return ids.agg(
        F.sum("n").alias("rows"), F.count("*").alias("ids"), (F.min("row_id") >= 1).alias("positive")
    )


def _flags(events: DataFrame) -> DataFrame:
    has_value, is_sale = F.col("value") > 10, F.col("event_type") == "purchase"
    return events.select(
        "event_id", "event_type", "value",
        band("value", [(50, "large"), (10, "middle")], "small").alias("value_flag"),
        all_true(has_value, is_sale).alias("is_premium"),
        BATCH,
    )


def _stream(spark: SparkSession, folder: str, runs: int = 1, counted: int | None = None) -> str:
    """Stage the events as a feed, run the stream ``runs`` times and return its target."""
    place = workspace(spark)
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    stage_increments(
        events, f"{place}/feed", SLICES,
        slice_column=slice_of(SLICES, "event_id", integer=True),
    )
    schema = T.StructType([*events.schema.fields, T.StructField(BATCH, T.IntegerType())])
    for _ in range(runs):
        process_increments(
            spark, f"{place}/feed", schema, f"{place}/output", _flags, files_per_trigger=1, increments=counted
        )
    return f"{place}/output"


def stream_flags(spark: SparkSession, folder: str) -> DataFrame:
    return read_increments(spark, _stream(spark, folder))


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress as counted by the runs, after a repeated one, which must not add rows."""
    return recorded_progress(spark, _stream(spark, folder, runs=2, counted=SLICES))


_SLICED = """
    SELECT event_id, user_id, event_type, value, CAST(event_id % 5 AS INTEGER) AS stream_batch
    FROM events"""

QUERIES = {
    "stable_split": Query(stable_split, _SLICED),
    "each_increment": Query(each_increment, f"""
        SELECT stream_batch AS batch, count(*) AS input_rows, max(event_id) AS last_event,
            {half_up('avg(value)')} AS avg_value
        FROM ({_SLICED}) GROUP BY stream_batch"""),
    "split_counts_running": Query(split_counts_running, f"""
        SELECT stream_batch, count(*) AS input_rows,
            CAST(sum(count(*)) OVER (ORDER BY stream_batch) AS BIGINT) AS output_rows
        FROM ({_SLICED}) GROUP BY stream_batch"""),
    "union_parts": Query(union_parts, "SELECT event_id, user_id, event_type, value FROM events"),
    "row_id_unique": Query(row_id_unique, """
        SELECT count(*) AS "rows", count(*) AS ids, true AS positive FROM lineitem"""),
    "stream_flags": Query(stream_flags, """
        SELECT event_id, event_type, value,
            CASE WHEN value >= 50 THEN 'large' WHEN value >= 10 THEN 'middle' ELSE 'small' END
                AS value_flag,
            coalesce(value > 10 AND event_type = 'purchase', false) AS is_premium,
            CAST(event_id % 5 AS INTEGER) AS stream_batch
        FROM events"""),
    "stream_progress": Query(stream_progress, """
        SELECT CAST(event_id % 5 AS INTEGER) AS batch, count(*) AS input_rows,
            CAST(sum(count(*)) OVER (ORDER BY CAST(event_id % 5 AS INTEGER)) AS BIGINT)
                AS output_rows,
            'processed' AS status
        FROM events GROUP BY 1"""),
}
