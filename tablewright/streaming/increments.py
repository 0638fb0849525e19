"""Replay a table as increments with Structured Streaming.

A feed is a Parquet folder partitioned by increment. The stream takes new files from it,
transforms them and appends the rows to a target folder. Target, checkpoint and the record of the
runs lie in one folder, so that a restart always finds the offsets that belong to the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tablewright.operators.ids import running_total, slice_of
from tablewright.session import session_settings

BATCH = "stream_batch"
# The most increments that a run counts: each costs one comparison a row.
MOST_INCREMENTS = 200
# Micro-batches whose progress Spark keeps; a run of as many or more is counted from its output.
KEPT_PROGRESS = 10_000
RECORD = "run long, state string, batch int, rows long"


def data_path(target: str) -> str:
    return f"{target}/data"


def checkpoint_path(target: str) -> str:
    return f"{target}/checkpoint"


def record_path(target: str) -> str:
    return f"{target}/record"


def stage_increments(df: DataFrame, feed: str, n: int, *key: str,
                     slice_column: Column | None = None,
                     mode: str = "append") -> T.StructType:
    """Write ``df`` as a feed of ``n`` increments and return the feed's schema.

    The slice comes from the values of ``key`` (all columns if none is given), so a retry
    puts a row into the same increment. Select the columns that the stream needs first; the
    feed is a copy. The rows are rebalanced by increment into files of even size: without
    it, every task would write a small file per increment. ``mode`` is "overwrite" for a feed
    whose staging may have been cut short.
    """
    chosen = slice_of(n, *(key or df.columns)) if slice_column is None else slice_column.cast("int")
    staged = df.withColumn(BATCH, chosen)
    staged.hint("rebalance", BATCH).write.mode(mode).partitionBy(BATCH).parquet(feed)
    return staged.schema


def process_increments(spark: SparkSession, feed: str, schema: T.StructType, target: str,
                       transform: Callable[[DataFrame], DataFrame],
                       files_per_trigger: int | None = None,
                       bytes_per_trigger: int | None = None,
                       increments: int | None = None) -> StreamingQuery:
    """Process everything new in ``feed`` and stop; returns the finished query.

    The file sink's log makes each file's rows appear once, also when a run is repeated or
    is cut short. Without a limit per trigger, a run is one micro-batch.

    With ``increments``, the run counts the rows of increments 0 to that number while it writes
    them, and keeps the counts beside the output for :func:`recorded_progress`.
    """
    if increments is None:
        return _process(spark, feed, schema, target, transform, files_per_trigger, bytes_per_trigger)
    if not 1 <= increments <= MOST_INCREMENTS:
        raise ValueError(f"a run counts 1 to {MOST_INCREMENTS} increments")
    earlier = _record(spark, target)
    run = 1 + (earlier.agg(F.max("run")).first()[0] or 0)
    # Counts of earlier runs are missing if one was cut short or did not count.
    uncounted = not _unfinished(earlier).isEmpty() or (run == 1 and _exists(spark, checkpoint_path(target)))
    _note(spark, target, [(run, "started", None, None)])

    def counted(increment: DataFrame) -> DataFrame:
        return transform(increment).observe(
            "increments", F.count(F.lit(1)).alias("all"),
            *[F.count_if(F.col(BATCH) == i).alias(f"i{i}") for i in range(increments)],
        )

    with session_settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": str(KEPT_PROGRESS)}):
        query = _process(spark, feed, schema, target, counted, files_per_trigger, bytes_per_trigger)
    # A micro-batch may report more than once; the last report counts.
    progress_kept = query.recentProgress
    last = {p.batchId: p.observedMetrics.get("increments") for p in progress_kept}
    reports = [r for r in last.values() if r is not None]
    rows, state = {i: sum(r[f"i{i}"] for r in reports) for i in range(increments)}, "counted"
    if uncounted or len(progress_kept) >= KEPT_PROGRESS or sum(rows.values()) != sum(r["all"] for r in reports):
        found = read_increments(spark, target).groupBy(BATCH).count().collect()
        rows, state = {r[BATCH]: r["count"] for r in found}, "recounted"
    _note(spark, target, [*[(run, state, i, n) for i, n in rows.items()], (run, "finished", None, None)])
    return query


def _process(spark: SparkSession, feed: str, schema: T.StructType, target: str,
             transform: Callable[[DataFrame], DataFrame],
             files_per_trigger: int | None, bytes_per_trigger: int | None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    query = (
        transform(reader.parquet(feed))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path(target))
        .trigger(availableNow=True)
        .start(data_path(target))
    )
    query.awaitTermination()
    return query


def read_increments(spark: SparkSession, target: str) -> DataFrame:
    """All rows that finished increments have appended."""
    return spark.read.parquet(data_path(target))


def progress(output: DataFrame) -> DataFrame:
    """``(batch, input_rows, output_rows, status)``; ``output_rows`` is the running total."""
    return _with_totals(output.groupBy(F.col(BATCH).alias("batch")).agg(F.count("*").alias("input_rows")))


def _with_totals(per_batch: DataFrame) -> DataFrame:
    return running_total(per_batch, "batch", "input_rows", "output_rows").withColumn(
        "status", F.lit("processed")
    )


def _record(spark: SparkSession, target: str) -> DataFrame:
    """What the runs noted: ``started``, then ``counted`` or ``recounted`` rows, then ``finished``."""
    if not _exists(spark, record_path(target)):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(record_path(target))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _note(spark: SparkSession, target: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(record_path(target))


def _unfinished(record: DataFrame) -> DataFrame:
    """Runs that ended before their counts were kept and that no later run made good."""
    recounted = record.agg(F.coalesce(F.max(F.when(F.col("state") == "recounted", F.col("run"))), F.lit(0)).alias("upto"))
    runs = record.groupBy("run").agg(F.count_if(F.col("state") == "finished").alias("ends"))
    return runs.where((F.col("ends") == 0) & (F.col("run") > recounted.first()["upto"]))


def recorded_progress(spark: SparkSession, target: str) -> DataFrame:
    """:func:`progress` as the runs counted it, over all runs and without reading the output.

    The counts are the observed metrics of the micro-batches. A run that was cut short leaves no
    counts; the next run then counts the output once, and an error says so until it has run.
    """
    record = _record(spark, target)
    if not _unfinished(record).isEmpty():
        raise RuntimeError("a run was cut short: run the increments again")
    last = record.agg(F.max(F.when(F.col("state") == "recounted", F.col("run"))).alias("run")).first()["run"]
    counts = record.where(F.col("state").isin("counted", "recounted") & (F.col("run") >= F.lit(last or 0)))
    per_batch = counts.groupBy("batch").agg(F.sum("rows").alias("input_rows")).where("input_rows > 0")
    return _with_totals(per_batch)
