"""Parquet, CSV, JSON and JDBC writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ids import running_total
from tablewright.operators.sizing import measured_bytes
from tablewright.sources.csv import read_csv_text
from tablewright.sources.tables import JdbcServer

# A report of at most this size becomes one CSV file, a larger one stays in parts.
SINGLE_FILE_BYTES = 64 * 1024 * 1024
# The most steps of a counted export: each costs one comparison a row.
MOST_STEPS = 200


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", *partition_by: str) -> None:
    """Parquet folder, replaced by default."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_all(tables: Mapping[str, DataFrame], root: str) -> None:
    """One Parquet folder per table. Rows are not sorted: readers sort."""
    for name, df in tables.items():
        write_parquet(df, f"{root}/{name}")


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop and recreate a table of the session's catalogue."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing the previous ones."""
    df.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               null_value: str = "", rows_per_file: int | None = None, compression: str = "none", fast: bool = False) -> None:
    """CSV with a header in every file.

    A compressed file is read by one task, so give ``rows_per_file`` with ``compression``. ``fast``
    lets gzip and deflate take their fastest level, for files that are soon read and deleted.

    ``single_file`` is for reports: a table that one task can write becomes one file. A larger
    one is exported all the same, in parts, as is every table without it.
    """
    if single_file and measured_bytes(df)[1] <= SINGLE_FILE_BYTES:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").option("header", True).option("nullValue", null_value).option("compression", compression)
    writer = writer.option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if fast:
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def export_counted(df: DataFrame, path: str, steps: int = 12, step: Column | None = None,
                   **options) -> DataFrame:
    """:func:`export_csv` that counts its rows while it writes: ``(step, rows, total)``.

    ``step`` is a number from 0 to ``steps - 1``; without it, tasks are dealt to the steps in
    turn. The tasks that write add up the counts (observed metrics), a retried task only once, so
    the export is not read again. ``total`` is the running sum; a step without rows has 0. A row
    whose step is null or out of range is an error, raised when the export is written.
    """
    if not 1 <= steps <= MOST_STEPS:
        raise ValueError(f"a counted export has 1 to {MOST_STEPS} steps")
    number = F.pmod(F.spark_partition_id(), F.lit(steps)) if step is None else step
    seen = Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("all"), *[F.count_if(number == i).alias(f"step_{i}") for i in range(steps)]
    )
    export_csv(counted, path, **options)
    rows = [(i, seen.get[f"step_{i}"]) for i in range(steps)]
    if sum(n for _, n in rows) != seen.get["all"]:
        raise ValueError("some rows belong to no step")
    counts = df.sparkSession.createDataFrame(rows, "step int, rows long")
    return running_total(counts, "step", "rows", "total")


def export_progress(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``(part, rows, total)`` of a finished CSV export; ``total`` is the running sum.

    Rows are counted, not lines: a quoted value may hold line breaks.
    """
    parts = read_csv_text(spark, path, names, multi_line=True).groupBy(F.col("source_file").alias("part"))
    return running_total(parts.agg(F.count("*").alias("rows")), "part", "rows", "total")


def jdbc_write_options(server: JdbcServer, table: str, batch_size: int = 10_000,
                       connections: int = 16, column_types: str | None = None) -> dict[str, str]:
    """Writer options; ``column_types`` is the DDL of the columns that need a database type."""
    options = {
        **server.options(), "dbtable": table, "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def write_jdbc(df: DataFrame, server: JdbcServer, table: str, mode: str = "overwrite",
               batch_size: int = 10_000, connections: int = 16,
               column_types: str | None = None) -> None:
    """Every task inserts its own rows in batches; overwrite drops and recreates the table.

    ``connections`` bounds how many tasks the database sees.
    """
    options = jdbc_write_options(server, table, batch_size, connections, column_types)
    df.write.format("jdbc").options(**options).mode(mode).save()
