"""Spark session and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import sys
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_local_folder: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "tablewright", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution.

    Parallelism is left to the cluster's own settings and to AQE; only a local master
    gets as many shuffle partitions as it has cores.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        cores = master.partition("[")[2].rstrip("]")
        if cores.isdigit():
            builder = (
                builder.config("spark.sql.shuffle.partitions", cores)
                .config("spark.driver.host", "localhost")
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
            )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """A new folder name that every executor can reach.

    It lies below ``spark.checkpoint.dir``. A local session without that setting gets a
    temporary folder; a cluster without it is an error, since a folder of one machine
    would be lost with that machine.
    """
    global _local_folder
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_folder is None:
            _local_folder = tempfile.TemporaryDirectory(prefix="tablewright-")
        root = _local_folder.name
    return f"{root.rstrip('/')}/tablewright-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the workspace and read it back.

    Later readers start from files, not from the whole lineage, so a lost executor costs
    only a re-read, and Catalyst plans with the true size.
    """
    path = f"{_scratch_folder(df.sparkSession)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """:func:`materialise`, shuffled once by ``key`` into ``buckets``.

    A grouping or join by ``key`` over the result needs no further shuffle. Every bucket is
    written by one task and read by one, so no key may hold much more than a bucket's share.
    """
    return _written_buckets(df.repartition(buckets, key), [key], buckets)


def dealt(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """:func:`bucketed` by ``keys`` without a shuffle: every task writes one file for each bucket.

    Rows move as compressed columns. For tables of which tasks times buckets is a bounded number
    of files. All files of a task are open at once, so that nothing is sorted.
    """
    with session_settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(buckets + 1)}):
        return _written_buckets(df, keys, buckets, compression="zstd")


def _written_buckets(df: DataFrame, keys: Sequence[str], buckets: int, **options: str) -> DataFrame:
    spark = df.sparkSession
    name, path = f"tablewright_{uuid.uuid4().hex}", f"{_scratch_folder(spark)}/buckets"
    writer = df.write.bucketBy(buckets, *keys).options(path=path, **options)
    writer.format("parquet").saveAsTable(name)
    table = spark.table(name)
    # The plan holds files and buckets by now: the catalogue's entry may go, the files stay.
    spark.sql(f"DROP TABLE {name}")
    return table


def _scratch_folder(spark: SparkSession) -> str:
    folder = workspace(spark)
    open_block = _scratch.get()
    if open_block is not None:
        open_block.append(folder)
    return folder


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that :func:`materialise` writes in this block when it ends.

    For jobs whose results are written elsewhere; a table read after the block must not
    depend on one of them.
    """
    folders: list[str] = []
    token = _scratch.set(folders)
    try:
        yield
    finally:
        _scratch.reset(token)
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(settings).delete(path, True)


# Bytes of input per shuffle partition, and the most partitions that one shuffle gets.
PARTITION_BYTES = 256 * 1024 * 1024
MOST_PARTITIONS = 32_768
# The most tasks that one scan gets: tasks times partitions is the number of shuffle blocks.
MOST_SCAN_TASKS = 100_000

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def shuffle_partitions(input_bytes: int, configured: int) -> int:
    """Partitions for a shuffle of the whole input; never fewer than the session has set."""
    return max(configured, min(MOST_PARTITIONS, math.ceil(input_bytes / PARTITION_BYTES)))


def split_bytes(input_bytes: int, configured: int) -> int:
    """Bytes per scan task; never fewer than the session has set."""
    return max(configured, math.ceil(input_bytes / MOST_SCAN_TASKS))


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within the block, these settings hold. What is planned after it does not know them."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, unpacked: float = 1) -> Iterator[None]:
    """Within the block, scans and shuffles are cut for an input of that size.

    AQE merges partitions that turn out small, but it cannot split those of a whole-row
    dedup that turn out too large; so the start must be high enough. Scan tasks grow instead
    of becoming more, since every task writes a block for every partition. A byte of compressed
    files holds ``unpacked`` bytes; a task takes so many fewer of them.
    """
    partitions = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(_SPLIT)
    )
    with session_settings(spark, {
        _INITIAL: str(shuffle_partitions(input_bytes, partitions)),
        _SPLIT: f"{split_bytes(math.ceil(input_bytes / unpacked), math.ceil(split / unpacked))}b",
    }):
        yield


def ship_with_tasks(module: str) -> None:
    """Send the functions of ``module`` to the tasks by value.

    Executors then need no copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
