"""Name, path, size and MD5 of the files in a folder."""

from __future__ import annotations

import ctypes
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import megabytes
from tablewright.session import materialise, session_settings, ship_with_tasks

_MARK = b"\xef\xbb\xbf"
# Bytes of a file that one task digests. A larger file goes from task to task.
PART_BYTES = 1 << 28


class _Md5:
    """MD5 with a state that another task can go on with; by OpenSSL, as far as ``hashlib`` uses it."""

    def __init__(self, state: bytes | None = None) -> None:
        import _hashlib

        self._library = ctypes.CDLL(_hashlib.__file__)  # and what it is linked with
        self._library.MD5_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        self._context = ctypes.create_string_buffer(state or b"", 128)  # MD5_CTX has 92 bytes and no pointers
        if state is None:
            self._library.MD5_Init(self._context)

    @staticmethod
    def works() -> bool:
        try:
            whole = _Md5()
            whole.update(_MARK)
            return _Md5(whole.state()).hexdigest() == hashlib.md5(_MARK).hexdigest()
        except (ImportError, OSError, AttributeError):
            return False

    def state(self) -> bytes:
        return self._context.raw

    def update(self, data: bytes) -> None:
        self._library.MD5_Update(self._context, data, len(data))

    def hexdigest(self) -> str:
        out, end = ctypes.create_string_buffer(16), ctypes.create_string_buffer(self.state(), 128)
        self._library.MD5_Final(out, end)
        return out.raw.hex()


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Path and length of the files; opens none of them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")


def _splits(most: int) -> dict[str, str]:
    """Settings by which a scan task has one file, or ``most`` bytes of it, and no second file."""
    return {"spark.sql.files.maxPartitionBytes": str(max(1, most)), "spark.sql.files.openCostInBytes": str(max(1, most)),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "10000"}


def _ended(name: str, size: int, done: int, digests: tuple) -> str:
    """MD5 of a file after its last line: of both ways to begin and to end, the one that gives the length."""
    for begin, digest in zip((b"", _MARK), digests):
        for end in (b"", b"\n"):
            if len(begin) + done + len(end) == size:
                digest.update(end)
                return digest.hexdigest()
    raise ValueError(f"{name}: {done} bytes read of {size}")


def _in_parts(spark: SparkSession, files: DataFrame, most: int) -> list[tuple[str, str]]:
    """Path and MD5 of every file of more than ``most`` bytes.

    In round k, one task for each file digests its k-th ``most`` bytes. Tasks get and give the number
    of bytes so far and the two states; no task reads another part. A line belongs to the part in
    which it begins.
    """
    large = [(row["path"], row["length"]) for row in files.where(F.col("length") > most).collect()]
    marked = _Md5()
    marked.update(_MARK)
    # By file: bytes so far (-1 before the first line), and the states without and with a mark.
    states = {file: (-1, _Md5().state(), marked.state()) for file in range(len(large))}

    def part(file: int, k: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done, *both = state
            digests = [_Md5(x) for x in both]
            for batch in batches:
                if not batch.num_rows:
                    continue
                if batch.column(0)[0].as_py() != k * most:
                    raise ValueError(f"{name}: part {k} of {most} bytes is not the scan's")
                body = (b"\n" if done >= 0 else b"") + b"\n".join(batch.column(1).cast(pa.binary()).to_pylist())
                done = max(done, 0) + len(body)
                for digest in digests:
                    digest.update(body)
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, (file, done, *(d.state() for d in digests))))], schema=kinds)

        name, state = large[file][0], states[file]
        kinds = pa.schema([("file", pa.int32()), ("done", pa.int64()), ("plain", pa.binary()), ("marked", pa.binary())])
        lines = spark.read.option("lineSep", "\n").text(re.sub(r"([\\{}\[\]*?])", r"\\\1", name))
        return lines.select("_metadata.file_block_start", "value").mapInArrow(run, "file int, done long, plain binary, marked binary")

    context = spark.sparkContext
    with session_settings(spark, _splits(most)):
        for k in range(max((-(-size // most) for _, size in large), default=0)):
            rows, wanted = [], []
            for file in (file for file, (_, size) in enumerate(large) if k * most < size):
                rows.append(part(file, k).rdd)
                wanted.append(sum(r.getNumPartitions() for r in rows[:-1]) + k)
            for row in context.runJob(context.union(rows), list, wanted):
                states[row["file"]] = (row["done"], bytes(row["plain"]), bytes(row["marked"]))
    return [(name, _ended(name, size, done, [_Md5(x) for x in both])) for (name, size), (done, *both) in zip(large, states.values())]


def file_digests(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """``(path, bytes, md5)`` of every file in ``path`` that fits ``glob``; read once, here.

    Files are read by Spark, with its storage settings, whatever their scheme and size: its line
    reader streams a file through one task, which holds one batch of lines. MD5 of a file has one
    order, so a file of more than ``PART_BYTES`` goes through several tasks, one after the other,
    each with the state of the one before (see :func:`_in_parts`); through one task, if Python's
    OpenSSL has no such state. The reader gives lines without the last line end, and
    without a byte order mark; the file's length tells what was there. One line of 2 GB is an error.
    Spark lists no empty files, so they are left out.
    """
    files = _files(spark, path, glob)
    largest = files.agg(F.max("length")).first()[0]
    most = largest
    if largest is not None and largest > PART_BYTES and _Md5.works():
        most = PART_BYTES
    schema = "path string, bytes bigint, md5 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size = None, 0

        def close() -> pa.RecordBatch:
            md5 = _ended(now, size, done, digests)
            return pa.RecordBatch.from_pylist([{"path": now, "bytes": size, "md5": md5}], schema=kinds)

        kinds = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("md5", pa.string())])
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode()
            for file in range(len(names.dictionary)):
                mine = batch.filter(pa.compute.equal(names.indices, file))
                name = names.dictionary[file].as_py()
                if name != now:
                    if now is not None:
                        yield close()
                    now, size, done = name, mine.column(1)[0].as_py(), 0
                    digests = hashlib.md5(), hashlib.md5(_MARK)
                    lead = b""
                else:
                    lead = b"\n"
                body = lead + b"\n".join(mine.column(2).cast(pa.binary()).to_pylist())
                done += len(body)
                for digest in digests:
                    digest.update(body)
        if now is not None:
            yield close()

    if largest is None:
        return spark.createDataFrame([], schema)
    # A scan task takes no part of a file, and no second file.
    with session_settings(spark, _splits(most)):
        lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)
        lines = lines.where(F.col("_metadata.file_size") <= most)
        found = lines.select("_metadata.file_path", "_metadata.file_size", "value").mapInArrow(run, schema)
        known = materialise(found, "digests")
    # The listing has plain paths, the reader's metadata URL-encoded ones; schemes are written in several ways.
    bare = lambda c: F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    plain = F.url_decode(F.replace(bare("file"), F.lit("+"), F.lit("%2B")))
    only_mark = F.when(F.col("length") == len(_MARK), F.md5(F.lit(_MARK)))
    missing = F.raise_error(F.concat(F.lit("not read: "), F.col("path"))).cast("string")
    found = files.join(known.select(F.col("path").alias("file"), "md5"), bare("path") == plain, "left")
    large = spark.createDataFrame(_in_parts(spark, files, most) if most < largest else [], "path string, in_parts string")
    return found.join(large, "path", "left").select(
        "path", F.col("length").alias("bytes"), F.coalesce("md5", "in_parts", only_mark, missing).alias("md5"))


def file_manifest(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """``(file, path, bytes, size_mb, md5)`` of every file in ``path`` that fits ``glob``.

    Any size and scheme; see :func:`file_digests`.
    """
    return file_digests(spark, path, glob).select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "path",
        "bytes",
        megabytes("bytes").alias("size_mb"),
        "md5",
    )


def folder_bytes(spark: SparkSession, path: str, glob: str = "*") -> int:
    """Size of the files in ``path``; opens none of them."""
    return _files(spark, path, glob).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


ship_with_tasks(__name__)
