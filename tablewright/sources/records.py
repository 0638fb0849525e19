"""CSV records that hold line breaks, read by many tasks a file.

Spark's text reader cuts a file into ranges of whole lines. A line break belongs to a quoted value
if an odd number of quotes comes before it, so a range only has to know whether it begins inside
quotes: a first pass counts the quotes of every range, a running sum over the ranges of a file
tells each its state, and a second pass cuts the records. Quotes stand around values, or doubled
inside them; a file in which they do not pair is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import materialise, ship_with_tasks

# The most text of one record that the first pass keeps at either end of a range. A record over
# two ends, or over a range without any quote, must fit; a longer one is an error.
MOST_CHARS = 16 << 20

_OPTIONS = {"quote": '"', "escape": '"'}


def read_lines(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """``(file, start, line)``: lines in order within each scan range, which begins at ``start``."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _odd_quotes() -> Column:
    """True if a line has an odd number of quotes; they are counted in lines that have any."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    return F.contains(F.col("line"), F.lit('"')) & (quotes % 2 == 1)


def has_line_breaks(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> bool:
    """True if a line has an odd number of quotes: a value goes on in the next line."""
    return not read_lines(spark, path, glob).where(_odd_quotes()).isEmpty()


class Lines(NamedTuple):
    """Lines of the files, their bytes, and whether values go on in the next line."""

    rows: int
    bytes: int
    breaks: bool


def measured_lines(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> Lines:
    """:func:`has_line_breaks` that also tells how much text there is, which sizes of compressed files do not."""
    found = read_lines(spark, path, glob).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("line")).alias("bytes"), F.count_if(_odd_quotes()).alias("odd")
    ).first()
    return Lines(found["rows"], found["bytes"] or 0, found["odd"] > 0)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Batches cut where the range changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column(1).to_numpy(zero_copy_only=False)
        files = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.column(0)[a].as_py(), int(starts[a]), batch.slice(a, b - a)


def _odd(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2 == 1


class _Kept:
    """Lines of one end of a range, as long as they fit."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.chars = 0

    def add(self, lines: pa.Array) -> None:
        if self.chars <= MOST_CHARS:
            self.chars += (pc.sum(pc.utf8_length(lines)).as_py() or 0) + len(lines)
            if self.chars <= MOST_CHARS:
                self.lines += lines.to_pylist()

    def text(self) -> str | None:
        return "\n".join(self.lines) if self.chars <= MOST_CHARS else None


def quote_ranges(lines: DataFrame) -> DataFrame:
    """Per scan range: ``odd`` (lines with an odd number of quotes), ``head`` and ``tail``.

    ``head`` is the text up to the first such line, the whole range if there is none; ``tail`` the
    text from the last one on, and ``tail_first`` whether that is the first line. Either is null if
    it is longer than ``MOST_CHARS``.
    """
    schema = "file string, start bigint, odd bigint, head string, tail string, tail_first boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def close() -> pa.RecordBatch:
            columns = [[now[0]], [now[1]], [odd], [head.text()], [tail.text() if odd else None], [last == 0]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        names = ["file", "start", "odd", "head", "tail", "tail_first"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        for file, start, batch in _runs(batches):
            if now != (file, start):
                if now is not None:
                    yield close()
                now, odd, head, tail, last, seen = (file, start), 0, _Kept(), _Kept(), -1, 0
            text = batch.column(2)
            at = np.flatnonzero(_odd(text))
            if not odd:
                head.add(text[: at[0] + 1] if len(at) else text)
            if len(at):
                tail, last = _Kept(), seen + int(at[-1])
                tail.add(text[int(at[-1]) :])
            elif odd:
                tail.add(text)
            odd += len(at)
            seen += batch.num_rows
        if now is not None:
            yield close()

    return lines.select("file", "start", "line").mapInArrow(run, schema)


def with_state(ranges: DataFrame) -> DataFrame:
    """Adds ``inside``: whether a range begins inside quotes. Ranges of a file are few: bytes / split size."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1)


def _whole_records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(file, first, record)`` of the records that one range holds; no line moves."""
    # One row for every range that begins inside quotes; the driver's list of scan tasks is larger.
    inside = F.broadcast(ranges.where("inside").select("file", "start", "inside"))
    schema = "file string, first boolean, record string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, head = None, None, False
        for file, start, batch in _runs(batches):
            fresh = now != (file, start)
            if fresh:
                now = file, start
                head = bool(batch.column(3)[0].as_py())  # lines of a record that began in an earlier range
                held = None
            text, odd = batch.column(2), _odd(batch.column(2))
            first = fresh and start == 0
            if held is None and not head and not odd.any():
                records = text
            else:
                out = []
                for i, (line, turns) in enumerate(zip(text.to_pylist(), odd.tolist())):
                    if head:
                        head = not turns
                    elif held is None:
                        if turns:
                            held = [line]
                            first = first and i > 0  # a first record over several lines is marked when it ends
                            opened = fresh and start == 0 and i == 0
                        else:
                            out.append((line, False))
                    else:
                        held.append(line)
                        if turns:
                            out.append(("\n".join(held), opened))
                            held = None
                records = pa.array([r for r, _ in out], pa.string())
                marks = [m for _, m in out]
                if first and out and not odd[0]:
                    marks[0] = True
                if len(records):
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(records), pa.string()), pa.array(marks, pa.bool_()), records], names=["file", "first", "record"])
                continue
            marks = np.zeros(len(records), bool)
            marks[0] = first
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(records), pa.string()), pa.array(marks), records], names=["file", "first", "record"])

    return lines.join(inside, ["file", "start"], "left").select("file", "start", "line", "inside").mapInArrow(run, schema)


def _cut_records(ranges: DataFrame) -> DataFrame:
    """``(file, first, record)`` of the records that begin in one range and end in a later one."""
    ends_inside = (F.col("inside").cast("int") + F.col("odd")) % 2 == 1
    piece = lambda begins, text, place: F.struct(F.lit(begins).alias("begins"), F.lit(place).alias("place"), text.alias("text"))
    pieces = ranges.select(
        "file", "start", "tail_first",
        F.explode(F.array_compact(F.array(
            F.when(F.col("inside"), piece(False, F.col("head"), 0)),
            F.when(ends_inside & (F.col("odd") > 0), piece(True, F.col("tail"), 1)),
        ))).alias("p"),
    )
    so_far = Window.partitionBy("file").orderBy("start", "p.place").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("record", F.sum(F.col("p.begins").cast("int")).over(so_far))
    whole = F.array_sort(F.collect_list(F.struct("start", "p.place", "p.text", "tail_first", "p.begins")))
    joined = numbered.groupBy("file", "record").agg(whole.alias("w"))
    long = F.exists("w", lambda x: x["text"].isNull())
    return joined.select(
        "file",
        (F.element_at("w", 1)["begins"] & F.element_at("w", 1)["tail_first"] & (F.element_at("w", 1)["start"] == 0)).alias("first"),
        F.when(long, F.raise_error(F.concat(F.lit("a quoted value without an end, or longer than it may be, in "), F.col("file"))).cast("string"))
        .otherwise(F.array_join(F.transform("w", lambda x: x["text"]), "\n")).alias("record"),
    )


def _fields(record: Column, names: Sequence[str]) -> Column:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return F.from_csv(record, schema.toDDL(), _OPTIONS)


def read_records(spark: SparkSession, path: str | list[str], names: Sequence[str], glob: str = "*.csv") -> DataFrame:
    """All columns as text, and ``file``, of CSV files whose quoted values may hold line breaks.

    Files are read twice and never moved; only records over the end of a range are put together
    apart. Every file begins with a header, which must match ``names``. Lines of white space between
    records are left out; a carriage return before a line end outside quotes is part of the line
    end. An odd number of quotes in a file is an error.
    """
    lines = read_lines(spark, path, glob)
    ranges = materialise(with_state(quote_ranges(lines)), "ranges")
    open_end = ranges.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").select("file").first()
    if open_end is not None:
        raise ValueError(f"{open_end['file']}: a quoted value without an end")
    records = _whole_records(lines, ranges).unionByName(_cut_records(ranges))
    # The line reader leaves the carriage return of the last line end; values end with a quote.
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.trim(F.col("record"), F.lit(" \t\r\n\x0b\f")) != "")
    parsed = records.select("file", "first", _fields(F.col("record"), names).alias("r"))
    matches = reduce(lambda a, b: a & b, [F.trim(F.col("r")[n]).eqNullSafe(F.lit(n)) for n in names])
    wrong = F.raise_error(F.concat(F.lit("the header does not match, in "), F.col("file"))).cast("boolean")
    return parsed.where(F.when(~F.col("first"), True).when(matches, False).otherwise(wrong)).select(*[F.col("r")[n].alias(n) for n in names], "file")


ship_with_tasks(__name__)
