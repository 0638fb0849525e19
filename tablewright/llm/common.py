"""Shared parts of the operators: bytes and words of a batch, stored tables, components.

The functions on batches are numpy over whole Arrow columns; nothing runs per word in Python.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import ship_with_tasks, workspace

# Bytes of text that a task turns into numpy arrays at once, so few that they stay in the cache;
# one longer text is a chunk alone.
CHUNK_BYTES = 1 << 18

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))


def chunks(batches: Iterable[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the column at ``text`` has about ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the offsets of its rows; null is empty."""
    kind = pa.large_binary()
    if column.null_count:
        column = pc.if_else(pc.is_valid(column), column, pa.scalar("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"", column.type))
    column = column.cast(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(column: pa.Array) -> pa.Array:
    """A string column in lower case, with as many code points; null stays null."""
    return pc.utf8_lower(column)


def folded(column: pa.Array) -> pa.Array:
    """A string column in lower case, where the letter that has two capitals is written as two."""
    return pc.replace_substring(pc.utf8_lower(column), "ß", "ss")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 1 << 16)
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.multiply.accumulate(np.full(n, _ROOT))])
            self.down = np.concatenate([one, np.multiply.accumulate(np.full(n, _INVERSE))])

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """Prefix sums from which :meth:`between` reads the hash of any substring."""
        self.reach(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * self.up[: len(symbols)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start])


def _table(true: str | None = None) -> np.ndarray:
    if true is None:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        return table
    table = np.zeros(256, bool)
    table[[ord(c) for c in true]] = True
    return table


# A-Z to a-z, and the six white space bytes.
LOWER, SPACE = _table(), _table(" \t\n\v\f\r")


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without bytes of ``gap``), and the first word of each row."""
    solid = ~gap[data]
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    if len(data):
        after[-1] = False
        after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word with A-Z lower-cased, and the first word of each row."""
    starts, ends, first = word_spans(data, offsets)
    return powers.between(powers.prefix(LOWER[data]), starts, ends), first


def shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words and the first of each row.

    A row of fewer words has its whole sequence as its only one; a row without words has none.
    """
    counts = np.diff(first)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64))
    total = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(total)])
    at = np.repeat(first[:-1] - begin[:-1], total) + np.arange(begin[-1])
    room = np.repeat(first[1:], total) - at
    value = np.full(len(at), width, np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for i in range(width):
        value += np.where(room > i, padded[at + i] * factors[i] + np.uint64(1), np.uint64(0))
    return mix(value), begin


def sampled_labels(labels: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` labelled documents ``(doc_id, y)`` at most, chosen by a hash of the id.

    A document with several labels counts once, with the largest one. The bound lets the result be
    broadcast.
    """
    clean = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    share = min(1.0, most / max(1, clean.count()))
    return clean.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


class Store:
    """Tables between two steps, below ``spark.checkpoint.dir``.

    A reader starts from files that all executors share, so a lost executor costs a re-read.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, workspace(spark)

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.folder}/{label}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(_CLEAN_UP, None)
        self.spark.conf.set(_CLEAN_UP, "true")  # what was shuffled for a stored table is not read again
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEAN_UP)
            else:
                self.spark.conf.set(_CLEAN_UP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later step reads."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(documents: DataFrame, store: Store, name: str = "__row") -> DataFrame:
    """The rows, written, with a number ``name`` of their own: ids can repeat and be null."""
    return store.put(documents.withColumn(name, F.monotonically_increasing_id()), "rows")


def components(links: DataFrame, store: Store) -> DataFrame:
    """Connected components of links ``(a, b)``: rows ``(node, component)``.

    ``component`` is the smallest node that can be reached. Nulls and loops are ignored; a node
    without links is not in the result. Each round hangs larger neighbours on the smallest one,
    then smaller ones too, so the number of rounds grows with the logarithm of the longest chain.
    Minima are pre-aggregated and the joins are equi-joins that adaptive execution can split, so
    a node with very many links is not gathered anywhere. Rounds read and write stored tables and
    end when every node has one link, to a node without one to a smaller one.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def settled(df: DataFrame) -> bool:
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("n"), F.lit(False).alias("root"))
        ends = ends.unionByName(df.select(F.col("v").alias("node"), F.lit(0).alias("n"), F.lit(True).alias("root")))
        ends = ends.groupBy("node").agg(F.sum("n").alias("n"), F.max("root").alias("root"))
        return not ends.where("n > 1 OR n = 1 AND root").agg(F.count("*")).first()[0]

    edges = store.put(ordered(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    while not settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = ordered(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        joined = wide.join(low, "u")
        narrow = ordered(joined.select("u", F.col("m").alias("v")).unionByName(joined.select(F.col("v").alias("u"), F.col("m").alias("v"))))
        after = store.put(narrow, "edges")
        store.drop(edges)
        edges = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


ship_with_tasks(__name__)
