"""K-Means from several starts that share every pass over the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import session_settings, ship_with_tasks

ship_with_tasks(__name__)

# A start's reach is this many of its last moves, and at most this share of the least distance of its centres.
MOVES_AHEAD = 6.0
NEAR_BORDER = 0.1
# Points per core from which passes over the open rows alone pay for keeping these; below, a pass
# over all rows takes hardly longer than the start of a job.
SPLIT_FROM = 2_000_000
BLOCK_ROWS = 10_000
# A record is a block of points, so few make a batch; the aggregates are of a few rows.
PASS_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}


@dataclass(frozen=True)
class Clustering:
    """Centres of the best start and the cost (sum of squared distances) of every start."""

    centers: tuple[tuple[float, ...], ...]
    cost: float
    costs: tuple[float, ...]
    passes: int


def _gaps(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances from every centre to every point: shape (starts, k, rows)."""
    starts, k, width = centers.shape
    # Distances do not change when all move; near the origin the products keep their digits.
    origin = centers.mean(axis=(0, 1))
    near, goals = points - origin, (centers - origin).reshape(starts * k, width)
    gaps = (near**2).sum(axis=1) - 2 * goals @ near.T + (goals**2).sum(axis=1)[:, None]
    return np.maximum(gaps, 0).reshape(starts, k, len(points))


def _nearest(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centre; the first of equal ones. Shapes (starts, rows)."""
    nearest, least = np.zeros(gaps[:, 0].shape, dtype=np.int64), gaps[:, 0]
    for j in range(1, gaps.shape[1]):
        nearest[gaps[:, j] < least] = j
        least = np.minimum(least, gaps[:, j])
    return nearest, least


def _add_up(nearest: np.ndarray, points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Rows and coordinate sums of each cluster of one start: shape (k, 1 + d)."""
    columns = [weights, *(points.T * weights)]
    return np.column_stack([np.bincount(nearest, c, minlength=k) for c in columns])


def _tally(points: np.ndarray, weights: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Rows, coordinate sums and cost per start and cluster: shape (starts, k, 1 + d + 1)."""
    starts, k, width = centers.shape
    nearest, least = _nearest(_gaps(points, centers))
    tally = np.zeros((starts, k, width + 2))
    for s in range(starts):
        tally[s, :, :-1] = _add_up(nearest[s], points, weights, k)
        tally[s, :, -1] = np.bincount(nearest[s], least[s] * weights, minlength=k)
    return tally


def _settled(points: np.ndarray, centers: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every point, and whether it stays that while no centre moves further than ``reach``."""
    gaps = _gaps(points, centers[None])[0]
    nearest = gaps.argmin(axis=0)
    rows = np.arange(len(points))
    least = np.sqrt(gaps[nearest, rows])
    gaps[nearest, rows] = np.inf
    second = np.sqrt(gaps.min(axis=0))
    # The margin of a rounding error keeps rows at the limit open.
    return nearest, second - least > 2 * reach + 1e-6 * (1 + least)


def _moved(tally: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Means of the clusters; an empty cluster keeps its centre."""
    rows = tally[:, :, :1]
    return np.where(rows > 0, tally[:, :, 1:] / np.maximum(rows, 1), centers)


def _chance(points: np.ndarray, seed: int) -> np.ndarray:
    """A number in (0, 1) for every row that depends only on its values and the seed."""
    state = np.full(len(points), seed, np.uint64)
    for column in points.T:
        # Adding 0.0 makes the two zeros one.
        state = (state ^ (column + 0.0).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        state = (state ^ (state >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        state ^= state >> np.uint64(32)
    return ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _starting_centers(points: DataFrame, width: int, k: int, seed: int, starts: int) -> np.ndarray:
    """One set of ``k`` rows per start, drawn from all rows; ``k`` passes that all starts share.

    Each next row is drawn with a chance that grows with its squared distance to those drawn
    before: the row with the least exponential waiting time wins, and the time comes from a hash
    of the row's values, so the draw does not depend on the partitioning.
    """
    chosen = np.empty((starts, 0, width))
    schema = ", ".join(["start long", "wait double", *[f"c{i} double" for i in range(width)]])
    for step in range(k):
        def draw(batches: Iterator[pa.RecordBatch], chosen=chosen, step=step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _points(batch, width + 1)[:, :-1]
                if not len(rows):
                    continue
                best = []
                for start in range(starts):
                    wait = -np.log(_chance(rows, (seed * 1_000_003 + start) * 1_009 + step))
                    if step:
                        gaps = ((rows[:, None] - chosen[start]) ** 2).sum(axis=2).min(axis=1)
                        with np.errstate(divide="ignore"):
                            wait = wait / gaps
                    least = int(wait.argmin())
                    best.append((start, wait[least], *rows[least]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b[0]) for b in best]), *[pa.array([float(b[i]) for b in best]) for i in range(1, width + 2)]],
                    names=["start", "wait", *[f"c{i}" for i in range(width)]],
                )

        drawn = points.mapInArrow(draw, schema).groupBy("start").agg(F.min(F.struct("wait", *[f"c{i}" for i in range(width)])).alias("best"))
        rows = {r["start"]: list(r["best"])[1:] for r in drawn.collect()}
        chosen = np.concatenate([chosen, np.array([[rows[s]] for s in range(starts)])], axis=1)
    return chosen


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _pack(rows: DataFrame) -> DataFrame:
    """The numbers of a table as blocks of 8-byte floats, row by row.

    A pass then moves a few large values from the JVM to Python instead of every number.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                block = _matrix(batch.slice(first, BLOCK_ROWS)).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

    return rows.mapInArrow(pack, "block binary")


def _points(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows of the blocks of a batch."""
    blocks = [np.frombuffer(b.as_buffer(), np.float64) for b in batch.column(0)]
    return np.concatenate(blocks or [np.empty(0)]).reshape(-1, width)


def _slots(tally: np.ndarray, slots: np.ndarray) -> pa.RecordBatch:
    """Rows ``slot, t0, t1, ...`` of a matrix."""
    return pa.RecordBatch.from_arrays(
        [pa.array(slots), *[pa.array(np.ascontiguousarray(c)) for c in tally.T]],
        names=["slot", *[f"t{i}" for i in range(tally.shape[1])]],
    )


def _schema(width: int) -> str:
    return ", ".join(["slot long", *[f"t{i} double" for i in range(width)]])


def _collected(totals: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """Sums by slot, one row per centre, as an array."""
    names = [f"t{i}" for i in range(shape[2])]
    result = np.zeros((shape[0] * shape[1], shape[2]))
    for row in totals.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).collect():
        result[row["slot"]] = [row[n] for n in names]
    return result.reshape(shape)


def _one_pass(points: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The tally of all rows: each task adds up its own, Spark adds up the tasks."""
    starts, k, width = centers.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((starts, k, width + 2))
        for batch in batches:
            rows = _points(batch, width + 1)
            tally += _tally(rows[:, :-1], rows[:, -1], centers)
        yield _slots(tally.reshape(starts * k, width + 2), np.arange(starts * k))

    return _collected(points.mapInArrow(add_up, _schema(width + 2)), (starts, k, width + 2))


def _split_pass(points: DataFrame, centers: np.ndarray, reach: dict[int, float]) -> DataFrame:
    """For each start of ``reach``: its tally of the rows that cannot change their centre within that reach, and the others.

    Slots from 0 are sums (rows, coordinates) of settled rows by start and cluster; slot -1 - start
    has a block of that start's open rows.
    """
    starts, k, width = centers.shape

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((starts, k, width + 1))
        for batch in batches:
            rows = _points(batch, width + 1)
            for s, most in reach.items():
                nearest, fast = _settled(rows[:, :-1], centers[s], most)
                tally[s] += _add_up(nearest[fast], rows[fast, :-1], rows[fast, -1], k)
                if not fast.all():
                    unknown = _slots(np.zeros((1, width + 1)), np.array([-1 - s]))
                    yield unknown.append_column("block", pa.array([rows[~fast].tobytes()], pa.binary()))
        sums = _slots(tally.reshape(starts * k, width + 1), np.arange(starts * k))
        yield sums.append_column("block", pa.nulls(starts * k, pa.binary()))

    return points.mapInArrow(split, _schema(width + 1) + ", block binary")


def _open_pass(rows: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The tally, without costs, of open rows."""
    starts, k, width = centers.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((starts, k, width + 1))
        for batch in batches:
            for slot, block in zip(batch["slot"].to_pylist(), batch["block"]):
                rows, s = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width + 1), -1 - slot
                nearest, _ = _nearest(_gaps(rows[:, :-1], centers[s : s + 1]))
                tally[s] += _add_up(nearest[0], rows[:, :-1], rows[:, -1], k)
        yield _slots(tally.reshape(starts * k, width + 1), np.arange(starts * k))

    return _collected(rows.select("slot", "block").mapInArrow(add_up, _schema(width + 1)), (starts, k, width + 1))


class _Lloyd:
    """Passes of Lloyd's algorithm that leave out rows which cannot change their centre.

    When a start's centres move little, one pass over all rows sums up those that stay with their
    centre while no centre moves further than a reach of several such moves, and keeps the others,
    which lie near a border. Until a centre leaves the reach, only the others are read again.
    The labels are those of a pass over all rows.
    """

    def __init__(self, points: DataFrame, centers: np.ndarray, tolerance: float, split: bool) -> None:
        starts, k, width = centers.shape
        self.points, self.centers, self.tolerance, self.split = points, centers, tolerance, split
        self.moving = np.ones(starts, dtype=bool)
        self.moves = np.full(starts, np.inf)
        self.anchors, self.reach = centers.copy(), np.full(starts, -1.0)
        self.settled = np.zeros((starts, k, width + 1))
        self.tables: dict[int, DataFrame] = {}

    def step(self) -> None:
        """Move the centres of all starts that still move."""
        tally = np.zeros_like(self.settled)
        drift = np.sqrt(((self.centers - self.anchors) ** 2).sum(axis=2)).max(axis=1)
        far = self.moving & (drift > self.reach)
        self._split(np.flatnonzero(far & self._slow()))
        wide = far & (self.reach < 0)
        if wide.any():
            tally[wide] = _one_pass(self.points, self.centers[wide])[:, :, :-1]
        near = np.flatnonzero(self.moving & ~wide)
        if len(near):
            tally[near] = self.settled[near] + self._open(near)[near]
        moved = np.where(self.moving[:, None, None], _moved(tally, self.centers), self.centers)
        squares = ((moved - self.centers) ** 2).sum(axis=2)
        self.moves = np.sqrt(squares.max(axis=1))
        self.centers = moved
        self.moving &= squares.sum(axis=1) > self.tolerance
        self._drop()

    def _slow(self) -> np.ndarray:
        """Starts whose reach is small beside the distance of their centres; others forget theirs."""
        gaps = ((self.centers[:, :, None] - self.centers[:, None]) ** 2).sum(axis=3)
        gaps[:, np.arange(gaps.shape[1]), np.arange(gaps.shape[1])] = np.inf
        if not self.split:
            return np.zeros(len(self.moves), dtype=bool)
        slow = MOVES_AHEAD * self.moves <= NEAR_BORDER * np.sqrt(gaps.min(axis=(1, 2)))
        self.reach[self.moving & ~slow] = -1
        return slow

    def _split(self, starts: np.ndarray) -> None:
        if not len(starts):
            return
        self.anchors[starts], self.reach[starts] = self.centers[starts], MOVES_AHEAD * self.moves[starts]
        table = _split_pass(self.points, self.centers, {int(s): float(self.reach[s]) for s in starts})
        table = table.persist(StorageLevel.MEMORY_AND_DISK)
        self.settled[starts] = _collected(table.where("slot >= 0"), self.settled.shape)[starts]
        for s in starts:
            self.tables[int(s)] = table

    def _open(self, starts: np.ndarray) -> np.ndarray:
        own: dict[int, tuple[DataFrame, list[int]]] = {}
        for s in starts:
            own.setdefault(id(self.tables[s]), (self.tables[s], []))[1].append(int(-1 - s))
        rows = reduce(DataFrame.unionByName, [t.where(F.col("slot").isin(slots)) for t, slots in own.values()])
        return _open_pass(rows.coalesce(self.points.sparkSession.sparkContext.defaultParallelism), self.centers)

    def _drop(self, everything: bool = False) -> None:
        """Free the open rows that no moving start needs."""
        before = {id(t): t for t in self.tables.values()}
        self.tables = {s: t for s, t in self.tables.items() if not everything and self.moving[s] and self.reach[s] >= 0}
        for table in before.keys() - {id(t) for t in self.tables.values()}:
            before[table].unpersist()

    def close(self) -> None:
        self._drop(everything=True)


def fit_kmeans(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 42,
               starts: int = 10, max_iter: int = 300, tolerance: float = 1e-4) -> Clustering:
    """Lloyd's algorithm from ``starts`` starts; the start with the lowest cost wins.

    One pass over the rows moves the centres of all starts that still move, so ten starts
    cost as many passes as the slowest one, not the sum. A pass returns one row per centre.
    Equal rows become one weighted point where they halve the table, and rows that cannot change
    their centre are left out of passes; see :class:`_Lloyd`.
    A start is done when the squared moves of its centres sum up to ``tolerance`` or less.
    Rows must have no null in ``features``. Starts are drawn from all rows, and the centres are
    numbered by their coordinates, so the result does not depend on the partitioning.

    Only the features and the open rows are kept, in memory and then on local disk; a lost block is
    computed again from ``df``.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows, points = _prepared(df, features, cores)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    lloyd = None
    try:
        points.count()
        with session_settings(df.sparkSession, PASS_SETTINGS):
            centers = _starting_centers(points, len(features), k, seed, starts)
            lloyd = _Lloyd(points, centers, tolerance, split=rows >= SPLIT_FROM * cores)
            passes = 0
            while lloyd.moving.any() and passes < max_iter:
                lloyd.step()
                passes += 1
            centers = lloyd.centers
            costs = _one_pass(points, centers)[:, :, -1].sum(axis=1)
    finally:
        if lloyd is not None:
            lloyd.close()
        points.unpersist()
    best = int(costs.argmin())
    return Clustering(
        tuple(sorted(tuple(float(x) for x in c) for c in centers[best])),
        float(costs[best]),
        tuple(float(c) for c in costs),
        passes + 1,
    )


def _prepared(df: DataFrame, features: Sequence[str], cores: int) -> tuple[int, DataFrame]:
    """Number and blocks of the points; equal rows are one, with a weight, if that halves them."""
    names = [f"c{i}" for i in range(len(features))]
    points = df.select(*[(F.col(c).cast("double") + 0.0).alias(n) for c, n in zip(features, names)])
    found = points.agg(F.count("*").alias("rows"), F.approx_count_distinct(F.xxhash64(*names)).alias("kinds")).first()
    if found["rows"] == 0:
        raise ValueError("no rows to cluster")
    if found["kinds"] <= found["rows"] / 2:
        return found["kinds"], _pack(points.groupBy(*names).agg(F.count("*").cast("double").alias("weight")))
    if points.rdd.getNumPartitions() < cores:
        points = points.repartition(cores)
    return found["rows"], _pack(points.withColumn("weight", F.lit(1.0)))
