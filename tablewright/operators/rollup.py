"""Group rollups: one at a time, or several from one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import round_mean
from tablewright.session import materialise


@dataclass(frozen=True)
class Metric:
    """One aggregate of a rollup; build it with the functions below."""

    name: str
    kind: str
    column: str | None = None
    digits: int = 2

    def over_rows(self) -> Column:
        """The aggregate over plain rows."""
        if self.kind == "count":
            value = F.count("*")
        elif self.kind == "count_true":
            value = F.count_if(F.col(self.column))
        elif self.kind == "mean":
            value = round_mean(F.avg(self.column), self.digits)
        elif self.kind == "stddev":
            value = round_mean(F.stddev_samp(self.column), self.digits)
        else:
            raise ValueError(f"unknown metric kind: {self.kind}")
        return value.alias(self.name)

    def partials(self) -> dict[str, Column]:
        """Sums that can be added up again, by column name."""
        if self.kind == "count":
            return {"__rows": F.count("*")}
        if self.kind == "count_true":
            return {f"__true_{self.column}": F.count_if(F.col(self.column))}
        if self.kind == "mean":
            return {
                f"__sum_{self.column}": F.sum(F.col(self.column).cast("double")),
                f"__count_{self.column}": F.count(self.column),
            }
        raise ValueError(f"{self.kind} cannot be combined from partial sums")

    def over_partials(self) -> Column:
        """The aggregate over rows made by :meth:`partials`."""
        if self.kind == "count":
            value = F.sum("__rows")
        elif self.kind == "count_true":
            value = F.sum(f"__true_{self.column}")
        elif self.kind == "mean":
            present = F.sum(f"__count_{self.column}")
            value = round_mean(
                F.when(present > 0, F.sum(f"__sum_{self.column}") / present), self.digits
            )
        else:
            raise ValueError(f"{self.kind} cannot be combined from partial sums")
        return value.alias(self.name)


def row_count(name: str) -> Metric:
    return Metric(name, "count")


def count_true(name: str, column: str) -> Metric:
    return Metric(name, "count_true", column)


def mean(name: str, column: str, digits: int = 2) -> Metric:
    return Metric(name, "mean", column, digits)


def stddev(name: str, column: str, digits: int = 4) -> Metric:
    """Sample standard deviation; null for a group of one row."""
    return Metric(name, "stddev", column, digits)


@dataclass(frozen=True)
class Rollup:
    """A named table: one row per value of ``key`` (null is a value)."""

    name: str
    key: str
    metrics: tuple[Metric, ...]


def rollup(df: DataFrame, spec: Rollup) -> DataFrame:
    """One rollup. Every metric has a partial form, so a hot key costs one row per task."""
    return df.groupBy(spec.key).agg(*[m.over_rows() for m in spec.metrics])


def _combined(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    partials: dict[str, Column] = {}
    for metric in metrics:
        partials.update(metric.partials())
    return df.groupBy(*dict.fromkeys(keys)).agg(
        *[c.alias(name) for name, c in partials.items()]
    )


# Above this share of distinct key combinations among the rows, their table would save little.
COMBINED_SHARE = 0.25


def combination_share(df: DataFrame, keys: Sequence[str]) -> float:
    """Estimated number of distinct combinations of ``keys``, divided by the rows; one row is returned."""
    parts = [part for key in keys for part in (F.col(key), F.col(key).isNull())]
    row = df.agg(F.approx_count_distinct(F.xxhash64(*parts)).alias("n"), F.count("*").alias("rows")).first()
    return row["n"] / row["rows"] if row["rows"] else 0.0


def _grouping_sets(df: DataFrame, specs: Sequence[Rollup]) -> dict[str, DataFrame]:
    """All rollups from one aggregate over grouping sets: a row per task and value of each key is shuffled."""
    keys = list(dict.fromkeys(s.key for s in specs))
    partials: dict[str, Column] = {}
    for metric in (m for s in specs for m in s.metrics):
        partials.update(metric.partials())
    levels = df.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("__level"), *[c.alias(name) for name, c in partials.items()]
    )
    base = materialise(levels, "levels")
    everything = (1 << len(keys)) - 1
    level = {key: everything ^ (1 << (len(keys) - 1 - i)) for i, key in enumerate(keys)}
    return {
        s.name: base.where(F.col("__level") == level[s.key]).groupBy(s.key).agg(*[m.over_partials() for m in s.metrics])
        for s in specs
    }


def rollups_in_one_pass(df: DataFrame, specs: Sequence[Rollup],
                        combined_share: float = COMBINED_SHARE) -> dict[str, DataFrame]:
    """All rollups from a single aggregate over ``df``.

    A first pass over the keys estimates how many combinations of them there are, so ``df`` should
    be a written table. Up to ``combined_share`` of the rows, the rows are reduced to one row per
    combination; that table is written once and each rollup adds its rows up. Above, that
    table would be about as large as ``df``: the rollups are then one aggregate over grouping sets,
    which is written once and has one row per value of each key. Both give the same rows.
    """
    keys = [s.key for s in specs]
    if combination_share(df, list(dict.fromkeys(keys))) > combined_share:
        return _grouping_sets(df, specs)
    base = materialise(_combined(df, keys, [m for s in specs for m in s.metrics]), "combinations")
    return {
        s.name: base.groupBy(s.key).agg(*[m.over_partials() for m in s.metrics]) for s in specs
    }


def stacked_rollup(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """The same metrics for several keys as one table ``(rollup, key, metrics...)``.

    As above, but as one lazy plan: the combinations are fanned out per key, not the rows.
    """
    fan_out = F.explode(F.array(*[
        F.struct(F.lit(k).alias("rollup"), F.col(k).cast("string").alias("key")) for k in keys
    ]))
    return (
        _combined(df, keys, metrics)
        .withColumn("__level", fan_out)
        .groupBy(F.col("__level.rollup").alias("rollup"), F.col("__level.key").alias("key"))
        .agg(*[m.over_partials() for m in metrics])
    )
