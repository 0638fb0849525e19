"""Scaling, assignment, silhouette, summary and labels of clusters."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import round_mean
from tablewright.operators.ordering import stable_sample
from tablewright.session import ship_with_tasks

ship_with_tasks(__name__)

Point = Sequence[float]

# Points whose distances to the whole sample a task holds at a time.
_BLOCK = 64


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations of some columns."""

    means: Mapping[str, float]
    spreads: Mapping[str, float]

    def scaled(self, column: str) -> Column:
        """z-score; a constant column becomes 0."""
        spread = self.spreads[column] or 1.0
        return (F.col(column) - F.lit(self.means[column])) / F.lit(spread)

    def transform(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": self.scaled(c) for c in self.means})


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregate over all columns; one row reaches the driver."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaler(
        {c: row[f"m{i}"] for i, c in enumerate(columns)},
        {c: row[f"s{i}"] for i, c in enumerate(columns)},
    )


def nearest_center(features: Sequence[str | Column], centers: Sequence[Point]) -> Column:
    """Number of the closest centre; the lower number wins a tie."""
    values = [F.col(f) if isinstance(f, str) else f for f in features]

    def distance(center: Point) -> Column:
        parts = [(v - F.lit(float(x))) * (v - F.lit(float(x))) for v, x in zip(values, center)]
        return reduce(lambda a, b: a + b, parts)

    candidates = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]
    nearest = candidates[0] if len(candidates) == 1 else F.least(*candidates)
    return nearest["i"]


def assign_clusters(df: DataFrame, features: Sequence[str | Column], centers: Sequence[Point],
                    name: str = "cluster") -> DataFrame:
    """Add the nearest centre's number; a plain projection."""
    return df.withColumn(name, nearest_center(features, centers))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster; sort the few rows when reading them."""
    return df.groupBy(cluster).agg(F.count("*").alias("games"))


def cluster_summary(df: DataFrame, means: Mapping[str, str], cluster: str = "cluster",
                    count_name: str = "games") -> DataFrame:
    """Rows and means (name -> column, half-even to 2 digits) per cluster."""
    return df.groupBy(cluster).agg(
        F.count("*").alias(count_name),
        *[round_mean(F.avg(c), 2, half_even=True).alias(name) for name, c in means.items()],
    )


def cluster_argmax(summary: DataFrame, metrics: Sequence[str],
                   cluster: str = "cluster") -> DataFrame:
    """``(metric, priority, cluster)``: the cluster with the largest value of each metric."""
    best = summary.agg(*[
        F.max_by(cluster, F.when(F.col(m).isNotNull(), F.struct(F.col(m), -F.col(cluster)))).alias(m)
        for m in metrics
    ])
    return best.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(i).alias("priority"), F.col(m).alias(cluster))
        for i, m in enumerate(metrics)
    ])))


def label_clusters(summary: DataFrame, rules: Sequence[tuple[str, str]], default: str,
                   cluster: str = "cluster") -> DataFrame:
    """Add ``label``: the label of the last metric in ``rules`` that the cluster leads.

    ``summary`` has k rows, one per cluster: one aggregate gathers them with the leaders of all
    metrics, so what the summary is made of is read once.
    """
    leaders = [
        F.max_by(cluster, F.when(F.col(m).isNotNull(), F.struct(F.col(m), -F.col(cluster)))).alias(f"__leader_{i}")
        for i, (m, _) in enumerate(rules)
    ]
    whole = summary.agg(F.collect_list(F.struct(*summary.columns)).alias("__rows"), *leaders)
    rows = whole.select(F.explode("__rows").alias("__row"), *[f"__leader_{i}" for i in range(len(rules))])
    label = F.coalesce(
        *[F.when(F.col(f"__row.{cluster}") == F.col(f"__leader_{i}"), F.lit(rules[i][1])) for i in reversed(range(len(rules)))],
        F.lit(default),
    )
    return rows.select("__row.*", label.alias("label"))


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster",
               sample_size: int = 10_000, seed: int = 42,
               identity: Sequence[str] | None = None) -> DataFrame:
    """Mean Euclidean silhouette of a random sample, ``(points, silhouette)``.

    The sample, ``sample_size`` small rows, is sent to every task; each task takes its
    share of the points and adds up their distances per cluster in blocks, so no table of
    pairs exists. A point alone in its cluster scores 0; fewer than two clusters give null.
    """
    spark = df.sparkSession
    columns = [*features, cluster]
    keep = list(dict.fromkeys([*(identity or columns), *columns]))
    sample = stable_sample(df.select(*keep), sample_size, identity or columns, seed)
    points = sample.select(*columns).toPandas()
    shared = spark.sparkContext.broadcast(points.to_numpy(dtype="float64"))
    width = len(features)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        everyone = shared.value
        members, labels = everyone[:, :width], everyone[:, width]
        names, own_column, sizes = np.unique(labels, return_inverse=True, return_counts=True)
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                numbers = batch["point"].to_numpy()[at:at + _BLOCK]
                block = members[numbers]
                gaps = np.sqrt(((block[:, None, :] - members[None, :, :]) ** 2).sum(axis=2))
                sums = np.stack([gaps[:, own_column == j].sum(axis=1) for j in range(len(names))], axis=1)
                own = own_column[numbers]
                rows = np.arange(len(numbers))
                own_size = sizes[own]
                inner = sums[rows, own] / np.maximum(own_size - 1, 1)
                outer = sums / sizes
                outer[rows, own] = np.inf
                outer = outer.min(axis=1)
                widest = np.maximum(inner, outer)
                value = np.where((own_size > 1) & (widest > 0), (outer - inner) / np.where(widest > 0, widest, 1), 0.0)
                yield pd.DataFrame({"s": value})

    if len(points) == 0 or points[cluster].nunique() < 2:
        return spark.range(1).select(
            F.lit(len(points)).cast("long").alias("points"), F.lit(None).cast("double").alias("silhouette")
        )
    scored = (
        spark.range(len(points)).withColumnRenamed("id", "point")
        .mapInPandas(score, "s double")
    )
    return scored.agg(F.count("*").alias("points"), F.avg("s").alias("silhouette"))


def squared_silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean squared-Euclidean silhouette of all rows, ``(cluster, points, silhouette)``.

    The mean squared distance of a point to the members of a cluster is its squared distance to
    their mean plus their variance, so one aggregate per cluster and one pass over the rows score
    every row without pairs. The row with a null ``cluster`` is the whole table. A point alone in
    its cluster scores 0, as does one without any distance; fewer than two clusters give null.
    Rows without a cluster or with a null or NaN feature are no points. One row per cluster
    reaches the driver and becomes part of the second pass, as centres do in an assignment.
    """
    known = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features]
    points = df.where(reduce(lambda a, b: a & b, known, F.col(cluster).isNotNull()))
    values = [F.col(c).cast("double") for c in features]
    profile = points.groupBy(F.col(cluster).alias("c")).agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(v) for v in values]).alias("center"),
        reduce(lambda a, b: a + b, [F.var_pop(v) for v in values]).alias("spread"),
    ).collect()
    kind = df.schema[cluster].dataType
    if len(profile) < 2:
        score = F.lit(None).cast("double")
    else:
        own = F.col(cluster)
        gaps = []
        for row in sorted(profile, key=lambda r: r["c"]):
            parts = [(v - F.lit(m)) * (v - F.lit(m)) for v, m in zip(values, row["center"])]
            gaps.append((row, reduce(lambda a, b: a + b, parts) + F.lit(row["spread"])))
        inner = F.coalesce(*[
            F.when(own == F.lit(row["c"]).cast(kind), gap * F.lit(row["n"] / max(row["n"] - 1, 1))) for row, gap in gaps
        ])
        others = [F.when(own != F.lit(row["c"]).cast(kind), gap) for row, gap in gaps]
        outer = F.array_min(F.array(*others))
        alone = own.isin([F.lit(row["c"]).cast(kind) for row, _ in gaps if row["n"] == 1])
        widest = F.greatest("__inner", "__outer")
        points = points.select(cluster, inner.alias("__inner"), outer.alias("__outer"), alone.alias("__alone"))
        score = F.when(~F.col("__alone") & (widest > 0), (F.col("__outer") - F.col("__inner")) / widest).otherwise(0.0)
    return points.select(cluster, score.alias("__score")).rollup(cluster).agg(
        F.count("*").alias("points"), F.avg("__score").alias("silhouette")
    )


def cluster_points(df: DataFrame, columns: Sequence[str], per_cluster: int = 3_000,
                   seed: int = 42, cluster: str = "cluster",
                   identity: Sequence[str] | None = None) -> DataFrame:
    """Scatter-plot data: a sample of at most ``per_cluster`` rows of each cluster."""
    keep = list(dict.fromkeys([*(identity or ()), *columns, cluster]))
    return stable_sample(df.select(*keep), per_cluster, identity, seed, by=cluster).select(
        *dict.fromkeys([*columns, cluster])
    )

