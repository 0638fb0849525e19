"""Clustering against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import cluster as c
from tablewright.operators import kmeans
from tablewright.operators.kmeans import fit_kmeans
from tablewright.plans import games


def blobs(spark, n=1200, seed=3):
    random.seed(seed)
    spots = [(0, 0), (10, 0), (0, 10), (10, 10)]
    rows = [(i, spots[i % 4][0] + random.gauss(0, 1), spots[i % 4][1] + random.gauss(0, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, x double, y double").repartition(4)


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, y double")
    scaler = c.fit_scaler(df, ["x", "y"])
    assert scaler.means == {"x": 3.0, "y": 5.0}
    assert scaler.spreads["x"] == pytest.approx(np.std([1, 2, 6])) and scaler.spreads["y"] == 0.0
    rows = scaler.transform(df).select("x_z", "y_z").collect()
    assert sum(r["x_z"] for r in rows) == pytest.approx(0)
    assert [r["y_z"] for r in rows] == [0.0, 0.0, 0.0]


def test_nearest_center_prefers_the_lower_number(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.1,)], "x double")
    got = c.assign_clusters(df, ["x"], [(0.0,), (10.0,), (10.0,)]).collect()
    assert [r["cluster"] for r in got] == [0, 0, 1]


def test_kmeans_finds_separate_blobs(spark):
    fit = fit_kmeans(blobs(spark), ["x", "y"], k=4, starts=5)
    spots = sorted((round(x / 10) * 10, round(y / 10) * 10) for x, y in fit.centers)
    assert spots == [(0, 0), (0, 10), (10, 0), (10, 10)]
    assert fit.cost == min(fit.costs) and len(fit.costs) == 5


def test_kmeans_result_is_a_fixed_point(spark):
    df = blobs(spark)
    fit = fit_kmeans(df, ["x", "y"], k=3, starts=3, tolerance=0.0)
    rows = c.assign_clusters(df, ["x", "y"], fit.centers).toPandas()
    cost = 0.0
    for i, center in enumerate(fit.centers):
        members = rows[rows.cluster == i][["x", "y"]].to_numpy()
        assert members.mean(axis=0) == pytest.approx(center, abs=1e-9)
        cost += ((members - center) ** 2).sum()
    assert fit.cost == pytest.approx(cost)


def test_kmeans_with_a_hot_copy_and_few_distinct_points(spark):
    df = spark.createDataFrame([(1.0,)] * 400 + [(5.0,)] * 10, "x double").repartition(4)
    fit = fit_kmeans(df, ["x"], k=3, starts=2)
    assert fit.cost == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        fit_kmeans(df.limit(0), ["x"])


def brute_silhouette(points, labels):
    scores = []
    for i, (p, own) in enumerate(zip(points, labels)):
        if labels.count(own) == 1:
            scores.append(0.0)
            continue
        means = {}
        for label in set(labels):
            gaps = [math.dist(p, q) for j, (q, l) in enumerate(zip(points, labels)) if l == label and j != i]
            means[label] = sum(gaps) / len(gaps)
        inner = means.pop(own)
        outer = min(means.values())
        scores.append((outer - inner) / max(outer, inner))
    return sum(scores) / len(scores)


def test_silhouette_equals_brute_force(spark):
    df = c.assign_clusters(blobs(spark, 300), ["x", "y"], [(0.0, 0.0), (8.0, 2.0), (3.0, 9.0), (100.0, 100.0)])
    df = df.withColumn("cluster", F.when(F.col("id") == 7, 3).otherwise(F.col("cluster")))
    rows = df.collect()
    expected = brute_silhouette([(r["x"], r["y"]) for r in rows], [r["cluster"] for r in rows])
    got = c.silhouette(df, ["x", "y"], identity=["id"]).first()
    assert got["points"] == 300 and got["silhouette"] == pytest.approx(expected)
    assert c.silhouette(df, ["x", "y"], sample_size=100, identity=["id"]).first()["points"] == 100


def test_silhouette_of_one_cluster_is_null(spark):
    df = blobs(spark, 40).withColumn("cluster", F.lit(0))
    assert c.silhouette(df, ["x", "y"]).first()["silhouette"] is None


def test_squared_silhouette_equals_brute_force(spark, monkeypatch):
    df = c.assign_clusters(blobs(spark, 200), ["x", "y"], [(0.0, 0.0), (8.0, 2.0), (3.0, 9.0), (100.0, 100.0)])
    df = df.withColumn("cluster", F.when(F.col("id") == 7, 3).otherwise(F.col("cluster")))
    rows = df.collect()
    monkeypatch.setattr(math, "dist", lambda p, q: sum((a - b) ** 2 for a, b in zip(p, q)))
    expected = brute_silhouette([(r["x"], r["y"]) for r in rows], [r["cluster"] for r in rows])
    got = {r["cluster"]: r for r in c.squared_silhouette(df, ["x", "y"]).collect()}
    assert got[None]["points"] == 200 and got[None]["silhouette"] == pytest.approx(expected)
    assert got[3]["points"] == 1 and got[3]["silhouette"] == 0
    assert sum(r["points"] * r["silhouette"] for k, r in got.items() if k is not None) / 200 == pytest.approx(expected)


def test_squared_silhouette_of_edge_rows(spark):
    rows = [("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0), (None, 5.0), ("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    assert {tuple(r) for r in c.squared_silhouette(df, ["x"], "g").collect()} == {("a", 2, 0.0), ("b", 2, 0.0), (None, 4, 0.0)}
    one = c.squared_silhouette(df.where("g = 'a'"), ["x"], "g").collect()
    assert {tuple(r) for r in one} == {("a", 2, None), (None, 2, None)}
    assert [tuple(r) for r in c.squared_silhouette(df.limit(0), ["x"], "g").collect()] in ([], [(None, 0, None)])
    far = spark.range(2000).selectExpr("id % 2 AS g", "1e9 + id % 2 * 10 + id % 7 * 0.001 AS x")
    assert c.squared_silhouette(far, ["x"], "g").where("g IS NULL").first()["silhouette"] > 0.999


SUMMARY = "cluster int, avg_rtp double, avg_max_win double, avg_multiplier double, avg_min_bet double"


def labels(spark, rows):
    df = c.label_clusters(spark.createDataFrame(rows, SUMMARY), games.CLUSTER_LABELS, games.CLUSTER_LABEL_DEFAULT)
    return {r["cluster"]: r["label"] for r in df.collect()}


def test_labels(spark):
    rows = [(0, 97.0, 1.0, 1.0, 1.0), (1, 95.0, 9.0, 1.0, 1.0), (2, 95.0, 1.0, 9.0, 1.0), (3, 95.0, 1.0, 1.0, 9.0)]
    assert labels(spark, rows) == {0: "High RTP / Low Risk", 1: "High Win Potential", 2: "Mega Multiplier", 3: "High Stakes"}


def test_a_later_metric_overrides_and_ties_go_to_the_lower_number(spark):
    rows = [(0, 97.0, 5.0, 5.0, 9.0), (1, 95.0, 5.0, 5.0, 1.0), (2, 95.0, 5.0, 1.0, 1.0)]
    assert labels(spark, rows) == {0: "High Stakes", 1: "Standard Games", 2: "Standard Games"}


def test_summary_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0, 0.125), (1, 0.375)], "cluster int, x double")
    rows = c.cluster_summary(df, {"m": "x"}).orderBy("cluster").collect()
    assert [(r["games"], r["m"]) for r in rows] == [(1, 0.12), (1, 0.38)]


def test_points_are_limited_per_cluster(spark):
    df = c.assign_clusters(blobs(spark), ["x", "y"], [(0.0, 0.0), (10.0, 10.0)])
    points = c.cluster_points(df, ["x", "y"], per_cluster=50, identity=["id"])
    assert points.columns == ["x", "y", "cluster"]
    assert {r["count"] for r in points.groupBy("cluster").count().collect()} == {50}


def test_kmeans_does_not_depend_on_the_partitioning(spark):
    df = blobs(spark)
    fits = [fit_kmeans(df.repartition(n), ["x", "y"], k=4, starts=3) for n in (4, 7)]
    assert [[round(x, 6) for x in c] for c in fits[0].centers] == [[round(x, 6) for x in c] for c in fits[1].centers]


def plain_lloyd(points, weights, centers, tolerance):
    """Centres of one start by distances of all points in every pass."""
    while True:
        nearest = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([
            np.average(points[nearest == c], axis=0, weights=weights[nearest == c]) if (nearest == c).any() else centers[c]
            for c in range(len(centers))
        ])
        done = ((moved - centers) ** 2).sum() <= tolerance
        centers = moved
        if done:
            return centers


@pytest.mark.parametrize("copies", [1, 5])
def test_passes_over_open_rows_give_the_centres_of_passes_over_all(spark, monkeypatch, copies):
    """Rows without clear groups: many slow passes, so that the reach is left several times."""
    rng = np.random.default_rng(3)
    points = np.round(rng.uniform(0, 1, (3000, 2)) * [3, 1], 4)
    df = spark.createDataFrame([tuple(map(float, p)) for p in points] * copies, "x double, y double").repartition(5)
    plain = fit_kmeans(df, ["x", "y"], k=5, starts=2, tolerance=1e-8)
    splits = []
    whole = kmeans._split_pass
    monkeypatch.setattr(kmeans, "SPLIT_FROM", 0)
    monkeypatch.setattr(kmeans, "_split_pass", lambda points, centers, reach: splits.append(len(reach)) or whole(points, centers, reach))
    fit = fit_kmeans(df, ["x", "y"], k=5, starts=2, tolerance=1e-8)
    assert len(splits) > 1 and fit.passes == plain.passes
    assert np.allclose(fit.centers, plain.centers, atol=1e-9) and np.allclose(fit.costs, plain.costs)
    # A further plain run from the result stays there.
    weights = np.ones(len(points))
    again = plain_lloyd(points, weights, np.array(fit.centers), 1e-8)
    assert np.allclose(again, fit.centers, atol=1e-4)


def test_equal_rows_weigh_as_many(spark):
    """Few kinds of rows become weighted points; -0.0 and 0.0 are one."""
    rows = [(0.0,)] * 300 + [(-0.0,)] * 100 + [(1.0,)] * 100 + [(9.0,)] * 50 + [(10.0,)] * 250
    fit = fit_kmeans(spark.createDataFrame(rows, "x double"), ["x"], k=2, starts=3)
    assert np.allclose(fit.centers, [[0.2], [(9 * 50 + 10 * 250) / 300]])
    assert fit.cost == pytest.approx(500 * 0.2 * 0.8 + 300 * (1 / 6) * (5 / 6))
