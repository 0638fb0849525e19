"""Scaling, assignment, summary, labels, silhouette and the K-Means fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import round_mean
from tablewright.operators import cluster as clusters
from tablewright.operators.kmeans import fit_kmeans
from tablewright.session import materialise
from tablewright.workload.tables import Query, half_even, half_up, table

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
SCALED = tuple(f"{c}_z" for c in FEATURES)
# One centre per corner of interest, in scaled coordinates.
CENTERS = ((-1.0, -0.8, 0.5, 0.0), (0.9, 1.2, 0.1, -0.6), (0.4, -0.2, -1.0, 1.1), (0.0, 0.1, 1.2, 0.9))
MEANS = {
    "avg_discount": "l_discount", "avg_price": "l_extendedprice", "avg_tax": "l_tax",
    "avg_quantity": "l_quantity",
}
LABELS = (
    ("avg_discount", "Best Price"), ("avg_price", "High Value"), ("avg_tax", "High Tax"),
    ("avg_quantity", "Bulk"),
)


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *FEATURES)
    return clusters.fit_scaler(lines, FEATURES).transform(lines)


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.assign_clusters(_scaled(spark, folder), SCALED, CENTERS)


def zscore_features(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder).select(
        "l_orderkey", "l_linenumber", *[round_mean(c, 6).alias(c) for c in SCALED]
    )


def assign_fixed_centers(spark: SparkSession, folder: str) -> DataFrame:
    return _clustered(spark, folder).select("l_orderkey", "l_linenumber", *FEATURES, "cluster")


def cluster_summary(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_summary(_clustered(spark, folder), MEANS, count_name="lines")


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_sizes(_clustered(spark, folder))


def cluster_argmax(spark: SparkSession, folder: str) -> DataFrame:
    summary = cluster_summary(spark, folder)
    return clusters.cluster_argmax(summary, list(MEANS)).select("metric", "cluster")


def cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    summary = cluster_summary(spark, folder)
    return clusters.label_clusters(summary, LABELS, "Standard")


def _event_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Events around three fixed points of value and user."""
    events = table(spark, folder, "events").select(
        "event_id", (F.col("value") / 100).alias("v"), (F.col("user_id") / 100.0).alias("u")
    )
    return clusters.assign_clusters(events, ["v", "u"], EVENT_CENTERS)


EVENT_CENTERS = ((0.2, 0.2), (0.3, 0.8), (1.5, 0.5))


def silhouette_sample(spark: SparkSession, folder: str) -> DataFrame:
    scored = clusters.silhouette(
        _event_clusters(spark, folder), ["v", "u"], sample_size=10_000, identity=["event_id"]
    )
    return scored.select("points", round_mean("silhouette", 4).alias("silhouette"))


def silhouette_all(spark: SparkSession, folder: str) -> DataFrame:
    """All events, per cluster and, without a cluster, together."""
    scored = clusters.squared_silhouette(_event_clusters(spark, folder), ["v", "u"])
    return scored.select("cluster", "points", round_mean("silhouette", 4).alias("silhouette"))


def cluster_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = _event_clusters(spark, folder)
    return clusters.cluster_points(rows, ["v", "u"], 3_000, identity=["event_id"])


def kmeans_best_of_n(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*FEATURES)
    scaler = clusters.fit_scaler(lines, FEATURES)
    fit = fit_kmeans(scaler.transform(lines), SCALED, k=4, starts=10)
    assigned = clusters.assign_clusters(lines, [scaler.scaled(c) for c in FEATURES], fit.centers)
    summary = clusters.cluster_summary(materialise(assigned, "clustered"), MEANS, count_name="lines")
    return clusters.label_clusters(summary, LABELS, "Standard")


def kmeans_separated(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines on a feature with four far groups: the best partition is known."""
    quarter = F.floor((F.col("l_quantity") - 1) / 12.5)
    lines = table(spark, folder, "lineitem").select("l_quantity", (quarter * 1000 + F.col("l_discount") * 10).alias("x"))
    fit = fit_kmeans(lines, ["x"], k=4, starts=5)
    assigned = clusters.assign_clusters(lines, ["x"], fit.centers)
    return assigned.groupBy("cluster").agg(
        F.count("*").alias("lines"), round_mean(F.avg("l_quantity"), 2).alias("avg_quantity")
    )


_SCALED_SQL = """
    stats AS (
        SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + """
        FROM lineitem
    ), scaled AS (
        SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"{c}, ({c} - m_{c}) / s_{c} AS {c}_z" for c in FEATURES) + """
        FROM lineitem, stats
    )"""


def _distance(center: tuple[float, ...], columns: tuple[str, ...]) -> str:
    return " + ".join(
        f"({c} - ({x})::DOUBLE) * ({c} - ({x})::DOUBLE)" for c, x in zip(columns, center)
    )


def _nearest_sql(k: int) -> str:
    whens = "".join(
        f" WHEN d{i} <= least({', '.join(f'd{j}' for j in range(i + 1, k))}) THEN {i}"
        for i in range(k - 1)
    )
    return f"CASE{whens} ELSE {k - 1} END"


_CLUSTERED_SQL = _SCALED_SQL + f""",
    distances AS (
        SELECT *, {', '.join(f'{_distance(c, SCALED)} AS d{i}' for i, c in enumerate(CENTERS))}
        FROM scaled
    ), clustered AS (
        SELECT *, {_nearest_sql(len(CENTERS))} AS cluster FROM distances
    ), summary AS (
        SELECT cluster, count(*) AS lines,
            {', '.join(f'{half_even(f"avg({c})")} AS {name}' for name, c in MEANS.items())}
        FROM clustered GROUP BY cluster
    )"""

_LEADERS_SQL = _CLUSTERED_SQL + ", leaders AS (" + " UNION ALL ".join(f"""
        (SELECT '{m}' AS metric, {i} AS priority, cluster, '{label}' AS label
         FROM summary ORDER BY {m} DESC NULLS LAST, cluster LIMIT 1)"""
    for i, (m, label) in enumerate(LABELS)) + ")"

_EVENTS_SQL = f"""
    points AS (
        SELECT event_id, value / 100 AS v, user_id / 100.0::DOUBLE AS u FROM events
    ), distances AS (
        SELECT *, {', '.join(f"{_distance(c, ('v', 'u'))} AS d{i}" for i, c in enumerate(EVENT_CENTERS))}
        FROM points
    ), clustered AS (
        SELECT event_id, v, u, {_nearest_sql(len(EVENT_CENTERS))} AS cluster FROM distances
    )"""

QUERIES = {
    "zscore_features": Query(zscore_features, f"""
        WITH {_SCALED_SQL}
        SELECT l_orderkey, l_linenumber, {', '.join(f'{half_up(c, 6)} AS {c}' for c in SCALED)}
        FROM scaled"""),
    "assign_fixed_centers": Query(assign_fixed_centers, f"""
        WITH {_CLUSTERED_SQL}
        SELECT l_orderkey, l_linenumber, {', '.join(FEATURES)}, cluster FROM clustered"""),
    "cluster_summary": Query(cluster_summary, f"WITH {_CLUSTERED_SQL} SELECT * FROM summary"),
    "cluster_sizes": Query(cluster_sizes, f"""
        WITH {_CLUSTERED_SQL} SELECT cluster, lines AS games FROM summary"""),
    "cluster_argmax": Query(cluster_argmax, f"""
        WITH {_LEADERS_SQL} SELECT metric, cluster FROM leaders"""),
    "cluster_labels": Query(cluster_labels, f"""
        WITH {_LEADERS_SQL}
        SELECT s.*, coalesce((SELECT max_by(label, priority) FROM leaders l
            WHERE l.cluster = s.cluster), 'Standard') AS label
        FROM summary s"""),
    "silhouette_sample": Query(silhouette_sample, f"""
        WITH {_EVENTS_SQL}, sample AS (
            SELECT * FROM clustered
            ORDER BY md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')) LIMIT 10000
        ), sizes AS (
            SELECT cluster, count(*) AS n FROM sample GROUP BY cluster
        ), sums AS (
            SELECT a.event_id, a.cluster AS own, b.cluster AS other,
                sum(sqrt((a.v - b.v) * (a.v - b.v) + (a.u - b.u) * (a.u - b.u))) AS total
            FROM sample a, sample b GROUP BY ALL
        ), scores AS (
            SELECT event_id, max(n) FILTER (own = other) AS own_size,
                sum(total / (n - 1)) FILTER (own = other AND n > 1) AS inner_mean,
                min(total / n) FILTER (own <> other) AS outer_mean
            FROM sums JOIN sizes ON other = cluster GROUP BY event_id
        )
        SELECT count(*) AS points, {half_up('''avg(CASE WHEN own_size > 1
            AND greatest(inner_mean, outer_mean) > 0
            THEN (outer_mean - inner_mean) / greatest(inner_mean, outer_mean) ELSE 0 END)''', 4)}
            AS silhouette
        FROM scores"""),
    "silhouette_all": Query(silhouette_all, f"""
        WITH {_EVENTS_SQL}, sizes AS (
            SELECT cluster, count(*) AS n FROM clustered GROUP BY cluster
        ), sums AS (
            SELECT a.event_id, a.cluster AS own, b.cluster AS other,
                sum((a.v - b.v) * (a.v - b.v) + (a.u - b.u) * (a.u - b.u)) AS total
            FROM clustered a, clustered b GROUP BY ALL
        ), scores AS (
            SELECT event_id, own, max(n) FILTER (own = other) AS own_size,
                sum(total / (n - 1)) FILTER (own = other AND n > 1) AS inner_mean,
                min(total / n) FILTER (own <> other) AS outer_mean
            FROM sums JOIN sizes ON other = cluster GROUP BY event_id, own
        )
        SELECT own AS cluster, count(*) AS points, {half_up('''avg(CASE WHEN own_size > 1
            AND greatest(inner_mean, outer_mean) > 0
            THEN (outer_mean - inner_mean) / greatest(inner_mean, outer_mean) ELSE 0 END)''', 4)}
            AS silhouette
        FROM scores GROUP BY ROLLUP (own)"""),
    "cluster_points": Query(cluster_points, f"""
        WITH {_EVENTS_SQL}
        SELECT v, u, cluster FROM clustered
        QUALIFY row_number() OVER (PARTITION BY cluster
            ORDER BY md5(concat_ws('|', CAST(event_id AS VARCHAR), '42'))) <= 3000"""),
    "kmeans_best_of_n": Query(kmeans_best_of_n, None),
    "kmeans_separated": Query(kmeans_separated, f"""
        SELECT CAST(floor((l_quantity - 1) / 12.5) AS INTEGER) AS cluster, count(*) AS lines,
            {half_up("avg(l_quantity)")} AS avg_quantity
        FROM lineitem GROUP BY 1"""),
}
