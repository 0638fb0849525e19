"""The game-catalogue preset over order lines in the shape of game records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import cluster as clusters
from tablewright.operators.clean import require_values
from tablewright.operators.ids import slice_of
from tablewright.operators.ordering import ranked, top_k
from tablewright.operators.quality import key_violations, row_counts
from tablewright.operators.rollup import rollup, rollups_in_one_pass
from tablewright.plans import games, jobs
from tablewright.session import materialise, scratch_tables, workspace
from tablewright.sinks.contracts import apply_contract
from tablewright.sinks.files import export_csv
from tablewright.sources.csv import read_csv
from tablewright.workload.tables import (
    CLEAN_GAMES,
    FEATURE_GAMES,
    GAMES,
    Query,
    game_rows,
    half_even,
    half_up,
)


def games_clean(spark: SparkSession, folder: str) -> DataFrame:
    return games.clean_games(game_rows(spark, folder))


def games_features(spark: SparkSession, folder: str) -> DataFrame:
    return games.add_features(games_clean(spark, folder))


def games_processed(spark: SparkSession, folder: str) -> DataFrame:
    return games.enrich_games(materialise(games_features(spark, folder), "features"))


def games_sample_columns(spark: SparkSession, folder: str) -> DataFrame:
    return games_processed(spark, folder).select(*games.SAMPLE_COLUMNS)


def games_conservation(spark: SparkSession, folder: str) -> DataFrame:
    """Rows before and after the enrichment, and after the split into increments."""
    features = materialise(games_features(spark, folder), "features")
    enriched = games.enrich_games(features)
    sliced = features.withColumn("slice", slice_of(5, *games.RAW_SCHEMA.fieldNames()))
    parts = [sliced.where(F.col("slice") == i) for i in range(5)]
    return row_counts({
        "features": features, "enriched": enriched, "increments": reduce(DataFrame.unionByName, parts),
    })


def _mart(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        source, agreed = games.MARTS[name]
        return apply_contract(_curated(source)(spark, folder), agreed)

    return run


def games_mart_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Null or repeated keys per mart."""
    features = materialise(games_features(spark, folder), "features")
    tables = rollups_in_one_pass(features, games.ROLLUPS)
    return row_counts({
        name: key_violations(apply_contract(tables[source], agreed), agreed.key)
        for name, (source, agreed) in games.MARTS.items()
    })


def _curated(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spec = next(r for r in games.ROLLUPS if r.name == name)
        return rollup(games_features(spark, folder), spec)

    return run


def _basic(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spec = next(r for r in games.BASIC_ROLLUPS if r.name == name)
        return rollup(games_features(spark, folder), spec)

    return run


ROLLUP_METRICS = ("total_games", "avg_rtp", "avg_max_win", "avg_profitability", "jackpot_games", "avg_max_multiplier")


def _stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """The five curated tables below each other, with all metrics; a table lacks some."""
    return reduce(DataFrame.unionByName, [
        tables[spec.name].select(
            F.lit(spec.name).alias("rollup"), F.col(spec.key).alias("key"),
            *[F.col(m) if m in tables[spec.name].columns else F.lit(None).cast("bigint" if m == "jackpot_games" else "double").alias(m)
              for m in ROLLUP_METRICS],
        ) for spec in games.ROLLUPS
    ])


def games_rollups_shared_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The five curated tables from one pass."""
    features = materialise(games_features(spark, folder), "features")
    return _stacked(rollups_in_one_pass(features, games.ROLLUPS))


# Compressed CSV input of the jobs: rows of one file, which one task reads, and the files' names.
INPUT_ROWS, PACKED = 100_000, "*.csv.gz"


def _job_input(spark: SparkSession, folder: str, packed: bool = True) -> tuple[jobs.Layout, str]:
    """Game records as CSV files, and the folders of the jobs; plain files for digests, else ``packed``."""
    layout = jobs.Layout(workspace(spark))
    source = layout.path("input")
    with scratch_tables(spark):
        _write_input(game_rows(spark, folder), source, packed)
    return layout, source


def _write_input(rows: DataFrame, source: str, packed: bool = True) -> None:
    export_csv(rows, source, **({"compression": "gzip", "rows_per_file": INPUT_ROWS, "fast": True} if packed else {}))


def games_job_processed(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table as the batch job wrote it."""
    layout, source = _job_input(spark, folder)
    jobs.batch(spark, source, layout, glob=PACKED)
    return spark.read.parquet(layout.path("processed"))


def games_job_curated(spark: SparkSession, folder: str) -> DataFrame:
    """The five curated tables as the batch job wrote them."""
    layout, source = _job_input(spark, folder)
    jobs.batch(spark, source, layout, glob=PACKED)
    return _stacked({r.name: spark.read.parquet(layout.path("curated", r.name)) for r in games.ROLLUPS})


def games_job_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table as the load job wrote it, without its ids, and whether those differ."""
    layout, source = _job_input(spark, folder)
    raw = jobs.load_raw(spark, source, layout, dense_ids=True, glob=PACKED)
    ids = raw.agg((F.count_distinct("id") == F.count("*")).alias("distinct"), F.max("id").alias("last")).first()
    written = spark.read.parquet(layout.path("raw", "table")).drop("id")
    return written.withColumn("distinct_ids", F.lit(ids["distinct"])).withColumn("last_id", F.lit(ids["last"]).cast("bigint"))


def games_job_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, files and texts of the landed table against the records that the ingest wrote."""
    layout, source = _job_input(spark, folder, packed=False)
    jobs.ingest(spark, source, layout)
    landed = spark.read.parquet(layout.path("raw", "landed"))
    return landed.groupBy("provider", "country_availability").agg(
        F.count("*").alias("games"), F.count("jackpot").alias("jackpots"), F.min("game").alias("first_game"), F.max("last_updated").alias("last_day"))


def games_job_ingest_record(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the records of all ingested files; duplicates count within a file, so they are left out."""
    layout, source = _job_input(spark, folder, packed=False)
    record = jobs.ingest(spark, source, layout)
    return record.agg(
        F.sum("rows").alias("rows"), F.count_if(F.length("md5") == 32).cast("bigint").alias("digests"), F.count("*").alias("files"),
        *[F.sum(F.col("nulls")[c]).alias(f"null_{c}") for c in ("provider", "volatility", "jackpot", "free_spins_feature", "max_multiplier")],
        F.sum(F.size("unreadable")).cast("bigint").alias("unreadable"),
    ).withColumn("digests", F.col("digests") == F.col("files")).drop("files")


def games_job_export(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table's export, read back."""
    layout, source = _job_input(spark, folder)
    jobs.load_raw(spark, source, layout, glob=PACKED)
    export_csv(spark.read.parquet(layout.path("raw", "table")), layout.path("exports", "games_raw"), rows_per_file=10_000)
    schema = T.StructType([T.StructField("id", T.LongType()), *games.RAW_SCHEMA.fields])
    return read_csv(spark, layout.path("exports", "games_raw"), schema).drop("id")


def games_job_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """The clustered export as the cluster job wrote it, without the clusters' numbers."""
    layout, source = _job_input(spark, folder)
    jobs.load_raw(spark, source, layout, glob=PACKED)
    jobs.cluster(spark, layout, starts=1)
    kinds = {f.name: f for f in games.RAW_SCHEMA.fields}
    schema = T.StructType([*(kinds[c] for c in games.CLUSTER_COLUMNS), T.StructField("cluster", T.IntegerType())])
    rows = read_csv(spark, layout.path("exports", "games_with_clusters"), schema)
    return rows.withColumn("cluster", F.col("cluster").between(0, 3))


def games_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable values of game records, as the load job sets them apart, and what it keeps."""
    layout = jobs.Layout(workspace(spark))
    source = layout.path("input")
    with scratch_tables(spark):
        rows = game_rows(spark, folder).withColumn("rtp", F.when(F.col("country_availability") == "P", "high").otherwise(F.col("rtp").cast("string")))
        rows = rows.withColumn("release_year", F.when(F.col("currency") == "O", F.concat(F.col("release_year").cast("string"), F.lit(" AD"))).otherwise(F.col("release_year").cast("string")))
        _write_input(rows, source)
    raw = jobs.load_raw(spark, source, layout, on_unreadable="quarantine", glob=PACKED)
    rejected = spark.read.parquet(layout.path("raw", "rejected"))
    return rejected.groupBy("column", "text").agg(F.count("*").alias("cells"), F.min(F.get_json_object("row", "$.game")).alias("first_game")).unionByName(
        raw.agg(F.lit("kept").alias("column"), F.lit(None).cast("string").alias("text"), F.count("*").alias("cells"), F.min("game").alias("first_game")))


def games_top_providers(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_curated("by_provider")(spark, folder), "total_games", 10, "provider")


def games_most_profitable(spark: SparkSession, folder: str) -> DataFrame:
    stats = _curated("by_provider")(spark, folder)
    return top_k(stats, "avg_profitability", 5, "provider", nulls_first=True).select(
        "provider", "total_games", "avg_rtp", "avg_profitability"
    )


def games_batch_job(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job from CSV files to the curated provider table."""
    layout, source = _job_input(spark, folder)
    tables = jobs.batch(spark, source, layout, glob=PACKED)
    return ranked(tables["by_provider"], "total_games", "provider")


def games_increments(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that the incremental job wrote; increments are numbered by a hash, so without their number."""
    layout = jobs.Layout(workspace(spark))
    games_processed(spark, folder).write.parquet(layout.path("processed"))
    jobs.increments(spark, layout, 5)
    return jobs.increment_output(spark, layout).withColumn("stream_batch", F.col("stream_batch").between(0, 4))


# One point per profile, in raw units.
CENTERS = ((99.0, 20000.0, 3000.0, 0.2), (96.0, 90000.0, 6000.0, 0.3),
           (95.0, 55000.0, 12000.0, 0.5), (91.0, 5000.0, 500.0, 1.2))


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    rows = require_values(
        game_rows(spark, folder), games.CLUSTER_FEATURES, list(games.CLUSTER_COLUMNS)
    )
    return clusters.assign_clusters(rows, games.CLUSTER_FEATURES, CENTERS)


def games_with_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _clustered(spark, folder)


def games_cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    summary = clusters.cluster_summary(_clustered(spark, folder), games.CLUSTER_MEANS)
    return clusters.label_clusters(summary, games.CLUSTER_LABELS, games.CLUSTER_LABEL_DEFAULT)


_PROCESSED_SQL = f"""
    WITH {FEATURE_GAMES}, stats AS (
        SELECT provider, {half_up('avg(rtp)')} AS provider_avg_rtp,
            count(*) AS provider_total_games,
            {half_up('stddev_samp(rtp)', 4)} AS provider_rtp_stddev,
            {half_up('avg(profitability_score)')} AS provider_avg_profitability
        FROM features GROUP BY provider
    )
    SELECT f.*, s.provider_avg_rtp, s.provider_total_games, s.provider_rtp_stddev,
        s.provider_avg_profitability, {half_up('rtp - provider_avg_rtp')} AS rtp_vs_provider_avg
    FROM features f LEFT JOIN stats s ON f.provider = s.provider"""

_PROVIDER_SQL = f"""
    SELECT provider, count(*) AS total_games, {half_up('avg(rtp)')} AS avg_rtp,
        {half_up('avg(max_win)')} AS avg_max_win,
        {half_up('avg(profitability_score)')} AS avg_profitability,
        CAST(sum(CASE WHEN has_jackpot THEN 1 ELSE 0 END) AS BIGINT) AS jackpot_games
    FROM features GROUP BY provider"""


def _group_sql(key: str, *columns: str) -> str:
    parts = "".join(f", {c}" for c in columns)
    return f"WITH {FEATURE_GAMES} SELECT {key}, count(*) AS total_games{parts} FROM features GROUP BY {key}"


_RTP = f"{half_up('avg(rtp)')} AS avg_rtp"
_WIN = f"{half_up('avg(max_win)')} AS avg_max_win"


def _distance(center: tuple[float, ...]) -> str:
    return " + ".join(
        f"({c} - {x}::DOUBLE) * ({c} - {x}::DOUBLE)" for c, x in zip(games.CLUSTER_FEATURES, center)
    )


_CLUSTERED_SQL = f"""
    {GAMES}, distances AS (
        SELECT *, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(CENTERS))}
        FROM games
        WHERE rtp IS NOT NULL AND max_win IS NOT NULL AND max_multiplier IS NOT NULL
            AND min_bet IS NOT NULL
    ), clustered AS (
        SELECT {', '.join(games.CLUSTER_COLUMNS)},
            CASE WHEN d0 <= least(d1, d2, d3) THEN 0 WHEN d1 <= least(d2, d3) THEN 1
                WHEN d2 <= d3 THEN 2 ELSE 3 END AS cluster
        FROM distances
    )"""

_SUMMARY_SQL = f"""{_CLUSTERED_SQL}, summary AS (
        SELECT cluster, count(*) AS games,
            {', '.join(f'{half_even(f"avg({c})")} AS {n}' for n, c in games.CLUSTER_MEANS.items())}
        FROM clustered GROUP BY cluster
    )"""

def _mart_sql(name: str) -> str:
    source, agreed = games.MARTS[name]
    casts = ", ".join(
        f.name if f.max_length else f"CAST({f.name} AS {f.type.simpleString().upper()}) AS {f.name}"
        for f in agreed.fields
    )
    return f"SELECT {casts} FROM ({_CURATED_SQL[source]})"


_CURATED_SQL = {
    "by_provider": f"WITH {FEATURE_GAMES} {_PROVIDER_SQL}",
    "by_game_type": _group_sql(
        "game_type", _RTP, f"{half_up('avg(max_multiplier)', 0)} AS avg_max_multiplier"),
    "by_volatility": _group_sql("volatility", _RTP, _WIN),
    "by_rtp_category": _group_sql("rtp_category", _WIN),
    "by_bet_tier": _group_sql("bet_tier", _RTP),
}

def _stacked_sql(name: str, key: str) -> str:
    metrics = {
        "avg_rtp": half_up("avg(rtp)"), "avg_max_win": half_up("avg(max_win)"), "avg_profitability": half_up("avg(profitability_score)"),
        "jackpot_games": "CAST(sum(CASE WHEN has_jackpot THEN 1 ELSE 0 END) AS BIGINT)", "avg_max_multiplier": half_up("avg(max_multiplier)", 0),
    }
    own = {m.name for r in games.ROLLUPS if r.name == name for m in r.metrics}
    none = {"jackpot_games": "CAST(NULL AS BIGINT)"}
    columns = ", ".join(f"{sql if m in own else none.get(m, 'CAST(NULL AS DOUBLE)')} AS {m}" for m, sql in metrics.items())
    return f"SELECT '{name}' AS rollup, {key} AS key, count(*) AS total_games, {columns} FROM features GROUP BY {key}"


QUERIES = {
    "games_clean": Query(games_clean, f"WITH {CLEAN_GAMES} SELECT * FROM clean"),
    "games_features": Query(games_features, f"WITH {FEATURE_GAMES} SELECT * FROM features"),
    "games_processed": Query(games_processed, _PROCESSED_SQL),
    "games_sample_columns": Query(games_sample_columns, f"""
        SELECT {', '.join(games.SAMPLE_COLUMNS)} FROM ({_PROCESSED_SQL})"""),
    "games_conservation": Query(games_conservation, f"WITH {FEATURE_GAMES} " + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS \"rows\" FROM features"
        for t in ("features", "enriched", "increments"))),
    **{f"games_{name}": Query(_curated(name), sql) for name, sql in _CURATED_SQL.items()},
    **{f"games_mart_{name}": Query(_mart(name), _mart_sql(name)) for name in games.MARTS},
    "games_mart_violations": Query(games_mart_violations, f"WITH {FEATURE_GAMES} " + " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(DISTINCT coalesce({agreed.key}, '-')) "
        f"- count(DISTINCT {agreed.key}) AS \"rows\" FROM features"
        for name, (_, agreed) in games.MARTS.items())),
    "games_basic_by_provider": Query(_basic("by_provider"), _group_sql("provider", _RTP, _WIN)),
    "games_basic_by_game_type": Query(_basic("by_game_type"), _group_sql("game_type", _RTP)),
    "games_basic_by_volatility": Query(_basic("by_volatility"), _group_sql("volatility")),
    "games_basic_by_rtp_category": Query(_basic("by_rtp_category"), _group_sql("rtp_category")),
    "games_rollups_shared_scan": Query(
        games_rollups_shared_scan,
        f"WITH {FEATURE_GAMES} " + " UNION ALL ".join(
            _stacked_sql(r.name, r.key) for r in games.ROLLUPS
        ),
    ),
    "games_job_curated": Query(games_job_curated, f"WITH {FEATURE_GAMES} " + " UNION ALL ".join(
        _stacked_sql(r.name, r.key) for r in games.ROLLUPS)),
    "games_job_processed": Query(games_job_processed, _PROCESSED_SQL),
    "games_job_raw": Query(games_job_raw, f"""
        WITH {GAMES} SELECT *, true AS distinct_ids, (SELECT count(*) FROM games) AS last_id FROM games"""),
    "games_job_landed": Query(games_job_landed, f"""
        WITH {GAMES} SELECT provider, country_availability, count(*) AS games, count(jackpot) AS jackpots,
            min(game) AS first_game, max(last_updated) AS last_day
        FROM games GROUP BY provider, country_availability"""),
    "games_job_ingest_record": Query(games_job_ingest_record, f"""
        WITH {GAMES} SELECT count(*) AS "rows", true AS digests,
            {', '.join(f"count(*) - count({c}) AS null_{c}" for c in ('provider', 'volatility', 'jackpot', 'free_spins_feature', 'max_multiplier'))},
            CAST(0 AS BIGINT) AS unreadable
        FROM games"""),
    "games_job_export": Query(games_job_export, f"WITH {GAMES} SELECT * FROM games"),
    "games_job_clusters": Query(games_job_clusters, f"""
        WITH {GAMES} SELECT {', '.join(games.CLUSTER_COLUMNS)}, true AS cluster FROM games
        WHERE rtp IS NOT NULL AND max_win IS NOT NULL AND max_multiplier IS NOT NULL AND min_bet IS NOT NULL"""),
    "games_rejected": Query(games_rejected, f"""
        WITH {GAMES}, cells AS (
            SELECT 'rtp' AS "column", 'high' AS text, game FROM games WHERE country_availability = 'P'
            UNION ALL
            SELECT 'release_year', release_year || ' AD', game FROM games WHERE currency = 'O'
        )
        SELECT "column", text, count(*) AS cells, min(game) AS first_game FROM cells GROUP BY ALL
        UNION ALL
        SELECT 'kept', NULL, count(*), min(game) FROM games WHERE country_availability <> 'P' AND currency <> 'O'"""),
    "games_top_providers": Query(games_top_providers, f"""
        WITH {FEATURE_GAMES} {_PROVIDER_SQL}
        ORDER BY total_games DESC, provider NULLS FIRST LIMIT 10"""),
    "games_most_profitable": Query(games_most_profitable, f"""
        WITH {FEATURE_GAMES}, stats AS ({_PROVIDER_SQL})
        SELECT provider, total_games, avg_rtp, avg_profitability FROM stats
        ORDER BY avg_profitability DESC NULLS FIRST, provider NULLS FIRST LIMIT 5"""),
    "games_batch_job": Query(games_batch_job, f"WITH {FEATURE_GAMES} {_PROVIDER_SQL}"),
    "games_increments": Query(games_increments, f"""
        WITH {FEATURE_GAMES}
        SELECT provider, game_type, rtp, rtp_category AS rtp_flag, has_jackpot, player_friendly,
            has_jackpot AND player_friendly AS is_premium, profitability_score, true AS stream_batch
        FROM features"""),
    "games_with_clusters": Query(games_with_clusters, f"""
        WITH {_CLUSTERED_SQL} SELECT * FROM clustered"""),
    "games_cluster_labels": Query(games_cluster_labels, f"""
        WITH {_SUMMARY_SQL}, leaders AS (""" + " UNION ALL ".join(f"""
            (SELECT {i} AS priority, cluster, '{label}' AS label FROM summary
             ORDER BY {m} DESC NULLS LAST, cluster LIMIT 1)"""
        for i, (m, label) in enumerate(games.CLUSTER_LABELS)) + """)
        SELECT s.*, coalesce((SELECT max_by(label, priority) FROM leaders l
            WHERE l.cluster = s.cluster), 'Standard Games') AS label
        FROM summary s"""),
}
