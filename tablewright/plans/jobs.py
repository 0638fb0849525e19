"""The jobs, in the order in which they run. Each reads folders and writes folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import cluster as clusters
from tablewright.operators.clean import require_values
from tablewright.operators.ids import dense_id, slice_of, surrogate_id
from tablewright.operators.kmeans import fit_kmeans
from tablewright.operators.ordering import top_k
from tablewright.operators.quality import fingerprint, key_violations, profile, row_counts, same_rows
from tablewright.operators.rollup import rollups_in_one_pass
from tablewright.operators.sizing import expected_bytes
from tablewright.plans import games
from tablewright.session import materialise, scratch_tables, sized_shuffles
from tablewright.sinks.contracts import apply_contract
from tablewright.sinks.files import export_counted, export_csv, write_all, write_jdbc, write_json, write_parquet
from tablewright.sources.csv import EMPTY_ONLY, PANDAS_TOKENS, Quarantine, UnreadableError, read_csv_text, text_profile, typed
from tablewright.sources.manifest import file_manifest, folder_bytes
from tablewright.sources.records import measured_lines
from tablewright.sources.tables import JdbcServer
from tablewright.streaming import (
    BATCH,
    process_increments,
    read_increments,
    recorded_progress,
    stage_increments,
)


@dataclass(frozen=True)
class Layout:
    """Folders below one root."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def ingest(spark: SparkSession, source: str, layout: Layout,
           schema: T.StructType = games.RAW_SCHEMA, run: str = "latest") -> DataFrame | None:
    """Land every CSV of a folder as text and write one profile record per file.

    Returns the profile, or None if the folder holds no CSV file.
    """
    with scratch_tables(spark):
        manifest = materialise(file_manifest(spark, source), "manifest")
        if manifest.isEmpty():
            return None
        names = schema.fieldNames()
        landing = layout.path("raw", "landed", f"run={run}")
        write_parquet(read_csv_text(spark, source, names, multi_line=None), landing, "overwrite", "source_file")

        landed = spark.read.parquet(landing)
        measured = profile(
            typed(landed, schema, PANDAS_TOKENS).select("source_file", *names), ["source_file"]
        ).drop("nulls").join(text_profile(landed, schema, PANDAS_TOKENS), "source_file")
        record = manifest.join(measured, F.col("file") == F.col("source_file"), "left").select(
            "file",
            F.current_timestamp().alias("ingestion_ts"),
            F.col("path").alias("raw_path"),
            "size_mb",
            "md5",
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("columns", F.array(*[F.lit(n) for n in names])).alias("columns"),
            F.coalesce(
                "nulls", F.create_map(*[x for n in names for x in (F.lit(n), F.lit(0).cast("long"))])
            ).alias("nulls"),
            F.coalesce("duplicates", F.lit(0)).alias("duplicates"),
            F.coalesce("unreadable", F.create_map().cast("map<string,bigint>")).alias("unreadable"),
            F.lit("SUCCESS").alias("status"),
        )
        log = layout.path("raw", "ingestion_log")
        with sized_shuffles(spark, folder_bytes(spark, source, "*.csv")):
            write_json(record, log)
    return spark.read.schema(record.schema).json(log)


def load_raw(spark: SparkSession, source: str, layout: Layout,
             dense_ids: bool = False, on_unreadable: str = "fail", glob: str = "*.csv") -> DataFrame:
    """Recreate the raw table, with an id column, from CSV.

    Ids are unique; ``dense_ids`` makes them 1..n at the price of one more copy of the rows.
    Values that do not fit their column are written to ``raw/rejected``: with ``fail`` there is
    then no table but an error, with ``quarantine`` the table lacks their rows, with ``null`` it
    has nulls for them. Files that fit ``glob`` are read; compressed ones by the end of their name.
    """
    path = layout.path("raw", "table")
    names = games.RAW_SCHEMA.fieldNames()
    with scratch_tables(spark):
        text = read_csv_text(spark, source, names, glob, multi_line=None)
        checked = Quarantine(text, games.RAW_SCHEMA, PANDAS_TOKENS, on_unreadable)
        write_parquet(dense_id(checked.rows) if dense_ids else surrogate_id(checked.rows), path)
        try:
            checked.settle(layout.path("raw", "rejected"))
        except UnreadableError:
            _delete(spark, path)
            raise
    return spark.read.parquet(path)


def batch(spark: SparkSession, source: str, layout: Layout,
          on_unreadable: str = "fail", glob: str = "*.csv") -> dict[str, DataFrame]:
    """Clean, derive, roll up and enrich; writes the processed and the curated tables.

    The raw files, those that fit ``glob``, are parsed once, after a pass over their lines that tells
    how much text they hold: tasks and shuffle are cut for it, also of compressed files. The feature table is written before it is used, since the
    rollups, the statistics and the join all read it. Values that do not fit their column are
    written to ``curated/rejected``; ``on_unreadable`` as in :func:`load_raw`, and with ``fail``
    nothing else is written.
    """
    names = games.RAW_SCHEMA.fieldNames()
    with scratch_tables(spark):
        files = folder_bytes(spark, source, glob)
        with sized_shuffles(spark, files):
            lines = measured_lines(spark, source, glob)
        in_memory = expected_bytes(games.RAW_SCHEMA, lines.rows, lines.bytes)
        with sized_shuffles(spark, in_memory, unpacked=max(1, lines.bytes / max(1, files))):
            text = read_csv_text(spark, source, names, glob, multi_line=lines.breaks)
            checked = Quarantine(text, games.RAW_SCHEMA, EMPTY_ONLY, on_unreadable)
            features = materialise(games.add_features(games.clean_games(checked.rows)), "features")
            checked.settle(layout.path("curated", "rejected"))
        write_all(rollups_in_one_pass(features, games.ROLLUPS), layout.path("curated"))
        processed = layout.path("processed")
        write_parquet(games.enrich_games(features), processed)
        written = spark.read.parquet(processed)
        if not same_rows(features, written):
            raise RuntimeError("the enrichment changed the number of rows")
    tables = {r.name: spark.read.parquet(layout.path("curated", r.name)) for r in games.ROLLUPS}
    return {"processed": written, **tables}


def increments(spark: SparkSession, layout: Layout, n: int = 5,
               bytes_per_trigger: int = 64 * 1024**3) -> DataFrame:
    """Replay the processed table in ``n`` increments and return the progress table.

    A micro-batch takes at most ``bytes_per_trigger`` of files. Feed and output belong to the
    fingerprint of their rows: a repeated run continues the same feed and adds nothing, and a
    processed table with other rows makes a new feed. The output is published last, when it was
    found to hold exactly the rows of the feed; :func:`increment_output` reads it.
    """
    rows = spark.read.parquet(layout.path("processed"))
    # Rows that are equal in the columns of the feed may differ elsewhere: slice by all.
    identity = [c for c in rows.columns if c in games.RAW_SCHEMA.fieldNames()]
    sliced = rows.withColumn(BATCH, slice_of(n, *identity)).select(*games.INCREMENT_INPUT, BATCH)
    schema = T.StructType([
        *[rows.schema[c] for c in games.INCREMENT_INPUT], T.StructField(BATCH, T.IntegerType()),
    ])
    mark = fingerprint(sliced)
    feed, target = layout.path("stream", f"feed-{mark}"), layout.path("stream", f"output-{mark}")
    if not _exists(spark, feed):
        stage_increments(sliced, feed, n, slice_column=F.col(BATCH), mode="overwrite")
    process_increments(
        spark, feed, schema, target, games.flag_increment, bytes_per_trigger=bytes_per_trigger, increments=n
    )
    output = read_increments(spark, target)
    same = [c for c in sliced.columns if c in output.columns]
    if fingerprint(sliced.select(*same)) != fingerprint(output.select(*same)):
        raise RuntimeError("the output does not hold the rows of the processed table")
    write_parquet(spark.createDataFrame([(target,)], "path string"), layout.path("stream", "current"))
    return recorded_progress(spark, target)


def increment_output(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows of the last run of :func:`increments` that succeeded."""
    target = spark.read.parquet(layout.path("stream", "current")).first()["path"]
    return read_increments(spark, target)


def marts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Publish the typed marts; returns their row counts."""
    published = {}
    for name, (source, contract) in games.MARTS.items():
        table = apply_contract(spark.read.parquet(layout.path("curated", source)), contract)
        if not key_violations(table, contract.key).isEmpty():
            raise ValueError(f"{name}: {contract.key} is null or not unique")
        path = layout.path("marts", name)
        write_parquet(table, path)
        published[name] = spark.read.parquet(path)
    return row_counts(published)


def publish(spark: SparkSession, layout: Layout, server: JdbcServer) -> None:
    """Drop and recreate the raw table and the marts in a database."""
    raw = spark.read.parquet(layout.path("raw", "table"))
    write_jdbc(raw, server, "games_raw")
    for name, (_, contract) in games.MARTS.items():
        table = spark.read.parquet(layout.path("marts", name))
        write_jdbc(table, server, name, column_types=contract.jdbc_column_types())


def most_profitable(spark: SparkSession, layout: Layout, k: int = 5) -> DataFrame:
    """The ``k`` providers with the highest average profitability, nulls first."""
    stats = spark.read.parquet(layout.path("marts", "provider_stats"))
    return top_k(stats, "avg_profitability", k, "provider", nulls_first=True).select(
        "provider", "total_games", "avg_rtp", "avg_profitability"
    )


def export(spark: SparkSession, layout: Layout, rows_per_file: int | None = None) -> DataFrame:
    """CSV of every mart, one file each, and of the raw table, many files.

    Returns the raw table's progress, counted while it was written; also in ``exports/progress``.
    """
    for name in games.MARTS:
        export_csv(
            spark.read.parquet(layout.path("marts", name)),
            layout.path("exports", name), single_file=True,
        )
    steps = export_counted(
        spark.read.parquet(layout.path("raw", "table")),
        layout.path("exports", "games_raw"), rows_per_file=rows_per_file,
    )
    write_parquet(steps, layout.path("exports", "progress"))
    return spark.read.parquet(layout.path("exports", "progress"))


def cluster(spark: SparkSession, layout: Layout, k: int = 4, starts: int = 10,
            seed: int = 42, sample_size: int = 10_000) -> dict[str, DataFrame]:
    """Cluster the raw table; writes rows, summary and chart data.

    Works on the raw values: no text is normalised and no null is filled.
    """
    raw = spark.read.parquet(layout.path("raw", "table"))
    features = list(games.CLUSTER_FEATURES)
    rows = require_values(raw, features, ["id", *games.CLUSTER_COLUMNS])
    scaler = clusters.fit_scaler(rows, features)
    scaled = [f"{c}_z" for c in features]
    fit = fit_kmeans(scaler.transform(rows).select(*scaled), scaled, k, seed, starts)
    with scratch_tables(spark):
        assigned = materialise(
            clusters.assign_clusters(rows, [scaler.scaled(c) for c in features], fit.centers),
            "clustered",
        )
        summary = clusters.label_clusters(
            clusters.cluster_summary(assigned, games.CLUSTER_MEANS),
            games.CLUSTER_LABELS, games.CLUSTER_LABEL_DEFAULT,
        )
        quality = clusters.silhouette(
            scaler.transform(assigned), scaled, sample_size=sample_size, seed=seed, identity=["id"]
        )
        results = {
            "summary": summary,
            "silhouette": quality,
            "silhouette_all": clusters.squared_silhouette(scaler.transform(assigned), scaled),
            "points": clusters.cluster_points(
                assigned, ["rtp", "max_win"], seed=seed, identity=["id"]
            ),
        }
        write_all(results, layout.path("clusters"))
        export_csv(
            assigned.select(*games.CLUSTER_COLUMNS, "cluster"),
            layout.path("exports", "games_with_clusters"),
        )
    return {name: spark.read.parquet(layout.path("clusters", name)) for name in results}


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _exists(spark: SparkSession, path: str) -> bool:
    """True if a finished write left its marker in ``path``."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)
