"""The preset's jobs from CSV files to exports."""

import csv
import json
import os

import pytest

from tablewright.plans import games, jobs
from tablewright.sinks.files import export_csv
from tablewright.sources.csv import read_csv_text
from tablewright.sources.manifest import folder_bytes
from tablewright.sources.tables import JdbcServer
from tablewright.workload import preset

NAMES = games.RAW_SCHEMA.fieldNames()


def game(**changes):
    row = {
        "casino": "Lucky", "game": "Book", "provider": "Acme", "rtp": "96.5", "volatility": "High",
        "jackpot": "", "country_availability": "MT|UK", "min_bet": "0.1", "max_win": "5000",
        "game_type": "Slot", "game_category": "Video", "license_jurisdiction": "MGA",
        "release_year": "2020", "currency": "EUR", "mobile_compatible": "True",
        "free_spins_feature": "True", "bonus_buy_available": "False", "max_multiplier": "5000",
        "languages": "en|es", "last_updated": "2024-01-01",
    }
    return {**row, **changes}


def write_games(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, NAMES)
        writer.writeheader()
        writer.writerows(rows)


ROWS = [
    game(),
    game(game=" BOOK ", rtp="96.501"),                      # collapses into the first row
    game(jackpot="No Jackpot"),                             # and so does this one
    game(game="Gold", provider="acme ", rtp="97", jackpot="Mini", min_bet="1", max_multiplier="10000"),
    game(game="Moon", provider="Bolt", rtp="93.99", volatility="VERY HIGH", min_bet="1.01", max_multiplier=""),
    game(game="Star", provider="", rtp="94", volatility="Odd", mobile_compatible="False", game_type="Table"),
    game(game="Sun", provider="", rtp="", volatility="low", free_spins_feature="maybe", max_win="900.129"),
]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("games"))
    write_games(f"{root}/input/games.csv", ROWS)
    layout = jobs.Layout(f"{root}/tables")
    return layout, jobs.batch(spark, f"{root}/input", layout, on_unreadable="null"), f"{root}/input"


def test_processed_table(done):
    _, tables, _ = done
    rows = {r["game"]: r for r in tables["processed"].collect()}
    assert sorted(rows) == ["BOOK", "GOLD", "MOON", "STAR", "SUN"]
    assert len(tables["processed"].columns) == 31 and tables["processed"].columns[0] == "provider"
    book, gold, moon, star, sun = (rows[n] for n in ("BOOK", "GOLD", "MOON", "STAR", "SUN"))
    assert (book["rtp_category"], book["bet_tier"], book["multiplier_tier"]) == ("Medium RTP", "Low Stakes", "High Multiplier")
    assert (book["has_jackpot"], book["player_friendly"], book["profitability_score"]) == (False, True, 10.5)
    assert (gold["rtp_category"], gold["bet_tier"], gold["multiplier_tier"]) == ("High RTP", "Mid Stakes", "Mega Multiplier")
    assert gold["provider"] == "ACME" and gold["has_jackpot"] and gold["profitability_score"] == 9.0
    assert (gold["provider_avg_rtp"], gold["provider_total_games"], gold["provider_rtp_stddev"]) == (96.75, 2, 0.3536)
    assert (gold["provider_avg_profitability"], gold["rtp_vs_provider_avg"]) == (9.75, 0.25)
    assert (moon["rtp_category"], moon["bet_tier"], moon["multiplier_tier"]) == ("Low RTP", "High Stakes", "Standard Multiplier")
    assert moon["max_multiplier"] == 0.0 and moon["profitability_score"] == 24.04
    assert moon["provider_rtp_stddev"] is None and moon["provider_total_games"] == 1
    assert (star["provider"], star["provider_total_games"], star["rtp_vs_provider_avg"]) == (None, None, None)
    assert (star["player_friendly"], star["profitability_score"]) == (False, 6.0)
    assert (sun["rtp"], sun["rtp_category"], sun["profitability_score"]) == (None, "Low RTP", None)
    assert (sun["player_friendly"], sun["max_win"]) == (False, 900.13)


def test_curated_tables(done):
    _, tables, _ = done
    providers = {r["provider"]: r for r in tables["by_provider"].collect()}
    assert {k: r["total_games"] for k, r in providers.items()} == {"ACME": 2, "BOLT": 1, None: 2}
    assert providers["ACME"]["jackpot_games"] == 1 and providers["ACME"]["avg_profitability"] == 9.75
    for spec in games.ROLLUPS:
        rows = tables[spec.name].collect()
        assert sum(r["total_games"] for r in rows) == 5
        assert tables[spec.name].columns == [spec.key, *[m.name for m in spec.metrics]]


def test_marts_refuse_a_null_key(spark, done):
    layout, _, _ = done
    with pytest.raises(ValueError, match="provider_stats"):
        jobs.marts(spark, layout)


def test_increments_run_twice(spark, done):
    layout, tables, _ = done
    for _ in range(2):
        steps = jobs.increments(spark, layout, 3).orderBy("batch").collect()
        assert steps[-1]["output_rows"] == 5
    output = jobs.increment_output(spark, layout)
    assert output.columns == [
        "provider", "game_type", "rtp", "rtp_flag", "has_jackpot", "player_friendly", "is_premium",
        "profitability_score", "stream_batch",
    ]
    assert [r["rtp"] for r in output.where("is_premium").collect()] == [97.0]


def test_ingest(spark, done, tmp_path):
    _, _, source = done
    layout = jobs.Layout(str(tmp_path))
    row = jobs.ingest(spark, source, layout).first()
    assert (row["file"], row["rows"], row["duplicates"], row["status"]) == ("games.csv", 7, 0, "SUCCESS")
    assert row["columns"] == NAMES
    assert {c: n for c, n in row["nulls"].items() if n} == {
        "provider": 2, "rtp": 1, "jackpot": 5, "max_multiplier": 1,
    }
    assert row["unreadable"] == {"free_spins_feature": 1}
    landed = spark.read.parquet(layout.path("raw", "landed"))
    assert landed.where("source_file = 'games.csv'").count() == 7
    assert dict(landed.dtypes)["rtp"] == "string"
    log = [f for f in os.listdir(layout.path("raw", "ingestion_log")) if f.endswith(".json")]
    record = json.loads(open(layout.path("raw", "ingestion_log", log[0])).readline())
    assert record["md5"] == row["md5"] and record["size_mb"] == 0.0


def test_ingest_of_an_empty_folder(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    assert jobs.ingest(spark, f"{tmp_path}/in", jobs.Layout(f"{tmp_path}/out")) is None


def test_marts_export_and_clusters(spark, tmp_path, monkeypatch):
    rows = [
        game(game=f"G{i}", provider=f"P{i % 3}", rtp=str(90 + i % 10), max_win=str(1000 * (i % 17)),
             max_multiplier="" if i % 20 == 0 else str(500 * (i % 9)), min_bet=str(0.1 * (i % 12)),
             volatility=["Low", "Medium", "High", "Very High"][i % 4])
        for i in range(200)
    ]
    write_games(f"{tmp_path}/input/games.csv", rows)
    layout = jobs.Layout(f"{tmp_path}/tables")
    raw = jobs.load_raw(spark, f"{tmp_path}/input", layout)
    assert raw.columns == ["id", *NAMES] and raw.count() == 200
    dense = jobs.load_raw(spark, f"{tmp_path}/input", layout, dense_ids=True)
    assert sorted(r["id"] for r in dense.select("id").collect()) == list(range(1, 201))
    jobs.batch(spark, f"{tmp_path}/input", layout)
    counts = {r["table"]: r["rows"] for r in jobs.marts(spark, layout).collect()}
    assert counts["provider_stats"] == 3 and counts["volatility_stats"] == 4 and counts["rtp_category_stats"] == 3
    mart = spark.read.parquet(layout.path("marts", "provider_stats"))
    assert dict(mart.dtypes) == {
        "provider": "string", "total_games": "int", "avg_rtp": "decimal(6,2)",
        "avg_max_win": "decimal(12,2)", "avg_profitability": "decimal(6,2)", "jackpot_games": "int",
    }
    best = [r["avg_profitability"] for r in jobs.most_profitable(spark, layout).collect()]
    assert best == sorted(best, reverse=True) and len(best) == 3

    sent = {}
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, server, table, **kw: sent.update({table: (df.count(), kw)}))
    jobs.publish(spark, layout, JdbcServer("jdbc:postgresql://host/db"))
    assert sent["games_raw"] == (200, {}) and sent["provider_stats"][0] == 3
    assert sent["bet_tier_stats"][1] == {
        "column_types": "bet_tier varchar(50), total_games int, avg_rtp decimal(6,2)",
    }

    steps = jobs.export(spark, layout)
    assert steps.agg({"total": "max"}).first()[0] == 200 and steps.count() == 12
    exported = spark.read.csv(layout.path("exports", "games_raw"), header=True)
    assert exported.count() == 200 and exported.columns == ["id", *NAMES]
    files = [f for f in os.listdir(layout.path("exports", "provider_stats")) if f.endswith(".csv")]
    assert len(files) == 1

    results = jobs.cluster(spark, layout, starts=3)
    summary = results["summary"].collect()
    assert sum(r["games"] for r in summary) == 190 and len(summary) == 4
    assert -1 <= results["silhouette"].first()["silhouette"] <= 1
    assert results["silhouette_all"].where("cluster IS NULL").first()["points"] == 190
    assert results["points"].count() == 190
    clustered = spark.read.csv(layout.path("exports", "games_with_clusters"), header=True)
    assert clustered.columns == [*games.CLUSTER_COLUMNS, "cluster"] and clustered.count() == 190


def test_jobs_read_compressed_files(spark, tmp_path):
    """Compressed CSV in files of bounded size gives the tables that plain CSV gives."""
    write_games(f"{tmp_path}/plain/games.csv", [game(game=f"G{i % 40}", last_updated="2024-01-01\n" if i == 3 else "x") for i in range(60)])
    read = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{tmp_path}/plain")
    export_csv(read, f"{tmp_path}/packed", rows_per_file=25, compression="gzip")
    files = [f for f in os.listdir(f"{tmp_path}/packed") if f.endswith(".csv.gz")]
    assert len(files) == 3
    one, other = jobs.Layout(f"{tmp_path}/one"), jobs.Layout(f"{tmp_path}/other")
    for layout, folder, glob in ((one, "plain", "*.csv"), (other, "packed", "*.csv.gz")):
        jobs.load_raw(spark, f"{tmp_path}/{folder}", layout, glob=glob)
        jobs.batch(spark, f"{tmp_path}/{folder}", layout, glob=glob)
    for table in (("raw", "table"), ("processed",), ("curated", "by_provider")):
        a, b = (sorted(map(str, spark.read.parquet(x.path(*table)).drop("id").collect())) for x in (one, other))
        assert a == b and a


def test_input_of_the_jobs_is_compressed(spark, tmp_path, folder):
    """The staged input takes less than a third of plain CSV, in files that one task can read."""
    layout, source = preset._job_input(spark, folder)
    _, plain = preset._job_input(spark, folder, packed=False)
    assert 0 < 3 * folder_bytes(spark, source, preset.PACKED) < folder_bytes(spark, plain, "*.csv")
    names = games.RAW_SCHEMA.fieldNames()
    one, other = (sorted(map(tuple, read_csv_text(spark, *a).select(*names).collect()), key=str) for a in ((source, names, preset.PACKED), (plain, names)))
    assert one == other


def test_batch_writes_rows_once_before_the_features(spark, tmp_path, monkeypatch):
    """The rows go from the files to the feature table by one shuffle, cut for the text of compressed files."""
    write_games(f"{tmp_path}/plain/games.csv", [game(game=f"G{i % 400}") for i in range(2000)])
    read = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/plain")
    export_csv(read, f"{tmp_path}/packed", rows_per_file=500, compression="gzip")
    labels, sizes, kept, sized = [], [], jobs.materialise, jobs.sized_shuffles
    monkeypatch.setattr(jobs, "materialise", lambda df, label: (labels.append((label, df._jdf.queryExecution().executedPlan().toString())), kept(df, label))[1])
    monkeypatch.setattr(jobs, "sized_shuffles", lambda spark, size, **more: (sizes.append((size, more)), sized(spark, size, **more))[1])
    tables = jobs.batch(spark, f"{tmp_path}/packed", jobs.Layout(f"{tmp_path}/out"), glob="*.csv.gz")
    assert [label for label, _ in labels] == ["features"] and "Scan csv" in labels[0][1]
    assert tables["processed"].count() == 400
    (files, _), (in_memory, more) = sizes
    text = os.path.getsize(f"{tmp_path}/plain/games.csv")
    assert files < text < in_memory and more["unpacked"] > 3


def test_fast_gzip_holds_the_same_rows(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "md5(CAST(id % 300 AS string)) AS word")
    for fast in (False, True):
        export_csv(rows, f"{tmp_path}/{fast}", compression="gzip", fast=fast)
        back = spark.read.schema("id long, word string").csv(f"{tmp_path}/{fast}", header=True)
        assert back.count() == 20_000 and back.exceptAll(rows).isEmpty()
    assert folder_bytes(spark, f"{tmp_path}/True", "*.csv.gz") > folder_bytes(spark, f"{tmp_path}/False", "*.csv.gz")
