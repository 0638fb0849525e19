"""Inputs of the queries and the SQL that describes the same inputs."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.lookups import Lookup, join_lookups
from tablewright.plans.games import RAW_SCHEMA


class Query(NamedTuple):
    """A query and its SQL; ``sql`` is None where SQL cannot say it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels; a document without a label has nulls."""
    documents = table(spark, folder, "documents")
    return documents.join(table(spark, folder, "labels"), "doc_id", "left")


LABELLED = """
    labelled AS (
        SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
    )"""


def half_up(expression: str, digits: int = 2) -> str:
    """SQL for rounding half up on the decimal value of a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def half_even(expression: str, digits: int = 2) -> str:
    """SQL for rounding half to even on the decimal value of a double."""
    return f"CAST(round_even(CAST({expression} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def game_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines shaped as raw game records: a provider is a supplier, a game is a part.

    Letter case, spaces, nulls and band edges vary as in the raw table.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    odd = F.col("l_linenumber") % 2 == 1
    priority = F.col("o_orderpriority")
    columns = {
        "casino": F.concat(F.lit("Site "), F.col("o_orderstatus")),
        "game": F.when(odd, F.concat(F.lit(" "), F.col("p_name"))).otherwise(F.upper("p_name")),
        "provider": F.when(
            F.col("s_name") != "Supplier#000000007",
            F.when(odd, F.col("s_name")).otherwise(F.concat(F.lower("s_name"), F.lit("  "))),
        ),
        "rtp": 90 + 100 * F.col("l_discount"),
        "volatility": F.when(priority == "1-URGENT", "Very High")
        .when(priority == "2-HIGH", "high").when(priority == "3-MEDIUM", " Medium ")
        .when(priority == "5-LOW", "LOW"),
        "jackpot": F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "Progressive"),
        "country_availability": F.col("o_orderstatus"),
        "min_bet": F.when(odd, F.col("l_tax") * 10).otherwise(F.col("l_tax") * 20),
        "max_win": F.col("l_extendedprice"),
        "game_type": F.when(odd, F.col("p_type")).otherwise(F.lower("p_type")),
        "game_category": F.col("p_brand"),
        "license_jurisdiction": F.col("l_returnflag"),
        "release_year": F.year("l_shipdate"),
        "currency": F.col("l_linestatus"),
        "mobile_compatible": F.col("l_linenumber") < 5,
        "free_spins_feature": F.when(F.col("l_quantity") > 20, True).when(F.col("l_quantity") > 5, False),
        "bonus_buy_available": F.col("l_returnflag") == "N",
        "max_multiplier": F.when(F.col("l_quantity") != 13, F.col("l_quantity") * 250),
        "languages": F.lit("en"),
        "last_updated": F.col("l_shipdate").cast("date").cast("string"),
    }
    described = join_lookups(lines, [
        Lookup("l_orderkey", orders, "o_orderkey"), Lookup("l_partkey", parts, "p_partkey"),
        Lookup("l_suppkey", suppliers, "s_suppkey"),
    ])
    return described.select(*[columns[name].alias(name) for name in RAW_SCHEMA.fieldNames()])


GAMES = """
    games AS (
        SELECT
            'Site ' || o_orderstatus AS casino,
            CASE WHEN l_linenumber % 2 = 1 THEN ' ' || p_name ELSE upper(p_name) END AS game,
            CASE WHEN s_name <> 'Supplier#000000007' THEN
                CASE WHEN l_linenumber % 2 = 1 THEN s_name ELSE lower(s_name) || '  ' END
            END AS provider,
            90 + 100 * l_discount AS rtp,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'Very High' WHEN '2-HIGH' THEN 'high'
                WHEN '3-MEDIUM' THEN ' Medium ' WHEN '5-LOW' THEN 'LOW' END AS volatility,
            CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Progressive' END AS jackpot,
            o_orderstatus AS country_availability,
            CASE WHEN l_linenumber % 2 = 1 THEN l_tax * 10 ELSE l_tax * 20 END AS min_bet,
            l_extendedprice AS max_win,
            CASE WHEN l_linenumber % 2 = 1 THEN p_type ELSE lower(p_type) END AS game_type,
            p_brand AS game_category,
            l_returnflag AS license_jurisdiction,
            CAST(year(l_shipdate) AS INTEGER) AS release_year,
            l_linestatus AS currency,
            l_linenumber < 5 AS mobile_compatible,
            CASE WHEN l_quantity > 20 THEN true WHEN l_quantity > 5 THEN false END
                AS free_spins_feature,
            l_returnflag = 'N' AS bonus_buy_available,
            CASE WHEN l_quantity <> 13 THEN l_quantity * 250 END AS max_multiplier,
            'en' AS languages,
            strftime(l_shipdate, '%Y-%m-%d') AS last_updated
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
    )"""

CLEAN_GAMES = f"""{GAMES},
    clean AS (
        SELECT DISTINCT
            casino,
            trim(upper(game)) AS game,
            trim(upper(provider)) AS provider,
            {half_up('rtp')} AS rtp,
            trim(upper(volatility)) AS volatility,
            coalesce(jackpot, 'No Jackpot') AS jackpot,
            country_availability,
            {half_up('min_bet')} AS min_bet,
            {half_up('max_win')} AS max_win,
            trim(upper(game_type)) AS game_type,
            game_category, license_jurisdiction, release_year, currency,
            mobile_compatible, free_spins_feature, bonus_buy_available,
            coalesce({half_up('max_multiplier')}, 0.0) AS max_multiplier,
            languages, last_updated
        FROM games
    )"""

FEATURE_GAMES = f"""{CLEAN_GAMES},
    features AS (
        SELECT *,
            CASE WHEN rtp >= 97 THEN 'High RTP' WHEN rtp >= 94 THEN 'Medium RTP'
                ELSE 'Low RTP' END AS rtp_category,
            CASE WHEN min_bet <= 0.10::DOUBLE THEN 'Low Stakes'
                WHEN min_bet <= 1.00::DOUBLE THEN 'Mid Stakes' ELSE 'High Stakes' END AS bet_tier,
            jackpot <> 'No Jackpot' AS has_jackpot,
            coalesce(mobile_compatible AND free_spins_feature, false) AS player_friendly,
            CASE WHEN max_multiplier >= 10000 THEN 'Mega Multiplier'
                WHEN max_multiplier >= 5000 THEN 'High Multiplier'
                WHEN max_multiplier >= 1000 THEN 'Mid Multiplier'
                ELSE 'Standard Multiplier' END AS multiplier_tier,
            {half_up('''(100 - rtp) * CASE volatility WHEN 'HIGH' THEN 3 WHEN 'VERY HIGH' THEN 4
                WHEN 'MEDIUM' THEN 2 ELSE 1 END''')} AS profitability_score
        FROM clean
    )"""
