"""Schema, thresholds and tables of the online-game catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import (
    all_true,
    band,
    case_weight,
    deviation,
    is_not_sentinel,
    weighted_gap,
)
from tablewright.operators.clean import distinct_rows, normalise
from tablewright.operators.enrich import enrich
from tablewright.operators.rollup import Rollup, count_true, mean, row_count, stddev
from tablewright.sinks.contracts import Contract, Field
from tablewright.streaming import BATCH

# Columns of the raw table, in file order.
RAW_SCHEMA = T.StructType([
    T.StructField("casino", T.StringType()),
    T.StructField("game", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("rtp", T.DoubleType()),
    T.StructField("volatility", T.StringType()),
    T.StructField("jackpot", T.StringType()),
    T.StructField("country_availability", T.StringType()),
    T.StructField("min_bet", T.DoubleType()),
    T.StructField("max_win", T.DoubleType()),
    T.StructField("game_type", T.StringType()),
    T.StructField("game_category", T.StringType()),
    T.StructField("license_jurisdiction", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("currency", T.StringType()),
    T.StructField("mobile_compatible", T.BooleanType()),
    T.StructField("free_spins_feature", T.BooleanType()),
    T.StructField("bonus_buy_available", T.BooleanType()),
    T.StructField("max_multiplier", T.DoubleType()),
    T.StructField("languages", T.StringType()),
    T.StructField("last_updated", T.StringType()),
])

# Sentinel, band edges, labels and weights.
NO_JACKPOT = "No Jackpot"
RTP_BANDS = ((97, "High RTP"), (94, "Medium RTP"))
RTP_DEFAULT = "Low RTP"
BET_BANDS = ((0.10, "Low Stakes"), (1.00, "Mid Stakes"))
BET_DEFAULT = "High Stakes"
MULTIPLIER_BANDS = (
    (10000, "Mega Multiplier"), (5000, "High Multiplier"), (1000, "Mid Multiplier"),
)
MULTIPLIER_DEFAULT = "Standard Multiplier"
VOLATILITY_WEIGHTS = {"HIGH": 3, "VERY HIGH": 4, "MEDIUM": 2}
VOLATILITY_DEFAULT = 1

TEXT_COLUMNS = ("game", "provider", "game_type", "volatility")
NUMBER_COLUMNS = ("rtp", "min_bet", "max_win", "max_multiplier")


def clean_games(raw: DataFrame) -> DataFrame:
    """Normalised rows without copies."""
    return distinct_rows(normalise(raw, TEXT_COLUMNS, NUMBER_COLUMNS, {"jackpot": NO_JACKPOT}, {"max_multiplier": 0.0}))


def add_features(clean: DataFrame) -> DataFrame:
    """The six derived columns, in one projection."""
    weight = case_weight("volatility", VOLATILITY_WEIGHTS, VOLATILITY_DEFAULT)
    return clean.withColumns({
        "rtp_category": band("rtp", RTP_BANDS, RTP_DEFAULT),
        "bet_tier": band("min_bet", BET_BANDS, BET_DEFAULT, at_least=False),
        "has_jackpot": is_not_sentinel("jackpot", NO_JACKPOT),
        "player_friendly": all_true("mobile_compatible", "free_spins_feature"),
        "multiplier_tier": band("max_multiplier", MULTIPLIER_BANDS, MULTIPLIER_DEFAULT),
        "profitability_score": weighted_gap("rtp", 100, weight),
    })


BASIC_FEATURES = ("rtp_category", "bet_tier", "has_jackpot", "player_friendly")

ROLLUPS = (
    Rollup("by_provider", "provider", (
        row_count("total_games"), mean("avg_rtp", "rtp"), mean("avg_max_win", "max_win"),
        mean("avg_profitability", "profitability_score"), count_true("jackpot_games", "has_jackpot"),
    )),
    Rollup("by_game_type", "game_type", (
        row_count("total_games"), mean("avg_rtp", "rtp"),
        mean("avg_max_multiplier", "max_multiplier", 0),
    )),
    Rollup("by_volatility", "volatility", (
        row_count("total_games"), mean("avg_rtp", "rtp"), mean("avg_max_win", "max_win"),
    )),
    Rollup("by_rtp_category", "rtp_category", (
        row_count("total_games"), mean("avg_max_win", "max_win"),
    )),
    Rollup("by_bet_tier", "bet_tier", (row_count("total_games"), mean("avg_rtp", "rtp"))),
)

# The smaller set of an earlier batch job.
BASIC_ROLLUPS = (
    Rollup("by_provider", "provider", (
        row_count("total_games"), mean("avg_rtp", "rtp"), mean("avg_max_win", "max_win"),
    )),
    Rollup("by_game_type", "game_type", (row_count("total_games"), mean("avg_rtp", "rtp"))),
    Rollup("by_volatility", "volatility", (row_count("total_games"),)),
    Rollup("by_rtp_category", "rtp_category", (row_count("total_games"),)),
)

PROVIDER_STATS = (
    mean("provider_avg_rtp", "rtp"),
    row_count("provider_total_games"),
    stddev("provider_rtp_stddev", "rtp", 4),
    mean("provider_avg_profitability", "profitability_score"),
)


def enrich_games(features: DataFrame) -> DataFrame:
    """Provider statistics on every row; pass a written table."""
    enriched = enrich(features, "provider", PROVIDER_STATS)
    return enriched.withColumn("rtp_vs_provider_avg", deviation("rtp", "provider_avg_rtp"))


SAMPLE_COLUMNS = (
    "game", "provider", "rtp", "provider_avg_rtp", "rtp_vs_provider_avg", "provider_total_games",
)

INCREMENT_INPUT = (
    "provider", "game_type", "rtp", "has_jackpot", "player_friendly", "profitability_score",
)


def flag_increment(increment: DataFrame) -> DataFrame:
    """Columns of the increment output; works on batch and streaming tables."""
    return increment.select(
        "provider",
        "game_type",
        "rtp",
        band("rtp", RTP_BANDS, RTP_DEFAULT).alias("rtp_flag"),
        "has_jackpot",
        "player_friendly",
        all_true("has_jackpot", "player_friendly").alias("is_premium"),
        "profitability_score",
        F.col(BATCH),
    )


_COUNT = T.IntegerType()
_RATE = T.DecimalType(6, 2)
_AMOUNT = T.DecimalType(12, 2)

# Mart name -> curated table and contract.
MARTS = {
    "provider_stats": ("by_provider", Contract("provider_stats", "provider", (
        Field("provider", T.StringType(), 100),
        Field("total_games", _COUNT),
        Field("avg_rtp", _RATE),
        Field("avg_max_win", _AMOUNT),
        Field("avg_profitability", _RATE),
        Field("jackpot_games", _COUNT),
    ))),
    "game_type_stats": ("by_game_type", Contract("game_type_stats", "game_type", (
        Field("game_type", T.StringType(), 100),
        Field("total_games", _COUNT),
        Field("avg_rtp", _RATE),
        Field("avg_max_multiplier", _AMOUNT),
    ))),
    "volatility_stats": ("by_volatility", Contract("volatility_stats", "volatility", (
        Field("volatility", T.StringType(), 50),
        Field("total_games", _COUNT),
        Field("avg_rtp", _RATE),
        Field("avg_max_win", _AMOUNT),
    ))),
    "rtp_category_stats": ("by_rtp_category", Contract("rtp_category_stats", "rtp_category", (
        Field("rtp_category", T.StringType(), 50),
        Field("total_games", _COUNT),
        Field("avg_max_win", _AMOUNT),
    ))),
    "bet_tier_stats": ("by_bet_tier", Contract("bet_tier_stats", "bet_tier", (
        Field("bet_tier", T.StringType(), 50),
        Field("total_games", _COUNT),
        Field("avg_rtp", _RATE),
    ))),
}

CLUSTER_FEATURES = ("rtp", "max_win", "max_multiplier", "min_bet")
CLUSTER_COLUMNS = (*CLUSTER_FEATURES, "game_type", "volatility")
CLUSTER_MEANS = {
    "avg_rtp": "rtp",
    "avg_max_win": "max_win",
    "avg_multiplier": "max_multiplier",
    "avg_min_bet": "min_bet",
}

# Label of the cluster that leads a metric; a later rule overrides.
CLUSTER_LABELS = (
    ("avg_rtp", "High RTP / Low Risk"),
    ("avg_max_win", "High Win Potential"),
    ("avg_multiplier", "Mega Multiplier"),
    ("avg_min_bet", "High Stakes"),
)
CLUSTER_LABEL_DEFAULT = "Standard Games"
