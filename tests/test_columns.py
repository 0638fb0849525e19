"""Column functions on the edge rows of FIXTURES.md."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright import functions as fn
from tablewright.plans import games


def values(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column.alias("x")).collect()]


def test_clean_text_keeps_tabs(spark):
    got = values(spark, fn.clean_text("t"), [(" Book ",), ("BOOK",), ("\tbook",), (None,)], "t string")
    assert got == ["BOOK", "BOOK", "\tBOOK", None]


def test_rounding_is_half_up_on_decimal_text(spark):
    rows = [(1.005,), (2.675,), (-1.005,), (96.004,), (None,)]
    assert values(spark, fn.round_number("x"), rows, "x double") == [1.01, 2.68, -1.01, 96.0, None]
    assert values(spark, fn.round_number("x"), [("96.001",)], "x string") == [96.0]


def test_round_mean_ignores_noise_of_addition(spark):
    rows = [(0.045 - 1e-15,), (0.045 + 1e-15,), (float("nan"),), (None,)]
    got = values(spark, fn.round_mean("x"), rows, "x double")
    assert got[:2] == [0.05, 0.05] and math.isnan(got[2]) and got[3] is None
    assert values(spark, fn.round_mean("x", 2, half_even=True), [(0.045,), (0.055,)], "x double") == [0.04, 0.06]


def test_fills(spark):
    assert values(spark, fn.fill_text("x", "No Jackpot"), [(None,), ("Mini",), ("",)], "x string") == ["No Jackpot", "Mini", ""]
    assert values(spark, fn.fill_text("x", "No Jackpot"), [(None,), (5,)], "x int") == ["No Jackpot", "5"]
    got = values(spark, fn.fill_number("x"), [(None,), (float("nan"),), (1.5,)], "x double")
    assert got[0] == 0.0 and math.isnan(got[1]) and got[2] == 1.5


@pytest.mark.parametrize("column, rows, expected", [
    (lambda: fn.band("x", games.RTP_BANDS, games.RTP_DEFAULT),
     [97.0, 96.99, 94.0, 93.99, None, float("nan")],
     ["High RTP", "Medium RTP", "Medium RTP", "Low RTP", "Low RTP", "High RTP"]),
    (lambda: fn.band("x", games.BET_BANDS, games.BET_DEFAULT, at_least=False),
     [0.10, 0.11, 1.00, 1.01, None],
     ["Low Stakes", "Mid Stakes", "Mid Stakes", "High Stakes", "High Stakes"]),
    (lambda: fn.band("x", games.MULTIPLIER_BANDS, games.MULTIPLIER_DEFAULT),
     [10000.0, 9999.0, 5000.0, 1000.0, 999.0, 0.0],
     ["Mega Multiplier", "High Multiplier", "High Multiplier", "Mid Multiplier",
      "Standard Multiplier", "Standard Multiplier"]),
])
def test_bands(spark, column, rows, expected):
    assert values(spark, column(), [(r,) for r in rows], "x double") == expected


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=False, width=32)), min_size=1, max_size=40))
def test_bands_are_total_and_exclusive(spark, xs):
    edges = [(50.0, "c"), (10.0, "b"), (0.0, "a")]
    got = values(spark, fn.band("x", edges, "d"), [(x,) for x in xs], "x double")
    expected = ["d" if x is None else next((n for e, n in edges if x >= e), "d") for x in xs]
    assert got == expected


def test_score(spark):
    weight = fn.case_weight("v", games.VOLATILITY_WEIGHTS, games.VOLATILITY_DEFAULT)
    rows = [(96.0, "HIGH"), (96.0, "VERY HIGH"), (96.0, "MEDIUM"), (96.0, "LOW"), (96.0, None), (None, "HIGH")]
    got = values(spark, fn.weighted_gap("x", 100, weight), rows, "x double, v string")
    assert got == [12.0, 16.0, 8.0, 4.0, 4.0, None]


def test_flags(spark):
    rows = [(True, True), (True, False), (True, None), (None, None), (False, None)]
    assert values(spark, fn.all_true("a", "b"), rows, "a boolean, b boolean") == [True, False, False, False, False]
    assert values(spark, fn.is_not_sentinel("x", "No Jackpot"), [("No Jackpot",), ("Mini",), (None,)], "x string") == [False, True, True]


def test_parse_boolean(spark):
    rows = [("True",), ("false",), ("maybe",), (" yes ",), (None,)]
    assert values(spark, fn.parse_boolean("x"), rows, "x string") == [True, False, None, True, None]


def test_null_tokens(spark):
    rows = [("",), ("NA",), ("None",), ("x",), (None,)]
    assert values(spark, fn.null_tokens_to_null("x", [""]), rows, "x string") == [None, "NA", "None", "x", None]
    assert values(spark, fn.null_tokens_to_null("x", ["", "NA", "None"]), rows, "x string") == [None, None, None, "x", None]


def test_small_helpers(spark):
    assert values(spark, fn.megabytes("x"), [(252_241_562,)], "x long") == [240.56]
    assert values(spark, fn.map_total("x"), [({"a": 1, "b": 2},), ({},)], "x map<string,long>") == [3, 0]
    assert values(spark, fn.deviation("x", F.lit(96.01)), [(96.0,), (None,)], "x double") == [-0.01, None]
