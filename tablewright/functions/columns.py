"""Cleaning, banding, flag and score expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits kept before the final rounding of an average. The order in which executors add
# doubles changes the last bits of a sum; this step drops them, so that an average that is
# exactly half-way rounds the same way on every run.
_NOISE_DIGITS = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Upper case without leading and trailing spaces (tabs stay)."""
    return F.trim(F.upper(_col(c)))


def round_number(c: Column | str, digits: int = 2) -> Column:
    """Cast to double and round half up on the decimal text of the value."""
    return F.round(_col(c).cast("double"), digits)


def round_mean(c: Column | str, digits: int = 2, half_even: bool = False) -> Column:
    """Round an aggregate of doubles so that the order of addition does not show."""
    steady = F.round(_col(c), _NOISE_DIGITS)
    return F.bround(steady, digits) if half_even else F.round(steady, digits)


def fill_text(c: Column | str, sentinel: str) -> Column:
    """Null becomes ``sentinel``. The cast keeps this valid if a reader made it a number."""
    return F.coalesce(_col(c).cast("string"), F.lit(sentinel))


def fill_number(c: Column | str, value: float = 0.0) -> Column:
    """Null becomes ``value``; NaN stays."""
    return F.coalesce(_col(c), F.lit(value))


def band(c: Column | str, edges: Sequence[tuple[float, str]], default: str,
         at_least: bool = True) -> Column:
    """Name of the first band whose edge holds: ``>=`` or, with ``at_least=False``, ``<=``.

    Null fits no edge and gets ``default``. NaN is above every number.
    """
    value = _col(c)
    chain = None
    for edge, name in edges:
        test = value >= F.lit(edge) if at_least else value <= F.lit(edge)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def case_weight(c: Column | str, weights: Mapping[str, int], default: int) -> Column:
    """Weight of a text value; unknown and null values get ``default``."""
    value = _col(c)
    chain = None
    for name, weight in weights.items():
        test = value == F.lit(name)
        chain = F.when(test, weight) if chain is None else chain.when(test, weight)
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def weighted_gap(c: Column | str, ceiling: float, weight: Column, digits: int = 2) -> Column:
    """Distance of ``c`` below ``ceiling`` times ``weight``; null stays null."""
    return F.round((F.lit(ceiling) - _col(c)) * weight, digits)


def is_not_sentinel(c: Column | str, sentinel: str) -> Column:
    """True unless the value is the sentinel; null counts as a value of its own."""
    return ~_col(c).eqNullSafe(F.lit(sentinel))


def all_true(*columns: Column | str) -> Column:
    """True only if every column is true; null counts as false."""
    if not columns:
        raise ValueError("all_true needs a column")
    combined = _col(columns[0])
    for c in columns[1:]:
        combined = combined & _col(c)
    return F.coalesce(combined, F.lit(False))


def deviation(c: Column | str, reference: Column | str, digits: int = 2) -> Column:
    """Rounded difference between a value and its reference."""
    return F.round(_col(c) - _col(reference), digits)


def parse_boolean(c: Column | str) -> Column:
    """Boolean from text; text that is not a boolean becomes null also under ANSI rules."""
    return F.trim(_col(c).cast("string")).try_cast("boolean")


def null_tokens_to_null(c: Column | str, tokens: Sequence[str]) -> Column:
    """Null where the text is one of ``tokens``."""
    value = _col(c)
    return F.when(~value.isin(list(tokens)), value) if tokens else value


def megabytes(c: Column | str, digits: int = 2) -> Column:
    """Bytes as MiB."""
    return F.round(_col(c) / F.lit(1024 * 1024), digits)


def map_total(c: Column | str) -> Column:
    """Sum of the values of a map of longs."""
    return F.aggregate(F.map_values(_col(c)), F.lit(0).cast("long"), lambda total, v: total + v)
