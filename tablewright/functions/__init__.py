"""Column expressions; all are built-in Spark functions."""

from tablewright.functions.columns import (
    all_true,
    band,
    case_weight,
    clean_text,
    deviation,
    fill_number,
    fill_text,
    is_not_sentinel,
    map_total,
    megabytes,
    null_tokens_to_null,
    parse_boolean,
    round_mean,
    round_number,
    weighted_gap,
)

__all__ = [
    "all_true",
    "band",
    "case_weight",
    "clean_text",
    "deviation",
    "fill_number",
    "fill_text",
    "is_not_sentinel",
    "map_total",
    "megabytes",
    "null_tokens_to_null",
    "parse_boolean",
    "round_mean",
    "round_number",
    "weighted_gap",
]
