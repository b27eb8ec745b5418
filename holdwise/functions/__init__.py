"""Column-level helpers shared by every model (A2, P4, P5, P14, rounding)."""

from holdwise.functions.columns import (
    NULL_TOKEN,
    bounded_broadcast,
    mul,
    parse_dmy,
    round_half_away,
    sentinel_decimal,
    surrogate_key,
    ticker_bucket,
)

__all__ = [
    "NULL_TOKEN",
    "bounded_broadcast",
    "mul",
    "parse_dmy",
    "round_half_away",
    "sentinel_decimal",
    "surrogate_key",
    "ticker_bucket",
]
