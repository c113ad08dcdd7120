"""Column helpers built from Spark's own functions."""

from adlake.functions.columns import (
    banker_round,
    date_key,
    display,
    divide,
    positive_ratio,
    text_key,
)

__all__ = [
    "banker_round",
    "date_key",
    "display",
    "divide",
    "positive_ratio",
    "text_key",
]
