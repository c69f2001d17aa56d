"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from martlake.functions.numbers import (
    cents,
    half_up_int,
    decimals_to_double,
    ratio_half_up,
    to_money,
)
from martlake.functions.dates import day_span, month_key, purchase_date

__all__ = [
    "cents",
    "half_up_int",
    "day_span",
    "decimals_to_double",
    "month_key",
    "purchase_date",
    "ratio_half_up",
    "to_money",
]
