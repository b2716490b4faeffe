"""Column expressions shared by the operators."""

from tieout.functions.columns import (
    business_day_end,
    instant_text,
    is_safe_identifier,
    newer,
    paise,
    position,
    row_fingerprint,
    strict_bigint,
    strict_date,
)

__all__ = [
    "business_day_end", "instant_text", "is_safe_identifier", "newer", "paise", "position",
    "row_fingerprint", "strict_bigint", "strict_date",
]
