from tallyhawk.functions.columns import (
    amount_band,
    amount_log,
    day_index,
    hour_of_day,
    injective_text,
    is_fraud,
    is_missing,
    share_percent,
    standard_score,
    timestamp_literal,
)

__all__ = [
    "amount_band",
    "amount_log",
    "day_index",
    "hour_of_day",
    "injective_text",
    "is_fraud",
    "is_missing",
    "share_percent",
    "standard_score",
    "timestamp_literal",
]
