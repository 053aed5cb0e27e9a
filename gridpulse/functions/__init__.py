"""Column expressions: epoch conversion, totals, date parts, text tokens."""

from gridpulse.functions.columns import (
    activity_date,
    apply_null_policy,
    date_text,
    day_of_month,
    epoch_ms_to_timestamp,
    fill_measures,
    hour_of_day,
    prepare_activity,
    total_activity,
    with_activity_columns,
)
from gridpulse.functions.text import java_trim, normalize_token, normalize_word, separator_pattern

__all__ = [
    "activity_date",
    "apply_null_policy",
    "date_text",
    "day_of_month",
    "epoch_ms_to_timestamp",
    "fill_measures",
    "hour_of_day",
    "java_trim",
    "normalize_token",
    "normalize_word",
    "prepare_activity",
    "separator_pattern",
    "total_activity",
    "with_activity_columns",
]
