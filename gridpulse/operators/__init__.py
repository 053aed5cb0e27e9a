"""Operators: grouped aggregates, peak and rank windows, categories, word count,
lookups and date partitioning."""

from gridpulse.operators.aggregates import (
    average_by,
    country_totals,
    extremes,
    grid_daily_average,
    grid_daily_totals,
    grid_day_of_month_average,
    grid_hourly_totals,
    grid_window_average,
    grid_window_totals,
    hourly_totals,
    max_total,
    mean,
    sum_by,
)
from gridpulse.operators.categories import equal_width_categories, quantile_categories
from gridpulse.operators.lookup import null_key_counts, point_lookup
from gridpulse.operators.partitioning import dated_records, hash_partition_by_date, partition_by_date
from gridpulse.operators.peaks import peak_rows, with_rank
from gridpulse.operators.words import format_counts, word_count

__all__ = [
    "average_by",
    "country_totals",
    "dated_records",
    "equal_width_categories",
    "extremes",
    "format_counts",
    "grid_daily_average",
    "grid_daily_totals",
    "grid_day_of_month_average",
    "grid_hourly_totals",
    "grid_window_average",
    "grid_window_totals",
    "hash_partition_by_date",
    "hourly_totals",
    "max_total",
    "mean",
    "null_key_counts",
    "partition_by_date",
    "peak_rows",
    "point_lookup",
    "quantile_categories",
    "sum_by",
    "with_rank",
    "word_count",
]
