"""Grouped sums and averages over dated activity records.

All are hash aggregates: Spark computes a partial aggregate in each map task
before the shuffle, so a hot key costs one partial row per task, not one row
per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import day_of_month, hour_of_day
from gridpulse.operators.exact_sums import is_reproducible, reproducible_sums

_COUNT = "__values"

Key = str | Column


def mean(c: str | Column) -> Column:
    """Average of the non-null values, as a double.

    ``sum / count`` with the sum taken in the input's own type, so an exact
    (decimal) input gives an exact sum before the single division. Null when
    the group has no non-null value.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def sum_by(df: DataFrame, keys: Sequence[Key], value: str = S.TOTAL_ACTIVITY, alias: str = S.SUMMED_ACTIVITY) -> DataFrame:
    """Sum per group; independent of the order of addition if ``value`` is a decimal or
    a double marked by ``prepare_activity(reproducible=True)``."""
    if is_reproducible(df, value):
        return reproducible_sums(df, keys, value, alias)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def average_by(df: DataFrame, keys: Sequence[Key], value: str = S.TOTAL_ACTIVITY, alias: str = S.AVERAGE_ACTIVITY) -> DataFrame:
    """Average of the non-null values per group, by :func:`sum_by`'s rule for doubles."""
    if is_reproducible(df, value):
        sums = reproducible_sums(df, keys, value, alias, count=_COUNT)
        return sums.withColumn(alias, F.try_divide(alias, _COUNT)).drop(_COUNT)
    return df.groupBy(*keys).agg(mean(value).alias(alias))


def hourly_totals(df: DataFrame, alias: str = S.SUMMED_ACTIVITY) -> DataFrame:
    """Network-wide sum per (activityDate, hour)."""
    return sum_by(df, [S.ACTIVITY_DATE, hour_of_day().alias(S.HOUR)], alias=alias)


def grid_hourly_totals(df: DataFrame) -> DataFrame:
    """Sum per (gridId, activityDate, hour)."""
    return sum_by(df, [S.GRID_ID, S.ACTIVITY_DATE, hour_of_day().alias(S.HOUR)])


def grid_daily_totals(df: DataFrame) -> DataFrame:
    """Sum per (gridId, activityDate), named ``totalActivity``."""
    return sum_by(df, [S.GRID_ID, S.ACTIVITY_DATE], alias=S.TOTAL_ACTIVITY)


def grid_daily_average(df: DataFrame) -> DataFrame:
    """Average record total per (gridId, activityDate)."""
    return average_by(df, [S.GRID_ID, S.ACTIVITY_DATE])


def grid_day_of_month_average(df: DataFrame, date_alias: str = "date", alias: str = "avgActivity") -> DataFrame:
    """Average per (gridId, day of month): equal days of different months merge."""
    return average_by(df, [S.GRID_ID, day_of_month().alias(date_alias)], alias=alias)


def grid_window_totals(df: DataFrame, duration: str = "1 hour", ts: str = S.ACTIVITY_DATE_TIME) -> DataFrame:
    """Sum per (gridId, date, tumbling time window of ``duration``).

    The window column is the struct ``window{start, end}``; windows are fixed
    instants aligned to the epoch, independent of the session time zone.
    """
    return sum_by(df, [S.GRID_ID, F.to_date(ts).alias("date"), F.window(ts, duration)])


def grid_window_average(df: DataFrame, duration: str = "7 days", ts: str = S.ACTIVITY_DATE) -> DataFrame:
    """Average per (gridId, tumbling window of ``duration``) over ``ts``.

    A date column is read as midnight in the session time zone; with a UTC
    session 7-day windows start on Thursdays (the epoch was a Thursday).
    """
    return average_by(df, [S.GRID_ID, F.window(ts, duration)])


def country_totals(df: DataFrame) -> DataFrame:
    """Sum per countryCode, named ``countryActivity``."""
    return sum_by(df, [S.COUNTRY_CODE], alias=S.COUNTRY_ACTIVITY)


def extremes(df: DataFrame, value: str) -> DataFrame:
    """One row: ``max`` and ``min`` of ``value`` over the whole frame."""
    return df.agg(F.max(value).alias("max"), F.min(value).alias("min"))


def max_total(df: DataFrame, value: str = S.TOTAL_ACTIVITY, alias: str = "maxTotalActivity") -> DataFrame:
    """One row: the largest record total."""
    return df.agg(F.max(value).alias(alias))
