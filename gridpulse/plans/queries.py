"""The activity questions, each a lazy ``DataFrame -> DataFrame`` function.

Every function takes a *prepared* frame (``prepare_activity`` output: records
with ``activityDateTime``, ``totalActivity`` and ``activityDate``) unless it
says otherwise. The null policy is chosen when preparing; the functions are
the same under both.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import activity_date, epoch_ms_to_timestamp, hour_of_day
from gridpulse.operators import aggregates as A
from gridpulse.operators.categories import DEFAULT_LABELS, equal_width_categories, quantile_categories
from gridpulse.operators.lookup import point_lookup
from gridpulse.operators.peaks import peak_rows, with_rank


def daily_peak_hour(prepared: DataFrame) -> DataFrame:
    """Busiest hour(s) of each day over the whole network.

    ``activityDate, hour, summedActivity``; tied hours are all kept, and a day
    whose hourly sums are all null keeps its (null) hours.
    """
    return peak_rows(A.hourly_totals(prepared), [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY)


def daily_peak_hour_by_max(prepared: DataFrame) -> DataFrame:
    """Busiest hour(s) of each day as "hours equal to the day's maximum".

    ``date, hour, hourlyTotalActivity``; unlike :func:`daily_peak_hour`, days
    without a non-null hourly sum are dropped.
    """
    hourly = A.sum_by(
        prepared,
        [activity_date().alias("date"), hour_of_day().alias(S.HOUR)],
        alias="hourlyTotalActivity",
    )
    return peak_rows(hourly, ["date"], "hourlyTotalActivity", drop_null_peaks=True)


def grid_hour_peak_records(prepared: DataFrame, all_columns: bool = False, strategy: str = "spread") -> DataFrame:
    """Record(s) with the largest total within each (grid, date, hour).

    No summing: these are single records. Default columns are
    ``gridId, activityDate, hour, totalActivity``; ``all_columns`` keeps every
    input column and appends ``hour``. Null totals never qualify.
    The default spreads a group that holds a large share of all records, tied
    or not, over tasks (see :func:`peak_rows`).
    """
    if all_columns:
        rows = prepared.withColumn(S.HOUR, hour_of_day())
    else:
        rows = prepared.select(S.GRID_ID, S.ACTIVITY_DATE, hour_of_day().alias(S.HOUR), S.TOTAL_ACTIVITY)
    keys = [S.GRID_ID, S.ACTIVITY_DATE, S.HOUR]
    return peak_rows(rows, keys, S.TOTAL_ACTIVITY, drop_null_peaks=True, strategy=strategy)


def grid_daily_peak_hour(prepared: DataFrame) -> DataFrame:
    """Busiest hour(s) of each grid cell each day.

    ``gridId, activityDate, hour, summedActivity``.
    """
    return peak_rows(A.grid_hourly_totals(prepared), [S.GRID_ID, S.ACTIVITY_DATE], S.SUMMED_ACTIVITY)


def grid_daily_peak_window(prepared: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Busiest tumbling window(s) of each grid cell each day, with its bounds.

    ``gridId, start, end, summedActivity``; groups without a non-null sum are
    dropped.
    """
    sums = A.grid_window_totals(prepared, duration)
    peaks = peak_rows(sums, [S.GRID_ID, "date"], S.SUMMED_ACTIVITY, drop_null_peaks=True)
    return peaks.select(S.GRID_ID, F.col("window.start").alias("start"), F.col("window.end").alias("end"), S.SUMMED_ACTIVITY)


def rank_grids_daily(prepared: DataFrame, rank_strategy: str = "range") -> DataFrame:
    """Grid cells ranked by their daily total, within each day.

    ``gridId, activityDate, totalActivity, rank``. The default spreads
    a day over many tasks (see :func:`with_rank`); ``"window"`` ranks it in one.
    """
    return with_rank(A.grid_daily_totals(prepared), [S.ACTIVITY_DATE], S.TOTAL_ACTIVITY, strategy=rank_strategy)


def rank_grids_by_peak_hour(prepared: DataFrame, rank_strategy: str = "range") -> DataFrame:
    """Grid cells ranked within each day by the activity of their busiest hour.

    ``gridId, activityDate, hour, summedActivity, rank``; a grid with tied peak
    hours appears once per hour.
    """
    return with_rank(grid_daily_peak_hour(prepared), [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY, strategy=rank_strategy)


def average_per_grid_day(prepared: DataFrame) -> DataFrame:
    """``gridId, activityDate, averageActivity`` (mean record total)."""
    return A.grid_daily_average(prepared)


def average_per_grid_day_of_month(prepared: DataFrame) -> DataFrame:
    """``gridId, date, avgActivity`` where ``date`` is the day of the month."""
    return A.grid_day_of_month_average(prepared)


def average_per_grid_window(prepared: DataFrame, duration: str = "7 days") -> DataFrame:
    """``gridId, start, end, averageActivity`` per tumbling window of dates."""
    avg = A.grid_window_average(prepared, duration)
    return avg.select(S.GRID_ID, F.col("window.start").alias("start"), F.col("window.end").alias("end"), S.AVERAGE_ACTIVITY)


def country_categories(prepared: DataFrame, labels=DEFAULT_LABELS) -> DataFrame:
    """Countries by total activity in equal-width ranges between the smallest
    and largest country total.

    ``countryCode, countryActivity, category``.
    """
    return equal_width_categories(A.country_totals(prepared), S.COUNTRY_ACTIVITY, labels, out=S.CATEGORY)


def country_quantile_categories(prepared: DataFrame, buckets: int = 3, key: str = S.COUNTRY_CODE) -> DataFrame:
    """Per country (or other ``key``): SMS, call and internet sums and their
    exact quantile buckets.

    ``countryCode, sms, call, internet, smsCategory, callCategory,
    internetCategory``. Run it on a zero-filled frame.
    """
    sums = prepared.groupBy(key).agg(
        F.sum(F.col(S.SMS_IN) + F.col(S.SMS_OUT)).alias("sms"),
        F.sum(F.col(S.CALL_IN) + F.col(S.CALL_OUT)).alias("call"),
        F.sum(S.INTERNET).alias("internet"),
    )
    return quantile_categories(
        sums,
        {"sms": "smsCategory", "call": "callCategory", "internet": "internetCategory"},
        buckets=buckets,
    )


def internet_categories(prepared: DataFrame, buckets: int = 3) -> DataFrame:
    """The distinct internet quantile buckets that occur."""
    sums = prepared.groupBy(S.COUNTRY_CODE).agg(F.sum(S.INTERNET).alias("internet"))
    return quantile_categories(sums, {"internet": "internetCategory"}, buckets=buckets).select("internetCategory").distinct()


def rank_grid_hours(prepared: DataFrame, rank_strategy: str = "range") -> DataFrame:
    """Every (grid, hour) sum of a day, ranked within that day.

    ``gridId, activityDate, hour, summedActivity, rank``.
    """
    return with_rank(A.grid_hourly_totals(prepared), [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY, strategy=rank_strategy)


def grid_day_hour_ranking(prepared: DataFrame, grid_id: int, day: _dt.date | str) -> DataFrame:
    """The hours of one grid cell on one day, ranked by their sum.

    ``activityDate, hour, summedActivity, rank``.
    """
    day_value = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    one = point_lookup(prepared, **{S.GRID_ID: grid_id, S.ACTIVITY_DATE: day_value})
    return with_rank(A.hourly_totals(one), [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY)


def max_total(prepared: DataFrame) -> DataFrame:
    """One row: ``maxTotalActivity``, the largest record total."""
    return A.max_total(prepared)


def interval_bounds(raw: DataFrame, interval_seconds: int = 600, epoch_col: str = S.INTERVAL_START) -> DataFrame:
    """Raw records -> ``gridId, start, end`` of each record's interval."""
    start = epoch_ms_to_timestamp(epoch_col)
    return raw.select(
        S.GRID_ID,
        start.alias("start"),
        (start + F.make_dt_interval(secs=F.lit(interval_seconds))).alias("end"),
    )
