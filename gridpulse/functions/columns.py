"""Column expressions and the step that adds date, time and total columns.

Everything here is a built-in Spark SQL expression, so it stays inside
whole-stage codegen and is pushed through projections by Catalyst.

Time zone: ``hour``, ``to_date`` and ``dayofmonth`` read the session time zone
(``spark.sql.session.timeZone``); set it explicitly, results depend on it.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_timestamp(epoch_ms: str | Column) -> Column:
    """Epoch milliseconds -> timestamp at second precision (sub-second part floored)."""
    return F.timestamp_seconds(F.floor(_col(epoch_ms) / 1000))


def total_activity(measures: tuple[str, ...] = S.MEASURES) -> Column:
    """Sum of the measures with ``+``, left to right: null if any measure is null."""
    return reduce(add, [F.col(m) for m in measures])


def activity_date(ts: str | Column = S.ACTIVITY_DATE_TIME) -> Column:
    return F.to_date(_col(ts))


def hour_of_day(ts: str | Column = S.ACTIVITY_DATE_TIME) -> Column:
    return F.hour(_col(ts))


def day_of_month(ts: str | Column = S.ACTIVITY_DATE_TIME) -> Column:
    return F.dayofmonth(_col(ts))


def date_text(ts: str | Column = S.ACTIVITY_DATE_TIME) -> Column:
    """Date as ``yyyy-MM-dd`` text (the form used as a partition expression)."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def fill_measures(df: DataFrame, value: float = 0.0, measures: tuple[str, ...] = S.MEASURES) -> DataFrame:
    """Null and NaN measures -> ``value``. Key columns are left alone."""
    return df.na.fill(value, subset=list(measures))


def apply_null_policy(df: DataFrame, null_policy: str = S.ZERO) -> DataFrame:
    """``zero``: fill the measures with 0; ``propagate``: leave them, so that the
    total of a row with a null measure is null.

    Both keep every row: a key that failed to parse stays null and forms its own group.
    """
    S.check_null_policy(null_policy)
    return df if null_policy == S.PROPAGATE else fill_measures(df)


def epoch_column(df: DataFrame) -> str:
    """Name of the epoch column: ``intervalStart`` or ``activityStartEpoch``."""
    columns = df.columns
    for name in (S.INTERVAL_START, S.ACTIVITY_START_EPOCH):
        if name in columns:
            return name
    raise ValueError(f"no epoch column ({S.INTERVAL_START} or {S.ACTIVITY_START_EPOCH}) in {columns}")


def with_activity_columns(
    df: DataFrame,
    epoch_col: str = S.INTERVAL_START,
    drop_epoch: bool = True,
) -> DataFrame:
    """Add ``activityDateTime`` (timestamp), ``totalActivity`` and ``activityDate``.

    The epoch column is dropped unless ``drop_epoch`` is false.
    """
    ts = epoch_ms_to_timestamp(epoch_col)
    out = df.withColumns(
        {
            S.ACTIVITY_DATE_TIME: ts,
            S.TOTAL_ACTIVITY: total_activity(),
            S.ACTIVITY_DATE: activity_date(ts),
        }
    )
    return out.drop(epoch_col) if drop_epoch else out


def prepare_activity(
    df: DataFrame,
    null_policy: str = S.ZERO,
    drop_epoch: bool = True,
    epoch_col: str | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """Raw records -> dated records with a total, under ``null_policy``.

    ``reproducible`` marks the total (in the column's metadata) so that the grouped
    sums and averages of doubles don't depend on the order of addition
    (``operators.exact_sums``); decimals never do.

    This is the shared first step of every activity query. The epoch column
    is found by name unless given. It is lazy; persist or checkpoint it
    yourself when several queries read it.
    """
    epoch = epoch_col or epoch_column(df)
    out = with_activity_columns(apply_null_policy(df, null_policy), epoch_col=epoch, drop_epoch=drop_epoch)
    return out.withMetadata(S.TOTAL_ACTIVITY, {S.REPRODUCIBLE: True}) if reproducible else out
