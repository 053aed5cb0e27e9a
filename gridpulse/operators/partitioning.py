"""Date-oriented layout of activity records.

Hash-partitioning raw rows by date alone puts each date in one task, so the
largest date sets the job's length (a date may hold a third of all rows).
``partition_by_date`` therefore range-partitions on (date, time, grid,
country): Spark samples the keys and cuts ``n`` ranges of about equal size,
so a busy date is split over as many tasks as its size needs while every
task still holds one contiguous stretch of time. ``hash_partition_by_date``
is the plain hash layout (optionally spread over sub-partitions). For a
persistent layout use ``sinks.write_by_date`` (directory partitioning; later
date filters prune whole directories).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import activity_date, epoch_ms_to_timestamp


def dated_records(df: DataFrame, epoch_col: str = S.ACTIVITY_START_EPOCH) -> DataFrame:
    """Raw records -> the same records with ``activityDateTime`` (appended last)
    instead of the epoch column."""
    return df.withColumn(S.ACTIVITY_DATE_TIME, epoch_ms_to_timestamp(epoch_col)).drop(epoch_col)


def partition_by_date(
    df: DataFrame,
    num_partitions: int | None = None,
    ts: str = S.ACTIVITY_DATE_TIME,
) -> DataFrame:
    """Size-balanced partitions, each a contiguous time range (so mostly one
    date). ``num_partitions=None`` uses the session's shuffle partitions,
    which adaptive execution may coalesce."""
    keys = [activity_date(ts), F.col(ts)]
    keys += [F.col(c) for c in (S.GRID_ID, S.COUNTRY_CODE) if c in df.columns]
    if num_partitions is None:
        return df.repartitionByRange(*keys)
    return df.repartitionByRange(num_partitions, *keys)


def hash_partition_by_date(
    df: DataFrame,
    num_partitions: int | None = None,
    ts: str = S.ACTIVITY_DATE_TIME,
    spread: int = 1,
) -> DataFrame:
    """Hash-partition by the date of ``ts``; ``spread > 1`` adds a sub-key
    (hash of grid and time modulo ``spread``) so one date fills up to
    ``spread`` partitions. A re-run sends each row to the same partition."""
    keys = [activity_date(ts)]
    if spread > 1:
        keys.append(F.pmod(F.xxhash64(S.GRID_ID, ts), F.lit(spread)))
    if num_partitions is None:
        return df.repartition(*keys)
    return df.repartition(num_partitions, *keys)
