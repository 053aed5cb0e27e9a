"""Incremental form of the time-bucketed sums, for activity files that keep
arriving in a folder (one file per day, say).

The batch operators are plain DataFrame functions, so preparing a streaming
frame works unchanged. Ranking windows (``rank()``) are not available on
streams; what streams is the windowed sum per grid cell, with a watermark
that bounds the state kept for late records. Feed its finalized windows to
the batch peak/rank functions (e.g. in ``foreachBatch``) or write them out.
Start the query with a ``checkpointLocation`` in shared storage, so that a
restarted query resumes from its offsets and state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity


def read_activity_stream(
    spark: SparkSession,
    path: str,
    delimiter: str = "\t",
    schema: T.StructType = S.ACTIVITY_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of headerless delimited activity files in ``path``."""
    reader = spark.readStream.schema(schema).option("delimiter", delimiter).option("header", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def grid_window_totals_stream(
    raw_stream: DataFrame,
    watermark: str,
    null_policy: str = S.ZERO,
    duration: str = "1 hour",
    keys: tuple[str, ...] = (S.GRID_ID,),
) -> DataFrame:
    """``<keys>, start, end, summedActivity`` per tumbling window, updated as
    records arrive (``keys=()`` gives network-wide totals). With output mode
    ``append`` a window is emitted once the watermark passes its end; records
    later than ``watermark`` are discarded, so the caller has to choose it."""
    prepared = prepare_activity(raw_stream, null_policy)
    sums = (
        prepared.withWatermark(S.ACTIVITY_DATE_TIME, watermark)
        .groupBy(*keys, F.window(S.ACTIVITY_DATE_TIME, duration))
        .agg(F.sum(S.TOTAL_ACTIVITY).alias(S.SUMMED_ACTIVITY))
    )
    return sums.select(
        *keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), S.SUMMED_ACTIVITY
    )


__all__ = ["grid_window_totals_stream", "read_activity_stream"]
