"""One shared partial aggregate for the five questions of the report.

``add_records`` aggregates the records of one input file (or any batch) to one
row per (grid, date, hour, country) and writes it as a partition of the rollup
table; adding the same batch again replaces it. A row holds what can be merged
with other rows of the same key: the sum and number of the non-null totals, the
number of records, and the largest total with the number of records that have it.
``read_rollup`` merges the batches, and each question rolls the same table up, so
the records are parsed and read once, when their file arrives.

Sums are exact for decimal measures; for doubles they are added per batch first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import hour_of_day
from gridpulse.operators.categories import equal_width_categories
from gridpulse.operators.peaks import peak_rows, with_rank

KEYS = (S.GRID_ID, S.ACTIVITY_DATE, S.HOUR, S.COUNTRY_CODE)
SUM, VALUES, RECORDS, PEAK, PEAK_RECORDS = "totalSum", "totalValues", "records", "peakTotal", "peakRecords"
BATCH = "batch"
#: Copies of a tied peak record that one row stands for when they are written out.
COPIES = 10_000


def merged(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of equal ``keys`` as one. First per (keys, peak), so that tied peaks add up
    with a partial aggregate, then the largest peak of the keys."""
    sums = [F.sum(c).alias(c) for c in (SUM, VALUES, RECORDS)]
    per_peak = rows.groupBy(*keys, PEAK).agg(*sums, F.sum(PEAK_RECORDS).alias(PEAK_RECORDS))
    top = F.max(F.struct(PEAK, PEAK_RECORDS))
    out = per_peak.groupBy(*keys).agg(*sums, top.alias("__top"))
    return out.select(*keys, SUM, VALUES, RECORDS, f"__top.{PEAK}", f"__top.{PEAK_RECORDS}")


def partials(prepared: DataFrame) -> DataFrame:
    """Prepared records -> one mergeable row per (grid, date, hour, country)."""
    total = F.col(S.TOTAL_ACTIVITY)
    one = F.lit(1).cast("bigint")
    rows = prepared.select(
        S.GRID_ID,
        S.ACTIVITY_DATE,
        hour_of_day().alias(S.HOUR),
        S.COUNTRY_CODE,
        total.alias(SUM),
        total.isNotNull().cast("bigint").alias(VALUES),
        one.alias(RECORDS),
        total.alias(PEAK),
        one.alias(PEAK_RECORDS),
    )
    return merged(rows)


def add_records(prepared: DataFrame, path: str, batch: str) -> None:
    """Write the partial rows of one batch to the rollup table at ``path``, replacing the batch if it is there."""
    if not batch or any(c in batch for c in "/=%"):
        raise ValueError(f"not a batch name: {batch!r}")
    partials(prepared).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch}")


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The merged rows of all batches."""
    return merged(spark.read.parquet(path).drop(BATCH))


def _summed(rollup: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    return rollup.groupBy(*keys).agg(F.sum(SUM).alias(alias))


def busiest_hours(rollup: DataFrame) -> DataFrame:
    """``activityDate, hour, summedActivity``: the busiest hour(s) of each day."""
    hourly = _summed(rollup, [S.ACTIVITY_DATE, S.HOUR], S.SUMMED_ACTIVITY)
    return peak_rows(hourly, [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY)


def country_bands(rollup: DataFrame) -> DataFrame:
    """``countryCode, countryActivity, category``."""
    totals = _summed(rollup, [S.COUNTRY_CODE], S.COUNTRY_ACTIVITY)
    return equal_width_categories(totals, S.COUNTRY_ACTIVITY, out=S.CATEGORY)


def grid_day_means(rollup: DataFrame) -> DataFrame:
    """``gridId, activityDate, averageActivity``."""
    mean = F.try_divide(F.sum(SUM).cast("double"), F.sum(VALUES))
    return rollup.groupBy(S.GRID_ID, S.ACTIVITY_DATE).agg(mean.alias(S.AVERAGE_ACTIVITY))


def grid_ranking(rollup: DataFrame) -> DataFrame:
    """``gridId, activityDate, totalActivity, rank``."""
    totals = _summed(rollup, [S.GRID_ID, S.ACTIVITY_DATE], S.TOTAL_ACTIVITY)
    return with_rank(totals, [S.ACTIVITY_DATE], S.TOTAL_ACTIVITY, strategy="range")


def peak_records(rollup: DataFrame) -> DataFrame:
    """``gridId, activityDate, hour, totalActivity``: a row for each record that has the
    largest total of its grid, date and hour. Many tied records are written out in
    pieces of ``COPIES``, spread over tasks."""
    keys = [S.GRID_ID, S.ACTIVITY_DATE, S.HOUR]
    tops = merged(rollup, keys).where(F.col(PEAK).isNotNull())
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({PEAK_RECORDS} - 1) div {COPIES}")))
    pieces = tops.select(*keys, F.col(PEAK).alias(S.TOTAL_ACTIVITY), PEAK_RECORDS, piece.alias("__piece"))
    pieces = pieces.repartition(*keys, "__piece")
    copies = F.least(F.lit(COPIES).cast("bigint"), F.col(PEAK_RECORDS) - F.col("__piece") * COPIES)
    return pieces.select(*keys, S.TOTAL_ACTIVITY, F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).drop("col")


QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "busiest_hours": busiest_hours,
    "country_bands": country_bands,
    "grid_day_means": grid_day_means,
    "grid_ranking": grid_ranking,
    "peak_records": peak_records,
}
