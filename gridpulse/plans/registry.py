"""Named queries over the driver's test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. Activity queries read the whole
``events`` table through one of the two adapters of ``gridpulse.sources.events``
(``long`` or ``cells``), prepare it under the named null policy, run the
query and cast the result for comparison (decimals to double, timestamps
to zone-less UTC wall-clock time). The word counts read the whole
``documents`` table.

The adapters interpret ``events.ts`` as UTC. The caller's session is left as it
is: one with another time zone gets a sibling session in UTC for the query.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.lookup import null_key_counts, point_lookup
from gridpulse.operators.partitioning import dated_records, hash_partition_by_date
from gridpulse.operators.words import word_count
from gridpulse.plans import late_files, rollup
from gridpulse.plans import queries as Q
from gridpulse.session import ensure_checkpoint_dir
from gridpulse.sinks import write_bucketed, write_for_lookup
from gridpulse.sources.activity import reject_counts, stage_checked
from gridpulse.sources.events import events_as_activity, events_as_cells, events_as_lines, read_events

QueryFn = Callable[[SparkSession, str], DataFrame]

# Separators and stop words of the word-count test case.
TEST_SEPARATORS = "#%?!. "
TEST_STOP_WORDS = ("a", "the", "in", "was", "there", "she", "he")

# The point lookup and the one-grid-one-day ranking parameters.
LOOKUP_GRID = 2
LOOKUP_DAY = _dt.date(2024, 1, 15)
RANKING_GRID = 2
RANKING_DAY = _dt.date(2024, 1, 15)

# The grid and time of the records that tie.
TIED_GRID = -1
TIED_TIME = "2024-01-15 10:00:00"


def comparable(df: DataFrame) -> DataFrame:
    """Final casts for comparison with a zone-less SQL engine: decimal columns
    (exact sums) to double, timestamps to their UTC wall-clock time without a
    zone (``timestamp_ntz``), matching the zone-less input ``events.ts``."""

    def cast(f: T.StructField) -> str:
        if isinstance(f.dataType, T.DecimalType):
            return f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            return f"CAST(`{f.name}` AS TIMESTAMP_NTZ) AS `{f.name}`"
        return f"`{f.name}`"

    return df.selectExpr(*[cast(f) for f in df.schema.fields])


def _utc(spark: SparkSession) -> SparkSession:
    """The session itself if its time zone is UTC, else a sibling in UTC."""
    zone = "spark.sql.session.timeZone"
    if spark.conf.get(zone) in ("UTC", "Etc/UTC", "Z", "+00:00"):
        return spark
    sibling = spark.newSession()
    sibling.conf.set(zone, "UTC")
    return sibling


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_activity(read_events(_utc(spark), sf_dir))


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_cells(read_events(_utc(spark), sf_dir))


def raw_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``long`` records, with the keys of some lost (as after malformed input)."""
    raw = raw_long(spark, sf_dir)
    return raw.withColumns(
        {
            S.COUNTRY_CODE: F.nullif(F.col(S.COUNTRY_CODE), F.lit(0)),
            S.GRID_ID: F.when(F.col(S.GRID_ID) % 11 != 0, F.col(S.GRID_ID)),
        }
    )


def raw_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``long`` records, a third of them moved to one grid and hour with equal measures."""
    events = read_events(_utc(spark), sf_dir)
    moved = {"user_id": F.lit(TIED_GRID), "ts": F.lit(TIED_TIME).cast("timestamp_ntz"), "event_type": F.lit("click"), "value": F.lit(1.0)}
    third = F.col("event_id") % 3 == 0
    return events_as_activity(events.withColumns({c: F.when(third, v).otherwise(F.col(c)) for c, v in moved.items()}))


_ADAPTERS = {"long": raw_long, "cells": raw_cells, "null_keys": raw_null_keys, "tied": raw_tied}


def _activity(
    query: Callable[[DataFrame], DataFrame],
    adapter: str,
    null_policy: str,
    drop_epoch: bool = True,
) -> QueryFn:
    read = _ADAPTERS[adapter]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = prepare_activity(read(spark, sf_dir), null_policy, drop_epoch=drop_epoch)
        return comparable(query(prepared))

    run.__doc__ = f"{query.__name__} on the {adapter} adapter, null policy {null_policy}"
    return run


# Schema of the test table (read without inferring it from the file footer).
DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS_SCHEMA).parquet(f"{sf_dir}/documents.parquet")


def _spread(spark: SparkSession) -> int:
    """Tasks that the texts are spread over: the table is one row group, so one task would read it all."""
    return spark.sparkContext.defaultParallelism


def word_count_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_documents(spark, sf_dir), text_col="text", partitions=_spread(spark))


def word_count_test_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(
        _documents(spark, sf_dir), TEST_SEPARATORS, TEST_STOP_WORDS, text_col="text", partitions=_spread(spark)
    )


def activity_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_long(spark, sf_dir)
    return comparable(hash_partition_by_date(dated_records(raw, epoch_col=S.INTERVAL_START), spread=16))


def point_lookup_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare_activity(raw_cells(spark, sf_dir), S.PROPAGATE, drop_epoch=False)
    return comparable(point_lookup(prepared, **{S.GRID_ID: LOOKUP_GRID, S.ACTIVITY_DATE: LOOKUP_DAY}))


def grid_day_hour_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare_activity(raw_cells(spark, sf_dir), S.PROPAGATE)
    return comparable(Q.grid_day_hour_ranking(prepared, RANKING_GRID, RANKING_DAY))


def null_keys_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_key_counts(raw_long(spark, sf_dir))


def interval_bounds_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(Q.interval_bounds(raw_long(spark, sf_dir)))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared one, for tables that a query writes first."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _rollup(question: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = prepare_activity(raw_long(spark, sf_dir))
        path = _folder(spark, "rollup")
        half = F.dayofmonth(S.ACTIVITY_DATE) <= 15
        for batch, records in (("late", prepared.where(~half)), ("early", prepared.where(half))):
            rollup.add_records(records, path, batch)
        return comparable(rollup.QUESTIONS[question](rollup.read_rollup(prepared.sparkSession, path)))

    run.__doc__ = f"{question} from the shared partial aggregate of two batches of the long adapter"
    return run


def _doubles(query: Callable[[DataFrame], DataFrame], value: str, digits: int) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_long(spark, sf_dir).withColumns({m: F.col(m).cast("double") for m in S.MEASURES})
        return query(prepare_activity(raw, reproducible=True)).withColumn(value, F.round(value, digits))

    run.__doc__ = f"{query.__name__} with measures read as doubles and reproducible sums, rounded to {digits} digits"
    return run


def _checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected records of the events written as text lines."""
    session = _utc(spark)
    lines, table = _folder(spark, "lines"), _folder(spark, "checked")
    events_as_lines(read_events(session, sf_dir)).write.text(lines)
    return stage_checked(session, lines, table, schema=S.activity_schema(T.DecimalType(18, 2)))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_checked(spark, sf_dir)[1])


def daily_peak_hour_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(Q.daily_peak_hour(prepare_activity(_checked(spark, sf_dir)[0])))


def _bucketed(query: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = prepare_activity(raw_long(spark, sf_dir))
        name = f"activity_{uuid.uuid4().hex}"
        return comparable(query(write_bucketed(prepared, name, _folder(spark, "bucketed"), buckets=8)))

    run.__doc__ = f"{query.__name__} on a table of the long adapter that is bucketed by grid"
    return run


def point_lookup_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "lookup")
    prepared = prepare_activity(raw_cells(spark, sf_dir), S.PROPAGATE, drop_epoch=False)
    write_for_lookup(prepared, path)
    stored = prepared.sparkSession.read.schema(prepared.schema).parquet(path)
    return comparable(point_lookup(stored, **{S.GRID_ID: LOOKUP_GRID, S.ACTIVITY_DATE: LOOKUP_DAY}))


def _late(read: Callable[[SparkSession, str], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = read_events(_utc(spark), sf_dir)
        path = _folder(spark, "windows")
        for part in (2, 0, 1):  # three files whose records overlap in time
            late_files.add_file(prepare_activity(events_as_activity(events.where(F.col("event_id") % 3 == part))), path)
        return comparable(read(events.sparkSession, path))

    run.__doc__ = f"{read.__name__} of the long adapter's records, after three files out of order"
    return run


QUERIES: dict[str, QueryFn] = {
    # peaks
    "daily_peak_hour": _activity(Q.daily_peak_hour, "long", S.ZERO),
    "daily_peak_hour_propagate": _activity(Q.daily_peak_hour, "cells", S.PROPAGATE),
    "daily_peak_hour_max": _activity(Q.daily_peak_hour_by_max, "cells", S.PROPAGATE),
    "grid_hour_peak_records": _activity(Q.grid_hour_peak_records, "long", S.ZERO),
    "grid_hour_peak_records_full": _activity(
        lambda p: Q.grid_hour_peak_records(p, all_columns=True), "cells", S.PROPAGATE, drop_epoch=False
    ),
    "grid_daily_peak_hour": _activity(Q.grid_daily_peak_hour, "cells", S.PROPAGATE),
    "grid_daily_peak_window": _activity(Q.grid_daily_peak_window, "cells", S.PROPAGATE),
    "grid_hour_peak_records_tied": _activity(Q.grid_hour_peak_records, "tied", S.ZERO),
    # ranks and averages
    "rank_grids_daily": _activity(Q.rank_grids_daily, "long", S.ZERO),
    "rank_grids_by_peak_hour": _activity(Q.rank_grids_by_peak_hour, "cells", S.PROPAGATE),
    "rank_grid_hours": _activity(Q.rank_grid_hours, "cells", S.PROPAGATE),
    "grid_day_hour_ranking": grid_day_hour_ranking,
    "avg_per_grid_day": _activity(Q.average_per_grid_day, "long", S.ZERO),
    "avg_per_grid_dayofmonth": _activity(Q.average_per_grid_day_of_month, "cells", S.PROPAGATE),
    "avg_per_grid_week": _activity(Q.average_per_grid_window, "cells", S.PROPAGATE),
    "avg_per_grid_day_propagate": _activity(Q.average_per_grid_day, "cells", S.PROPAGATE),
    # the same on one record per event, whose results grow with the table
    "grid_daily_peak_hour_long": _activity(Q.grid_daily_peak_hour, "long", S.ZERO),
    "grid_daily_peak_window_long": _activity(Q.grid_daily_peak_window, "long", S.ZERO),
    "rank_grids_by_peak_hour_long": _activity(Q.rank_grids_by_peak_hour, "long", S.ZERO),
    "rank_grid_hours_long": _activity(Q.rank_grid_hours, "long", S.ZERO),
    "avg_per_grid_dayofmonth_long": _activity(Q.average_per_grid_day_of_month, "long", S.ZERO),
    "avg_per_grid_week_long": _activity(Q.average_per_grid_window, "long", S.ZERO),
    # records whose keys did not parse
    "daily_peak_hour_null_keys": _activity(Q.daily_peak_hour, "null_keys", S.ZERO),
    "rank_grids_daily_null_keys": _activity(Q.rank_grids_daily, "null_keys", S.ZERO),
    "country_categories_null_keys": _activity(Q.country_categories, "null_keys", S.ZERO),
    # categories
    "country_categories": _activity(Q.country_categories, "long", S.ZERO),
    "quantile_categories": _activity(Q.country_quantile_categories, "long", S.ZERO),
    "internet_categories": _activity(Q.internet_categories, "long", S.ZERO),
    "quantile_categories_grids": _activity(
        lambda p: Q.country_quantile_categories(p, buckets=4, key=S.GRID_ID), "long", S.ZERO
    ),
    # one shared partial aggregate
    "daily_peak_hour_rollup": _rollup("busiest_hours"),
    "country_categories_rollup": _rollup("country_bands"),
    "avg_per_grid_day_rollup": _rollup("grid_day_means"),
    "rank_grids_daily_rollup": _rollup("grid_ranking"),
    "grid_hour_peak_records_rollup": _rollup("peak_records"),
    # measures as doubles
    "daily_peak_hour_doubles": _doubles(Q.daily_peak_hour, S.SUMMED_ACTIVITY, 2),
    "avg_per_grid_day_doubles": _doubles(Q.average_per_grid_day, S.AVERAGE_ACTIVITY, 6),
    # checked parsing, stored layouts, late files
    "rejected_records": rejected_records,
    "daily_peak_hour_checked": daily_peak_hour_checked,
    "grid_daily_peak_hour_bucketed": _bucketed(Q.grid_daily_peak_hour),
    "grid_daily_totals_bucketed": _bucketed(Q.A.grid_daily_totals),
    "point_lookup_staged": point_lookup_staged,
    "grid_daily_peak_window_late": _late(late_files.read_peaks),
    "avg_per_grid_week_late": _late(late_files.read_averages),
    # records, lookups, counts
    "activity_by_date": activity_by_date,
    "point_lookup": point_lookup_cells,
    "max_total": _activity(Q.max_total, "cells", S.PROPAGATE),
    "null_key_counts": null_keys_long,
    "interval_bounds": interval_bounds_long,
    # text
    "word_count": word_count_default,
    "word_count_separators": word_count_test_separators,
}
