"""Adapters that present a generic ``events`` table as activity records.

The test tables carry no telephone activity, so these two mappings turn
``events(event_id, ts, user_id, event_type, value, props)`` into the activity
schema. Both are plain Spark projections / aggregations over the whole table.

``long``  -- one record per event: grid = user_id, country = user_id % 25,
             interval start = the event time, and the event's value in the
             measure of its type; the other four measures are null.
``cells`` -- one record per (user_id % 5, 6-hour bucket): grid = country =
             user_id % 5, interval start = bucket start, each measure the sum
             of its type's values (null when the type is absent).

Measures are cast to ``decimal(18,2)`` (source values have two decimals) so
that sums are exact and independent of row order. ``events.ts`` has no time
zone; it is read as a UTC wall-clock time, so run with the session time zone
set to UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S

# Event type -> measure column.
EVENT_TYPE_TO_MEASURE: dict[str, str] = {
    "purchase": S.SMS_IN,
    "signup": S.SMS_OUT,
    "view": S.CALL_IN,
    "error": S.CALL_OUT,
    "click": S.INTERNET,
}
LONG_COUNTRIES = 25
CELL_GRIDS = 5
CELL_BUCKET_MS = 6 * 3600 * 1000
MEASURE_TYPE = "decimal(18,2)"

# Which events' lines are damaged (the first that holds).
SHORT_EVERY, LONG_EVERY, BAD_KEY_EVERY, BAD_MEASURE_EVERY = 7, 17, 11, 13


# Schema of the test table (read without inferring it from the file footer).
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Epoch milliseconds of the zone-less event time, read as UTC wall-clock time.
_EPOCH_MS = "unix_millis(CAST(ts AS TIMESTAMP))"


def _measure_exprs(value: str = "value") -> dict[str, str]:
    """measure -> SQL: the event's value when its type maps to that measure."""
    return {
        m: f"CASE WHEN event_type = '{t}' THEN CAST({value} AS {MEASURE_TYPE}) END"
        for t, m in EVENT_TYPE_TO_MEASURE.items()
    }


def events_as_activity(events: DataFrame) -> DataFrame:
    """``long`` adapter: one activity record per event."""
    measures = _measure_exprs()
    return events.selectExpr(
        f"CAST(user_id AS INT) AS {S.GRID_ID}",
        f"{_EPOCH_MS} AS {S.INTERVAL_START}",
        f"CAST(user_id % {LONG_COUNTRIES} AS INT) AS {S.COUNTRY_CODE}",
        *[f"{measures[m]} AS {m}" for m in S.MEASURES],
    )


def events_as_cells(events: DataFrame) -> DataFrame:
    """``cells`` adapter: per-type sums per (user_id % 5, 6-hour bucket)."""
    measures = _measure_exprs()
    grid = f"CAST(user_id % {CELL_GRIDS} AS INT)"
    bucket = f"floor({_EPOCH_MS} / {CELL_BUCKET_MS}) * {CELL_BUCKET_MS}"
    return (
        events.groupBy(F.expr(grid).alias(S.GRID_ID), F.expr(bucket).alias(S.INTERVAL_START))
        .agg(*[F.expr(f"CAST(sum({measures[m]}) AS {MEASURE_TYPE})").alias(m) for m in S.MEASURES])
        .selectExpr(S.GRID_ID, S.INTERVAL_START, f"{S.GRID_ID} AS {S.COUNTRY_CODE}", *S.MEASURES)
    )


def events_as_lines(events: DataFrame) -> DataFrame:
    """The ``long`` records as tab-delimited text lines (``value``), some damaged as files
    are: by the event's number a line loses fields, gets one too many, or holds text
    in its grid or its internet volume."""
    measures = _measure_exprs()
    fields = ["CAST(user_id AS STRING)", f"CAST({_EPOCH_MS} AS STRING)", f"CAST(user_id % {LONG_COUNTRIES} AS STRING)"]
    fields += [f"coalesce(CAST({measures[m]} AS STRING), '')" for m in S.MEASURES]

    def line(parts: list[str]) -> str:
        return f"concat_ws('\t', {', '.join(parts)})"

    damage = " ".join(
        f"WHEN event_id % {n} = 0 THEN {line(parts)}"
        for n, parts in (
            (SHORT_EVERY, fields[:5]),
            (LONG_EVERY, [*fields, "'1'"]),
            (BAD_KEY_EVERY, ["'x'", *fields[1:]]),
            (BAD_MEASURE_EVERY, [*fields[:-1], "'n/a'"]),
        )
    )
    return events.selectExpr(f"CASE {damage} ELSE {line(fields)} END AS value")


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
