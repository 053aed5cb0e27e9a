"""

``entry(spark)`` runs the flagship query (busiest hour of each day) on
/root/testdata/sf0.001. ``queries()`` maps each implemented query to a
``(spark, sf_dir) -> DataFrame`` callable; ``oracle_sql()`` gives, for the same
names, DuckDB SQL over the pre-registered test tables that states the same
semantics independently (``max() OVER`` where Spark uses ``rank()``, list
indexing for quantiles, and so on).

The activity queries read ``events`` through the ``long`` / ``cells`` adapters
(see ``gridpulse/sources/events.py``); the SQL below rebuilds both adapters.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent
if str(_ROOT) not in sys.path:
    sys.path.insert(0, str(_ROOT))

from gridpulse.operators.words import DEFAULT_STOP_WORDS  # noqa: E402
from gridpulse.plans import registry  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from gridpulse.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

ENTRY_SF_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return registry.QUERIES["daily_peak_hour"](spark, ENTRY_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = dict(registry.QUERIES)
    if llm is not None:
        named |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# --------------------------------------------------------------------------

# Event type -> measure, as in the adapters.
_MEASURE_TYPES = [
    ("smsIn", "purchase"),
    ("smsOut", "signup"),
    ("callIn", "view"),
    ("callOut", "error"),
    ("internet", "click"),
]
_MEASURES = [m for m, _ in _MEASURE_TYPES]
_DEC = "DECIMAL(18,2)"


def _long_raw(grid: str = "user_id", country: str = "user_id % 25", events: str = "events") -> str:
    measures = ",\n    ".join(
        f"CASE WHEN event_type = '{t}' THEN CAST(value AS {_DEC}) END AS {m}" for m, t in _MEASURE_TYPES
    )
    return f"""raw AS (
  SELECT CAST({grid} AS INTEGER) AS gridId,
    epoch_us(ts) // 1000 AS intervalStart,
    CAST({country} AS INTEGER) AS countryCode,
    {measures}
  FROM {events})"""


def _cells_raw() -> str:
    measures = ",\n    ".join(
        f"CAST(sum(CASE WHEN event_type = '{t}' THEN CAST(value AS {_DEC}) END) AS {_DEC}) AS {m}"
        for m, t in _MEASURE_TYPES
    )
    return f"""raw AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS gridId,
    (epoch_us(ts) // 1000 // 21600000) * 21600000 AS intervalStart,
    CAST(user_id % 5 AS INTEGER) AS countryCode,
    {measures}
  FROM events GROUP BY ALL)"""


def _null_keys_raw() -> str:
    return _long_raw("CASE WHEN user_id % 11 <> 0 THEN user_id END", "nullif(user_id % 25, 0)")


def _tied_raw() -> str:
    moved = {"user_id": registry.TIED_GRID, "ts": f"TIMESTAMP '{registry.TIED_TIME}'", "event_type": "'click'", "value": 1.0}
    columns = ", ".join(f"CASE WHEN event_id % 3 = 0 THEN {v} ELSE {c} END AS {c}" for c, v in moved.items())
    return _long_raw(events=f"(SELECT {columns} FROM events)")


# The damaged lines of the text adapter, by event number (the first that holds).
_DAMAGE = [(7, "short line"), (17, "long line"), (11, "bad key"), (13, "bad measure")]


def _checked_raw() -> str:
    good = " AND ".join(f"event_id % {n} <> 0" for n, _ in _DAMAGE)
    return _long_raw(events=f"(SELECT * FROM events WHERE {good})")


_RAW = {"checked": _checked_raw, "long": _long_raw, "cells": _cells_raw, "null_keys": _null_keys_raw, "tied": _tied_raw}


def _ts_of(ms: str) -> str:
    """Epoch ms -> TIMESTAMP floored to the second."""
    return f"epoch_ms(CAST(floor({ms} / 1000) AS BIGINT) * 1000)"


def _act(adapter: str, policy: str) -> str:
    """``WITH raw, act``: the prepared frame (all columns, epoch kept)."""
    if policy == "zero":
        measures = ", ".join(f"coalesce({m}, 0) AS {m}" for m in _MEASURES)
    else:
        measures = ", ".join(_MEASURES)
    total = " + ".join(_MEASURES)
    return f"""WITH {_RAW[adapter]()},
filled AS (SELECT gridId, intervalStart, countryCode, {measures} FROM raw),
act AS (
  SELECT gridId, intervalStart, countryCode, {", ".join(_MEASURES)},
    {_ts_of("intervalStart")} AS activityDateTime,
    {total} AS totalActivity,
    CAST({_ts_of("intervalStart")} AS DATE) AS activityDate
  FROM filled)"""


_HOUR = "CAST(hour(activityDateTime) AS INTEGER)"


def _dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {c}"


def _q_daily_peak_hour(adapter: str, policy: str) -> str:
    return f"""{_act(adapter, policy)},
agg AS (SELECT activityDate, {_HOUR} AS hour, sum(totalActivity) AS summedActivity FROM act GROUP BY ALL)
SELECT activityDate, hour, {_dbl("summedActivity")} FROM (
  SELECT *, rank() OVER (PARTITION BY activityDate ORDER BY summedActivity DESC NULLS LAST) AS rk FROM agg)
WHERE rk = 1"""


def _q_daily_peak_hour_max() -> str:
    return f"""{_act("cells", "propagate")},
agg AS (SELECT activityDate AS date, {_HOUR} AS hour, sum(totalActivity) AS hourlyTotalActivity FROM act GROUP BY ALL)
SELECT date, hour, {_dbl("hourlyTotalActivity")} FROM (
  SELECT *, max(hourlyTotalActivity) OVER (PARTITION BY date) AS mx FROM agg)
WHERE hourlyTotalActivity = mx"""


def _q_grid_hour_peak_records(adapter: str = "long") -> str:
    return f"""{_act(adapter, "zero")},
rows AS (SELECT gridId, activityDate, {_HOUR} AS hour, totalActivity FROM act)
SELECT gridId, activityDate, hour, {_dbl("totalActivity")} FROM (
  SELECT *, max(totalActivity) OVER (PARTITION BY gridId, activityDate, hour) AS mx FROM rows)
WHERE totalActivity = mx"""


def _q_grid_hour_peak_records_full() -> str:
    measures = ", ".join(_dbl(m) for m in _MEASURES)
    return f"""{_act("cells", "propagate")},
rows AS (SELECT *, {_HOUR} AS hour FROM act)
SELECT gridId, intervalStart, countryCode, {measures}, activityDateTime, {_dbl("totalActivity")}, activityDate, hour
FROM (SELECT *, max(totalActivity) OVER (PARTITION BY gridId, activityDate, hour) AS mx FROM rows)
WHERE totalActivity = mx"""


_GRID_HOURLY = f"grid_hourly AS (SELECT gridId, activityDate, {_HOUR} AS hour, sum(totalActivity) AS summedActivity FROM act GROUP BY ALL)"
_GRID_PEAK = """grid_peak AS (
  SELECT gridId, activityDate, hour, summedActivity FROM (
    SELECT *, rank() OVER (PARTITION BY gridId, activityDate ORDER BY summedActivity DESC NULLS LAST) AS rk
    FROM grid_hourly) WHERE rk = 1)"""


def _q_grid_daily_peak_hour(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)},
{_GRID_HOURLY},
{_GRID_PEAK}
SELECT gridId, activityDate, hour, {_dbl("summedActivity")} FROM grid_peak"""


def _q_grid_daily_peak_window(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)},
win AS (
  SELECT gridId, activityDate AS date, date_trunc('hour', activityDateTime) AS start,
    sum(totalActivity) AS summedActivity
  FROM act GROUP BY ALL)
SELECT gridId, start, start + INTERVAL 1 HOUR AS "end", {_dbl("summedActivity")} FROM (
  SELECT *, max(summedActivity) OVER (PARTITION BY gridId, date) AS mx FROM win)
WHERE summedActivity = mx"""


def _rank(order: str, part: str = "activityDate") -> str:
    return f"CAST(rank() OVER (PARTITION BY {part} ORDER BY {order} DESC NULLS LAST) AS INTEGER) AS rank"


def _q_rank_grids_daily(adapter: str = "long", policy: str = "zero") -> str:
    return f"""{_act(adapter, policy)},
daily AS (SELECT gridId, activityDate, sum(totalActivity) AS totalActivity FROM act GROUP BY ALL)
SELECT gridId, activityDate, {_dbl("totalActivity")}, {_rank("totalActivity")} FROM daily"""


def _q_rank_grids_by_peak_hour(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)},
{_GRID_HOURLY},
{_GRID_PEAK}
SELECT gridId, activityDate, hour, {_dbl("summedActivity")}, {_rank("summedActivity")} FROM grid_peak"""


def _q_rank_grid_hours(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)},
{_GRID_HOURLY}
SELECT gridId, activityDate, hour, {_dbl("summedActivity")}, {_rank("summedActivity")} FROM grid_hourly"""


def _q_grid_day_hour_ranking() -> str:
    return f"""{_act("cells", "propagate")},
one AS (SELECT * FROM act WHERE gridId = 2 AND activityDate = DATE '2024-01-15'),
hourly AS (SELECT activityDate, {_HOUR} AS hour, sum(totalActivity) AS summedActivity FROM one GROUP BY ALL)
SELECT activityDate, hour, {_dbl("summedActivity")}, {_rank("summedActivity")} FROM hourly"""


def _avg(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / count({c})"


def _q_avg_per_grid_day(adapter: str = "long", policy: str = "zero") -> str:
    return f"""{_act(adapter, policy)}
SELECT gridId, activityDate, {_avg("totalActivity")} AS averageActivity FROM act GROUP BY ALL"""


def _q_avg_per_grid_dayofmonth(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)}
SELECT gridId, CAST(dayofmonth(activityDateTime) AS INTEGER) AS date, {_avg("totalActivity")} AS avgActivity
FROM act GROUP BY ALL"""


def _q_avg_per_grid_week(adapter: str = "cells", policy: str = "propagate") -> str:
    return f"""{_act(adapter, policy)},
wk AS (
  SELECT gridId,
    time_bucket(INTERVAL 7 DAY, CAST(activityDate AS TIMESTAMP), TIMESTAMP '1970-01-01') AS start,
    totalActivity
  FROM act)
SELECT gridId, start, start + INTERVAL 7 DAY AS "end", {_avg("totalActivity")} AS averageActivity
FROM wk GROUP BY gridId, start"""


def _q_country_categories(adapter: str = "long", policy: str = "zero") -> str:
    return f"""{_act(adapter, policy)},
ct AS (SELECT countryCode, CAST(sum(totalActivity) AS DOUBLE) AS countryActivity FROM act GROUP BY ALL),
b AS (SELECT min(countryActivity) AS lo, (max(countryActivity) - min(countryActivity)) / 3.0 AS step FROM ct)
SELECT countryCode, countryActivity,
  CASE WHEN countryActivity IS NULL THEN NULL
       WHEN countryActivity < lo + step * 1.0 THEN 'low'
       WHEN countryActivity < lo + step * 2.0 THEN 'medium'
       ELSE 'high' END AS category
FROM ct, b"""


def _quantile_sums(key: str = "countryCode", buckets: int = 3) -> str:
    columns = ("sms", "call", "internet")
    splits = ", ".join(
        f"quantile_disc({c}, CAST({i} AS DOUBLE) / {buckets}) AS {c}_q{i}" for c in columns for i in range(1, buckets)
    )

    def bucket(c: str) -> str:
        steps = [f"CASE WHEN {c}_q1 <= {c} THEN 1 ELSE 0 END"]
        steps += [f"CASE WHEN {c}_q{i} <= {c} AND {c}_q{i} <> {c}_q{i - 1} THEN 1 ELSE 0 END" for i in range(2, buckets)]
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST({' + '.join(steps)} AS DOUBLE) END AS {c}Category"

    return f"""{_act("long", "zero")},
ct AS (
  SELECT {key},
    CAST(sum(smsIn + smsOut) AS DOUBLE) AS sms,
    CAST(sum(callIn + callOut) AS DOUBLE) AS call,
    CAST(sum(internet) AS DOUBLE) AS internet
  FROM act GROUP BY ALL),
qs AS (SELECT {splits} FROM ct),
cat AS (SELECT {key}, sms, call, internet, {", ".join(bucket(c) for c in columns)} FROM ct, qs)"""


def _q_quantile_categories(key: str = "countryCode", buckets: int = 3) -> str:
    return f"""{_quantile_sums(key, buckets)}
SELECT * FROM cat"""


def _q_internet_categories() -> str:
    return f"""{_quantile_sums()}
SELECT DISTINCT internetCategory FROM cat"""


def _q_activity_by_date() -> str:
    measures = ", ".join(_dbl(m) for m in _MEASURES)
    return f"""WITH {_long_raw()}
SELECT gridId, countryCode, {measures}, {_ts_of("intervalStart")} AS activityDateTime FROM raw"""


def _q_point_lookup() -> str:
    measures = ", ".join(_dbl(m) for m in _MEASURES)
    return f"""{_act("cells", "propagate")}
SELECT gridId, intervalStart, countryCode, {measures}, activityDateTime, {_dbl("totalActivity")}, activityDate
FROM act WHERE gridId = 2 AND activityDate = DATE '2024-01-15'"""


def _q_rejected_records() -> str:
    reason = " ".join(f"WHEN event_id % {n} = 0 THEN '{r}'" for n, r in _DAMAGE)
    return f"""SELECT reason, count(*) AS records FROM (SELECT CASE {reason} END AS reason FROM events)
WHERE reason IS NOT NULL GROUP BY reason"""


def _rounded(sql: str, column: str, digits: int) -> str:
    return f"SELECT * REPLACE (round({column}, {digits}) AS {column}) FROM ({sql})"


def _q_grid_daily_totals() -> str:
    return f"""{_act("long", "zero")}
SELECT gridId, activityDate, CAST(sum(totalActivity) AS DOUBLE) AS totalActivity FROM act GROUP BY ALL"""


def _q_max_total() -> str:
    return f"""{_act("cells", "propagate")}
SELECT CAST(max(totalActivity) AS DOUBLE) AS maxTotalActivity FROM act"""


def _q_null_key_counts() -> str:
    return f"""WITH {_long_raw()}
SELECT count(*) AS records,
  CAST(count_if(gridId IS NULL) AS BIGINT) AS null_gridId,
  CAST(count_if(intervalStart IS NULL) AS BIGINT) AS null_intervalStart,
  CAST(count_if(countryCode IS NULL) AS BIGINT) AS null_countryCode
FROM raw"""


def _q_interval_bounds() -> str:
    return f"""WITH {_long_raw()}
SELECT gridId, {_ts_of("intervalStart")} AS start, {_ts_of("intervalStart")} + INTERVAL 600 SECOND AS "end" FROM raw"""


def _q_word_count(char_class: str, stop_words: list[str]) -> str:
    stops = ", ".join(f"'{w}'" for w in stop_words)
    return f"""SELECT word, count(*) AS count FROM (
  SELECT lower(regexp_replace(tok, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS word
  FROM (SELECT unnest(string_split_regex(text, '{char_class}')) AS tok FROM documents))
WHERE length(word) > 0 AND word NOT IN ({stops})
GROUP BY word"""


def oracle_sql() -> dict[str, str]:
    extra = {}
    if llm is not None:
        extra = llm.ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return extra | {
        "daily_peak_hour": _q_daily_peak_hour("long", "zero"),
        "daily_peak_hour_propagate": _q_daily_peak_hour("cells", "propagate"),
        "daily_peak_hour_max": _q_daily_peak_hour_max(),
        "grid_hour_peak_records": _q_grid_hour_peak_records(),
        "grid_hour_peak_records_tied": _q_grid_hour_peak_records("tied"),
        "grid_hour_peak_records_full": _q_grid_hour_peak_records_full(),
        "grid_daily_peak_hour": _q_grid_daily_peak_hour(),
        "grid_daily_peak_window": _q_grid_daily_peak_window(),
        "rank_grids_daily": _q_rank_grids_daily(),
        "rank_grids_by_peak_hour": _q_rank_grids_by_peak_hour(),
        "rank_grid_hours": _q_rank_grid_hours(),
        "grid_day_hour_ranking": _q_grid_day_hour_ranking(),
        "avg_per_grid_day": _q_avg_per_grid_day(),
        "avg_per_grid_dayofmonth": _q_avg_per_grid_dayofmonth(),
        "avg_per_grid_week": _q_avg_per_grid_week(),
        "avg_per_grid_day_propagate": _q_avg_per_grid_day("cells", "propagate"),
        "grid_daily_peak_hour_long": _q_grid_daily_peak_hour("long", "zero"),
        "grid_daily_peak_window_long": _q_grid_daily_peak_window("long", "zero"),
        "rank_grids_by_peak_hour_long": _q_rank_grids_by_peak_hour("long", "zero"),
        "rank_grid_hours_long": _q_rank_grid_hours("long", "zero"),
        "avg_per_grid_dayofmonth_long": _q_avg_per_grid_dayofmonth("long", "zero"),
        "avg_per_grid_week_long": _q_avg_per_grid_week("long", "zero"),
        "daily_peak_hour_null_keys": _q_daily_peak_hour("null_keys", "zero"),
        "rank_grids_daily_null_keys": _q_rank_grids_daily("null_keys"),
        "country_categories_null_keys": _q_country_categories("null_keys"),
        "country_categories": _q_country_categories(),
        "quantile_categories": _q_quantile_categories(),
        "internet_categories": _q_internet_categories(),
        "quantile_categories_grids": _q_quantile_categories("gridId", 4),
        "daily_peak_hour_rollup": _q_daily_peak_hour("long", "zero"),
        "country_categories_rollup": _q_country_categories(),
        "avg_per_grid_day_rollup": _q_avg_per_grid_day(),
        "rank_grids_daily_rollup": _q_rank_grids_daily(),
        "grid_hour_peak_records_rollup": _q_grid_hour_peak_records(),
        "daily_peak_hour_doubles": _rounded(_q_daily_peak_hour("long", "zero"), "summedActivity", 2),
        "avg_per_grid_day_doubles": _rounded(_q_avg_per_grid_day(), "averageActivity", 6),
        "rejected_records": _q_rejected_records(),
        "daily_peak_hour_checked": _q_daily_peak_hour("checked", "zero"),
        "grid_daily_peak_hour_bucketed": _q_grid_daily_peak_hour("long", "zero"),
        "grid_daily_totals_bucketed": _q_grid_daily_totals(),
        "point_lookup_staged": _q_point_lookup(),
        "grid_daily_peak_window_late": _q_grid_daily_peak_window("long", "zero"),
        "avg_per_grid_week_late": _q_avg_per_grid_week("long", "zero"),
        "activity_by_date": _q_activity_by_date(),
        "point_lookup": _q_point_lookup(),
        "max_total": _q_max_total(),
        "null_key_counts": _q_null_key_counts(),
        "interval_bounds": _q_interval_bounds(),
        "word_count": _q_word_count("[ ]", list(DEFAULT_STOP_WORDS)),
        "word_count_separators": _q_word_count("[#%?!. ]", list(registry.TEST_STOP_WORDS)),
    }
