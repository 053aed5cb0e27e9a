"""Random inputs against brute-force Python definitions of the same questions."""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.categories import equal_width_categories
from gridpulse.operators.peaks import peak_rows
from gridpulse.operators.words import word_count
from gridpulse.plans import queries as Q

BASE_MS = 1383264000000  # 2013-11-01T00:00:00Z
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

measure = st.one_of(st.none(), st.integers(0, 6).map(float))
record = st.tuples(
    st.integers(1, 3),  # grid
    st.integers(0, 3 * 86_400_000 - 1).map(lambda d: BASE_MS + d - d % 1_200_000),  # 20-minute slots over 3 days
    st.integers(1, 3),  # country
    measure,
    measure,
    measure,
    measure,
    measure,
)
records = st.lists(record, min_size=1, max_size=40)


def _total(r, policy):
    ms = r[3:]
    if policy == S.ZERO:
        return sum(m or 0.0 for m in ms)
    return None if any(m is None for m in ms) else sum(ms)


def _when(ms):
    t = dt.datetime.fromtimestamp(ms // 1000, dt.timezone.utc)
    return t.date(), t.hour


def _peaks(groups):
    """group key -> {member: value}; members with the top value (all, if none is set)."""
    out = set()
    for key, members in groups.items():
        vals = [v for v in members.values() if v is not None]
        top = max(vals) if vals else None
        out |= {(key, m, v) for m, v in members.items() if v == top}
    return out


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) if vals else None


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES))
def test_daily_peak_hour(spark, rows, policy):
    hourly = defaultdict(list)
    for r in rows:
        hourly[_when(r[1])].append(_total(r, policy))
    by_day = defaultdict(dict)
    for (day, hour), vals in hourly.items():
        by_day[day][hour] = _sum(vals)
    want = _peaks(by_day)
    df = spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)
    got = {(r[0], r[1], r[2]) for r in Q.daily_peak_hour(prepare_activity(df, policy)).collect()}
    assert got == want


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES))
def test_grid_hour_peak_records(spark, rows, policy):
    want = defaultdict(int)
    groups = defaultdict(list)
    for r in rows:
        day, hour = _when(r[1])
        groups[(r[0], day, hour)].append(_total(r, policy))
    for key, vals in groups.items():
        present = [v for v in vals if v is not None]
        if present:
            want[(*key, max(present))] += sum(1 for v in present if v == max(present))
    df = spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)
    got = defaultdict(int)
    for r in Q.grid_hour_peak_records(prepare_activity(df, policy)).collect():
        got[tuple(r)] += 1
    assert got == want


@SETTINGS
@given(records)
def test_rank_grids_daily(spark, rows):
    daily = defaultdict(float)
    for r in rows:
        daily[(r[0], _when(r[1])[0])] += _total(r, S.ZERO)
    want = set()
    for (grid, day), v in daily.items():
        higher = sum(1 for (g2, d2), v2 in daily.items() if d2 == day and v2 > v)
        want.add((grid, day, v, 1 + higher))
    df = spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)
    got = {tuple(r) for r in Q.rank_grids_daily(prepare_activity(df)).collect()}
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-50, 50).map(float), min_size=1, max_size=30))
def test_equal_width_categories(spark, values):
    lo, hi = min(values), max(values)
    step = (hi - lo) / 3.0
    want = ["low" if v < lo + step else "medium" if v < lo + 2 * step else "high" for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    got = [r.category for r in equal_width_categories(df, "v").orderBy("k").collect()]
    assert got == want


_alphabet = st.sampled_from(list("ab CD.\t\n#!?") + ["The", "the", "x"])


@SETTINGS
@given(st.lists(st.lists(_alphabet, max_size=12).map("".join), min_size=1, max_size=6))
def test_word_count(spark, lines):
    seps = " .#"
    stops = {"the", "a"}
    want = defaultdict(int)
    for line in lines:
        for tok in re.split("[" + re.escape(seps) + "]", line):
            w = re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", tok).lower()
            if w and w not in stops:
                want[w] += 1
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.word: r["count"] for r in word_count(df, seps, stops).collect()}
    assert got == dict(want)


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES), st.booleans())
def test_peak_strategies_agree(spark, rows, policy, drop_null_peaks):
    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA), policy)
    keys = [S.GRID_ID, S.ACTIVITY_DATE]
    by_window = peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks)
    by_join = peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks, strategy="join")
    assert by_join.columns == by_window.columns
    assert sorted(map(tuple, by_join.collect()), key=repr) == sorted(map(tuple, by_window.collect()), key=repr)


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES))
def test_average_per_grid_day(spark, rows, policy):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[0], _when(r[1])[0])].append(_total(r, policy))
    want = set()
    for key, vals in groups.items():
        present = [v for v in vals if v is not None]
        want.add((*key, sum(present) / len(present) if present else None))
    df = spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)
    got = {tuple(r) for r in Q.average_per_grid_day(prepare_activity(df, policy)).collect()}
    assert got == want


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES))
def test_grid_daily_peak_hour_and_window(spark, rows, policy):
    hourly = defaultdict(list)
    for r in rows:
        day, hour = _when(r[1])
        hourly[(r[0], day, hour)].append(_total(r, policy))
    by_grid_day = defaultdict(dict)
    for (grid, day, hour), vals in hourly.items():
        by_grid_day[(grid, day)][hour] = _sum(vals)
    want_hours = {(g, d, h, v) for (g, d), h, v in _peaks(by_grid_day)}
    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA), policy)
    got_hours = {tuple(r) for r in Q.grid_daily_peak_hour(df).collect()}
    assert got_hours == want_hours
    # the window form drops groups without a value and reports window bounds
    want_windows = {
        (g, dt.datetime.combine(d, dt.time(h)), dt.datetime.combine(d, dt.time(h)) + dt.timedelta(hours=1), v)
        for g, d, h, v in want_hours
        if v is not None
    }
    got_windows = {tuple(r) for r in Q.grid_daily_peak_window(df).collect()}
    assert got_windows == want_windows


@SETTINGS
@given(records, st.sampled_from(S.NULL_POLICIES), st.integers(1, 7))
def test_rank_strategies_agree(spark, rows, policy, parts):
    from gridpulse.operators.peaks import with_rank

    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA), policy)
    keys = [S.ACTIVITY_DATE]
    by_window = with_rank(df, keys, S.TOTAL_ACTIVITY)
    by_range = with_rank(df.repartition(parts), keys, S.TOTAL_ACTIVITY, strategy="range")
    assert by_range.columns == by_window.columns
    assert by_range.schema == by_window.schema
    assert sorted(map(tuple, by_range.collect()), key=repr) == sorted(map(tuple, by_window.collect()), key=repr)
