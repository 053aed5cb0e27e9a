"""Hand-computed cases for the peak, rank, average and category queries."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import epoch_ms, rec

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.categories import equal_width_categories, quantile_categories
from gridpulse.operators.peaks import peak_rows, with_rank
from gridpulse.plans import queries as Q

D1 = dt.date(2013, 11, 1)
D2 = dt.date(2013, 11, 2)


def _tie_day(activity):
    # 2013-11-01: hour 10 sums to 5 (2 + 3), hour 11 to 5, hour 12 to 1.
    return activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 10, 0), internet=2.0),
            rec(2, epoch_ms(2013, 11, 1, 10, 10), internet=3.0),
            rec(1, epoch_ms(2013, 11, 1, 11, 0), internet=5.0),
            rec(1, epoch_ms(2013, 11, 1, 12, 0), internet=1.0),
            rec(1, epoch_ms(2013, 11, 2, 3, 0), internet=4.0),
        ]
    )


def test_daily_peak_hour_keeps_ties(activity):
    out = Q.daily_peak_hour(prepare_activity(_tie_day(activity)))
    got = sorted((r[S.ACTIVITY_DATE], r[S.HOUR], r[S.SUMMED_ACTIVITY]) for r in out.collect())
    assert got == [(D1, 10, 5.0), (D1, 11, 5.0), (D2, 3, 4.0)]
    assert out.columns == [S.ACTIVITY_DATE, S.HOUR, S.SUMMED_ACTIVITY]


def test_rank_after_tie_skips(activity):
    df = Q.A.hourly_totals(prepare_activity(_tie_day(activity)))
    ranked = with_rank(df, [S.ACTIVITY_DATE], S.SUMMED_ACTIVITY).where(f"{S.ACTIVITY_DATE} = date'2013-11-01'")
    assert sorted((r[S.HOUR], r["rank"]) for r in ranked.collect()) == [(10, 1), (11, 1), (12, 3)]


def _all_null_day(activity):
    return activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 9), internet=None),
            rec(1, epoch_ms(2013, 11, 1, 10), sms_in=None),
            rec(1, epoch_ms(2013, 11, 2, 9), internet=2.0),
        ]
    )


def test_all_null_group_kept_by_rank_dropped_by_max(activity):
    prepared = prepare_activity(_all_null_day(activity), S.PROPAGATE)
    by_rank = Q.daily_peak_hour(prepared).collect()
    assert sorted((r[S.ACTIVITY_DATE], r[S.HOUR]) for r in by_rank) == [(D1, 9), (D1, 10), (D2, 9)]
    assert all(r[S.SUMMED_ACTIVITY] is None for r in by_rank if r[S.ACTIVITY_DATE] == D1)
    by_max = Q.daily_peak_hour_by_max(prepared)
    assert by_max.columns == ["date", S.HOUR, "hourlyTotalActivity"]
    assert [(r.date, r.hour) for r in by_max.collect()] == [(D2, 9)]


def test_peak_records_are_records_not_sums(activity):
    raw = activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 10, 0), internet=2.0),
            rec(1, epoch_ms(2013, 11, 1, 10, 10), internet=3.0),
            rec(1, epoch_ms(2013, 11, 1, 10, 20), internet=3.0),
            rec(2, epoch_ms(2013, 11, 1, 10, 0), internet=None),
        ]
    )
    prepared = prepare_activity(raw, S.PROPAGATE)
    recs = Q.grid_hour_peak_records(prepared)
    assert recs.columns == [S.GRID_ID, S.ACTIVITY_DATE, S.HOUR, S.TOTAL_ACTIVITY]
    assert sorted(r[S.TOTAL_ACTIVITY] for r in recs.collect()) == [3.0, 3.0]  # grid 2 has only null
    full = Q.grid_hour_peak_records(prepared, all_columns=True)
    assert full.columns[-1] == S.HOUR and S.SMS_IN in full.columns
    # the per-grid busiest hour sums instead
    hours = Q.grid_daily_peak_hour(prepared).collect()
    assert sorted((r[S.GRID_ID], r[S.SUMMED_ACTIVITY]) for r in hours) == [(1, 8.0), (2, None)]


def test_peak_window_bounds(activity):
    raw = activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 10, 5), internet=2.0),
            rec(1, epoch_ms(2013, 11, 1, 10, 55), internet=2.0),
            rec(1, epoch_ms(2013, 11, 1, 11, 5), internet=3.0),
        ]
    )
    out = Q.grid_daily_peak_window(prepare_activity(raw, S.PROPAGATE)).collect()
    assert [(r.start, r.end, r[S.SUMMED_ACTIVITY]) for r in out] == [
        (dt.datetime(2013, 11, 1, 10), dt.datetime(2013, 11, 1, 11), 4.0)
    ]


def test_rank_grids_daily_and_by_peak_hour(activity):
    raw = activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 1), internet=1.0),
            rec(1, epoch_ms(2013, 11, 1, 2), internet=1.0),
            rec(2, epoch_ms(2013, 11, 1, 1), internet=1.5),
            rec(3, epoch_ms(2013, 11, 1, 5), internet=1.5),
        ]
    )
    prepared = prepare_activity(raw)
    daily = {r[S.GRID_ID]: (r[S.TOTAL_ACTIVITY], r["rank"]) for r in Q.rank_grids_daily(prepared).collect()}
    assert daily == {1: (2.0, 1), 2: (1.5, 2), 3: (1.5, 2)}
    # by peak hour: grids 2 and 3 peak at 1.5, grid 1 has two tied hours at 1.0
    peak = sorted((r[S.GRID_ID], r[S.HOUR], r["rank"]) for r in Q.rank_grids_by_peak_hour(prepared).collect())
    assert peak == [(1, 1, 3), (1, 2, 3), (2, 1, 1), (3, 5, 1)]


def test_averages_and_day_of_month_merge(activity):
    raw = activity(
        [
            rec(1, epoch_ms(2013, 11, 1, 1), internet=1.0),
            rec(1, epoch_ms(2013, 11, 1, 2), internet=None, sms_in=None),
            rec(1, epoch_ms(2013, 12, 1, 1), internet=4.0),
        ]
    )
    zero = {(r[S.GRID_ID], r[S.ACTIVITY_DATE]): r[S.AVERAGE_ACTIVITY] for r in Q.average_per_grid_day(prepare_activity(raw)).collect()}
    assert zero == {(1, D1): 0.5, (1, dt.date(2013, 12, 1)): 4.0}
    prop = Q.average_per_grid_day(prepare_activity(raw, S.PROPAGATE)).collect()
    assert {r[S.ACTIVITY_DATE]: r[S.AVERAGE_ACTIVITY] for r in prop}[D1] == 1.0
    dom = Q.average_per_grid_day_of_month(prepare_activity(raw, S.PROPAGATE)).collect()
    assert [(r.gridId, r.date, r.avgActivity) for r in dom] == [(1, 1, 2.5)]


def test_all_null_average_is_null(activity):
    raw = activity([rec(1, epoch_ms(2013, 11, 1, 1), internet=None)])
    out = Q.average_per_grid_day(prepare_activity(raw, S.PROPAGATE)).collect()
    assert out[0][S.AVERAGE_ACTIVITY] is None


def test_week_windows_start_on_thursday(activity):
    raw = activity([rec(1, epoch_ms(2013, 11, 1, 1), internet=2.0), rec(1, epoch_ms(2013, 11, 6, 1), internet=4.0)])
    out = Q.average_per_grid_window(prepare_activity(raw)).collect()
    assert [(r.start.date(), r.end.date(), r[S.AVERAGE_ACTIVITY]) for r in out] == [
        (dt.date(2013, 10, 31), dt.date(2013, 11, 7), 3.0)
    ]
    assert out[0].start.weekday() == 3


def test_equal_width_boundaries(spark):
    # min 0, max 9, step 3: 0 -> low, 3 -> medium (lower bound inclusive), 6 -> high, 9 -> high
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 2.9, 3, 5.9, 6, 9])], "k int, v double")
    got = [r.category for r in equal_width_categories(df, "v").orderBy("k").collect()]
    assert got == ["low", "low", "medium", "medium", "high", "high"]


def test_equal_width_constant_empty_and_null(spark):
    const = spark.createDataFrame([(1, 4.0), (2, 4.0)], "k int, v double")
    assert {r.category for r in equal_width_categories(const, "v").collect()} == {"high"}
    empty = spark.createDataFrame([], "k int, v double")
    assert equal_width_categories(empty, "v").count() == 0
    with_null = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "k int, v double")
    cats = {r.k: r.category for r in equal_width_categories(with_null, "v").collect()}
    assert cats == {1: "low", 2: None, 3: "high"}


def test_equal_width_custom_labels(spark):
    df = spark.createDataFrame([(float(v),) for v in range(5)], "v double")
    got = [r.c for r in equal_width_categories(df, "v", labels=("a", "b"), out="c").orderBy("v").collect()]
    assert got == ["a", "a", "b", "b", "b"]
    with pytest.raises(ValueError):
        equal_width_categories(df, "v", labels=("only",))


def test_country_categories_query(activity):
    raw = activity([rec(1, epoch_ms(2013, 11, 1), country=c, internet=float(v)) for c, v in [(39, 0), (33, 5), (44, 10), (49, 7)]])
    got = {r[S.COUNTRY_CODE]: r[S.CATEGORY] for r in Q.country_categories(prepare_activity(raw)).collect()}
    assert got == {39: "low", 33: "medium", 44: "high", 49: "high"}


def test_quantile_buckets_and_repeated_splits(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 10)], "x double")
    got = [r.b for r in quantile_categories(df, {"x": "b"}).orderBy("x").collect()]
    # exact quantiles at ranks ceil(9/3)=3 and ceil(18/3)=6 -> splits 3 and 6
    assert got == [0.0, 0.0, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0]
    same = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "x double")
    got = sorted(r.b for r in quantile_categories(same, {"x": "b"}).collect())
    assert got == [1.0, 1.0, 1.0, 1.0]  # both splits are 1.0: merged into one


def test_one_grid_one_day_ranking(activity):
    raw = _tie_day(activity)
    out = Q.grid_day_hour_ranking(prepare_activity(raw), 1, "2013-11-01").collect()
    assert sorted((r[S.HOUR], r[S.SUMMED_ACTIVITY], r["rank"]) for r in out) == [(10, 2.0, 2), (11, 5.0, 1), (12, 1.0, 3)]


def test_max_total_and_interval_bounds(activity):
    raw = _tie_day(activity)
    assert Q.max_total(prepare_activity(raw)).collect()[0][0] == 5.0
    b = Q.interval_bounds(raw).where(f"{S.GRID_ID} = 2").collect()[0]
    assert (b.end - b.start) == dt.timedelta(minutes=10)


def test_peak_rows_needs_partition(activity):
    with pytest.raises(ValueError):
        peak_rows(prepare_activity(_tie_day(activity)), [], S.TOTAL_ACTIVITY)


def test_rank_questions_with_the_range_strategy(activity):
    raw = activity([rec(g, epoch_ms(2013, 11, 1 + g % 2, g % 24), internet=float(g % 5)) for g in range(1, 60)])
    prepared = prepare_activity(raw)
    for fn in (Q.rank_grids_daily, Q.rank_grid_hours, Q.rank_grids_by_peak_hour):
        assert sorted(fn(prepared, rank_strategy="range").collect()) == sorted(fn(prepared).collect()), fn.__name__


def test_range_rank_on_exact_decimal_totals(spark):
    from conftest import SF_ORACLE

    from gridpulse.plans import registry as R

    prepared = prepare_activity(R.raw_long(spark, SF_ORACLE))  # decimal(18,2) measures
    by_range = Q.rank_grids_daily(prepared, rank_strategy="range")
    assert by_range.exceptAll(Q.rank_grids_daily(prepared)).count() == 0
    assert by_range.count() == 4006
