"""Date, time and total columns; the two null policies."""

from __future__ import annotations

import datetime as dt
import math

from conftest import epoch_ms, rec

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity, with_activity_columns


def test_sub_second_epoch_is_floored(activity):
    df = activity([rec(1, epoch_ms(2013, 11, 1, 0, 0, 0, 999))])
    row = with_activity_columns(df).collect()[0]
    assert row[S.ACTIVITY_DATE_TIME] == dt.datetime(2013, 11, 1, 0, 0, 0)


def test_midnight_and_month_end_keys(activity):
    from pyspark.sql import functions as F

    df = activity(
        [
            rec(1, epoch_ms(2013, 10, 31, 23, 59, 59, 999)),
            rec(1, epoch_ms(2013, 11, 1, 0, 0, 0)),
        ]
    )
    rows = (
        with_activity_columns(df)
        .select(S.ACTIVITY_DATE, F.hour(S.ACTIVITY_DATE_TIME).alias("h"), F.dayofmonth(S.ACTIVITY_DATE_TIME).alias("d"))
        .orderBy(S.ACTIVITY_DATE)
        .collect()
    )
    assert [(r[0], r.h, r.d) for r in rows] == [(dt.date(2013, 10, 31), 23, 31), (dt.date(2013, 11, 1), 0, 1)]


def test_columns_added_and_epoch_dropped(activity):
    df = activity([rec(1, epoch_ms(2013, 11, 1))])
    cols = with_activity_columns(df).columns
    assert S.INTERVAL_START not in cols
    assert cols[-3:] == [S.ACTIVITY_DATE_TIME, S.TOTAL_ACTIVITY, S.ACTIVITY_DATE]
    kept = with_activity_columns(df, drop_epoch=False).columns
    assert S.INTERVAL_START in kept


def test_mixed_nulls_two_policies(activity):
    rows = [
        rec(1, epoch_ms(2013, 11, 1), sms_in=1.0, sms_out=2.0, call_in=3.0, call_out=4.0, internet=5.0),
        rec(1, epoch_ms(2013, 11, 1), sms_in=None, sms_out=2.0, call_in=None, call_out=None, internet=1.0),
    ]
    df = activity(rows)
    zero = sorted(r[S.TOTAL_ACTIVITY] for r in prepare_activity(df, S.ZERO).collect())
    assert zero == [3.0, 15.0]
    prop = [r[S.TOTAL_ACTIVITY] for r in prepare_activity(df, S.PROPAGATE).collect()]
    assert sorted(prop, key=lambda v: (v is None, v)) == [15.0, None]


def test_nan_measure_becomes_zero_under_zero_fill(activity):
    df = activity([rec(1, epoch_ms(2013, 11, 1), sms_in=float("nan"), internet=2.5)])
    assert prepare_activity(df, S.ZERO).collect()[0][S.TOTAL_ACTIVITY] == 2.5
    assert math.isnan(prepare_activity(df, S.PROPAGATE).collect()[0][S.TOTAL_ACTIVITY])


def test_both_policies_keep_rows_with_unparsed_keys(activity):
    df = activity([rec(None, epoch_ms(2013, 11, 1), internet=1.0), rec(7, None, internet=1.0), rec(7, epoch_ms(2013, 11, 1))])
    for policy in S.NULL_POLICIES:
        assert sorted(map(str, (r[S.GRID_ID] for r in prepare_activity(df, policy).collect()))) == ["7", "7", "None"]


def test_bad_policy_rejected(activity):
    import pytest

    with pytest.raises(ValueError):
        prepare_activity(activity([rec(1, 0)]), "fill")
