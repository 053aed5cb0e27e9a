"""Every registered query against its DuckDB oracle, plus invariants."""

from __future__ import annotations

import pytest
from conftest import SF_ORACLE, SF_SMALL

import __spark_entry__ as E
from gridpulse.plans import registry
from oracle_compare import compare, duckdb_connection


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_ORACLE)
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["activityDate", "hour", "summedActivity"]
    assert df.count() > 0


def test_invariants_on_small_data(spark):
    from pyspark.sql import functions as F

    from gridpulse import schema as S
    from gridpulse.functions.columns import prepare_activity
    from gridpulse.plans import queries as Q
    from gridpulse.plans import registry as R

    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    days = prepared.select(S.ACTIVITY_DATE).distinct().count()
    peaks = Q.daily_peak_hour(prepared)
    assert peaks.select(S.ACTIVITY_DATE).distinct().count() == days  # each day has a peak
    hourly = Q.A.hourly_totals(prepared)
    mx = hourly.groupBy(S.ACTIVITY_DATE).agg(F.max(S.SUMMED_ACTIVITY).alias("m"))
    assert peaks.join(mx, S.ACTIVITY_DATE).where(F.col("m") != F.col(S.SUMMED_ACTIVITY)).count() == 0
    ranks = Q.rank_grids_daily(prepared)
    assert ranks.groupBy(S.ACTIVITY_DATE).agg(F.min("rank").alias("r")).where("r != 1").count() == 0
    by_hours = hourly.groupBy(S.ACTIVITY_DATE).agg(F.sum(S.SUMMED_ACTIVITY).alias("h"))
    by_grid = Q.A.grid_daily_totals(prepared).groupBy(S.ACTIVITY_DATE).agg(F.sum(S.TOTAL_ACTIVITY).alias("g"))
    assert by_hours.join(by_grid, S.ACTIVITY_DATE).where("h != g").count() == 0
