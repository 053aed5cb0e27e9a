"""Lineage cutting, caching, and the small column helpers."""

from __future__ import annotations

from conftest import SF_SMALL, epoch_ms, rec
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import date_text, prepare_activity
from gridpulse.operators.aggregates import country_totals, extremes
from gridpulse.plans import queries as Q
from gridpulse.plans import registry as R
from gridpulse.session import checkpoint_dir, cut_lineage, ensure_checkpoint_dir, persisted


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark, "/never/used") == checkpoint_dir(spark)  # set ones are kept


def test_cut_lineage_keeps_results_and_drops_the_plan(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    cut = cut_lineage(prepared)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LogicalRDD") and "parquet" not in plan  # reads the checkpoint, not the source
    assert sorted(Q.daily_peak_hour(cut).collect()) == sorted(Q.daily_peak_hour(prepared).collect())


def test_persisted_releases_the_cache(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    with persisted(prepared) as kept:
        assert kept.is_cached
        assert Q.max_total(kept).collect()[0][0] is not None
    assert not prepared.is_cached


def test_extremes_and_date_text(activity):
    raw = activity(
        [rec(1, epoch_ms(2013, 11, 1, 23, 59), country=c, internet=float(v)) for c, v in [(39, 4), (33, 9), (44, 1)]]
    )
    prepared = prepare_activity(raw)
    row = extremes(country_totals(prepared), S.COUNTRY_ACTIVITY).collect()[0]
    assert (row["max"], row["min"]) == (9.0, 1.0)
    assert {r.d for r in prepared.select(date_text().alias("d")).collect()} == {"2013-11-01"}
    assert prepared.select(F.col(S.ACTIVITY_DATE).cast("string")).first()[0] == "2013-11-01"
