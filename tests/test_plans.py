"""Physical-plan properties that matter at scale."""

from __future__ import annotations

from conftest import SF_SMALL

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.lookup import point_lookup
from gridpulse.plans import queries as Q
from gridpulse.plans import registry as R


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_peaks_limit_each_group_before_the_shuffle(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    plan = _plan(Q.grid_hour_peak_records(prepared))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = _plan(Q.daily_peak_hour(prepared))
    assert "WindowGroupLimit" in plan


def test_aggregates_are_partial_before_exchange(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    plan = _plan(Q.rank_grids_daily(prepared))
    assert "partial_sum" in plan


def test_categories_use_a_scalar_subquery_not_a_join(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    df = Q.country_categories(prepared)
    df.collect()
    plan = _plan(df)
    assert "Subquery" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin", "BroadcastHashJoin"):
        assert bad not in plan


def test_scan_reads_only_needed_columns(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    plan = _plan(Q.daily_peak_hour(prepared))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in scan
    assert "props" not in scan and "event_id" not in scan


def test_point_lookup_filter_reaches_parquet_scan(spark, scratch):
    raw = R.raw_cells(spark, SF_SMALL)
    path = str(scratch / "cells")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = _plan(point_lookup(prepare_activity(stored, S.PROPAGATE), **{S.GRID_ID: 2}))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(gridId), EqualTo(gridId,2)" in scan


def test_no_python_udf_in_any_registered_query(spark):
    import __spark_entry__ as E

    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_category_bounds_reuse_the_country_aggregate(spark):
    df = R.QUERIES["country_categories"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df)  # final adaptive plan after execution
    assert "ReusedExchange" in plan and "ReusedSubquery" in plan


def test_date_layout_is_one_hash_exchange_on_date_and_sub_key(spark):
    plan = _plan(R.QUERIES["activity_by_date"](spark, SF_SMALL))
    assert "rangepartitioning(" not in plan and plan.count("Exchange hashpartitioning(") == 1
    assert "xxhash64" in plan


def test_internet_category_bounds_come_from_checkpointed_counts(spark):
    df = R.QUERIES["internet_categories"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Subquery" in final and "Scan ExistingRDD[name" in final


def test_queries_leave_the_session_time_zone(spark):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "Europe/Rome")
    try:
        rome = [sorted(map(str, q(spark, SF_SMALL).collect())) for q in (R.QUERIES["daily_peak_hour"], R.QUERIES["interval_bounds"])]
        for name in R.QUERIES:
            R.QUERIES[name](spark, SF_SMALL)
        assert spark.conf.get(zone) == "Europe/Rome"
    finally:
        spark.conf.set(zone, before)
    assert rome == [sorted(map(str, q(spark, SF_SMALL).collect())) for q in (R.QUERIES["daily_peak_hour"], R.QUERIES["interval_bounds"])]


def test_point_lookup_hits_at_every_scale(spark):
    for sf in ("0.001", "0.01", "0.1"):
        assert R.QUERIES["point_lookup"](spark, f"/root/testdata/sf{sf}").count() > 0


def test_date_filter_prunes_the_staged_table(spark, scratch):
    from gridpulse.sinks import write_by_date

    path = str(scratch / "staged")
    write_by_date(prepare_activity(R.raw_long(spark, SF_SMALL)), path)
    one_day = spark.read.parquet(path).where(f"{S.ACTIVITY_DATE} = date'2024-01-15'")
    scan = [line for line in _plan(Q.daily_peak_hour(one_day)).splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(activityDate" in scan and "= 2024-01-15" in scan


def test_filters_reach_the_delimited_scan(spark, scratch):
    from gridpulse.sources import read_activity

    p = scratch / "a.txt"
    p.write_text("1\t1383264000000\t39\t1\t1\t1\t1\t1\n")
    df = point_lookup(read_activity(spark, str(p)), **{S.GRID_ID: 1})
    scan = [line for line in _plan(df).splitlines() if "FileScan csv" in line][0]
    assert "PushedFilters: [IsNotNull(gridId), EqualTo(gridId,1)]" in scan
    assert df.count() == 1


def test_clustered_write_rebalances_by_date(spark):
    from gridpulse.sinks import dated_for_write

    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    plan = dated_for_write(prepared, cluster=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [activityDate" in plan
    plain = dated_for_write(prepared, cluster=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" not in plain
