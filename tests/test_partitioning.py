"""Date layouts: range partitions are balanced and contiguous; hash keeps dates whole."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.partitioning import dated_records, hash_partition_by_date, partition_by_date
from gridpulse.plans import queries as Q
from gridpulse.plans import registry as R


def _dated(spark):
    return dated_records(R.raw_long(spark, SF_SMALL), epoch_col=S.INTERVAL_START)


def test_range_layout_is_balanced_and_contiguous(spark):
    df = partition_by_date(_dated(spark), 8).withColumn("pid", F.spark_partition_id())
    stats = df.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.min(S.ACTIVITY_DATE_TIME).alias("lo"), F.max(S.ACTIVITY_DATE_TIME).alias("hi"))
    parts = sorted(stats.collect(), key=lambda r: r.pid)
    assert sum(r.n for r in parts) == _dated(spark).count()
    assert max(r.n for r in parts) <= 2 * min(r.n for r in parts)  # about equal sizes
    for a, b in zip(parts, parts[1:]):
        assert a.hi <= b.lo  # each partition is one stretch of time, in order


def test_hash_layout_keeps_each_date_in_one_partition(spark):
    df = hash_partition_by_date(_dated(spark), 8).withColumn("pid", F.spark_partition_id())
    per_date = df.groupBy(F.to_date(S.ACTIVITY_DATE_TIME).alias("d")).agg(F.countDistinct("pid").alias("p"))
    assert per_date.where("p != 1").count() == 0
    spread = hash_partition_by_date(_dated(spark), 8, spread=4).withColumn("pid", F.spark_partition_id())
    assert spread.count() == df.count()


def test_sql_over_a_temp_view_equals_the_function(spark):
    prepared = prepare_activity(R.raw_long(spark, SF_SMALL))
    prepared.createOrReplaceTempView("activity")
    sql = spark.sql(
        """
        SELECT activityDate, hour, summedActivity FROM (
          SELECT activityDate, hour, summedActivity,
                 rank() OVER (PARTITION BY activityDate ORDER BY summedActivity DESC) AS r
          FROM (SELECT activityDate, hour(activityDateTime) AS hour, sum(totalActivity) AS summedActivity
                FROM activity GROUP BY activityDate, hour(activityDateTime)))
        WHERE r = 1
        """
    )
    assert sorted(sql.collect()) == sorted(Q.daily_peak_hour(prepared).collect())
