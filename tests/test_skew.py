"""A group holding a third of all rows must not be shipped whole.

The shuffle volume is read from the executed plan's metrics.
"""

from __future__ import annotations

import datetime as dt
import random
from contextlib import contextmanager

from conftest import epoch_ms
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.functions.text import text_pieces
from gridpulse.operators.categories import quantile_categories
from gridpulse.operators.distribution import COUNT, exact_quantiles, rows_before
from gridpulse.operators.peaks import peak_rows, with_rank
from gridpulse.operators.words import word_count
from gridpulse.plans import queries as Q

TASKS = 8
ROWS = 24_000


def _nodes(plan):
    """Depth-first walk over a physical plan (through adaptive wrappers)."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
        return
    if name in ("ShuffleQueryStage", "ResultQueryStage", "BroadcastQueryStage"):
        yield from _nodes(plan.plan())
        return
    yield plan
    kids = plan.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def _shuffled_records(df) -> int:
    """Run ``df``'s own physical plan, then sum its exchanges' written records."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    total = 0
    for node in _nodes(plan):
        if node.nodeName() == "Exchange":
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                total += m.get().value()
    return total


def _hot_group_records(spark):
    """A third of all rows in one (grid, date, hour); the rest spread out.
    Cached, so that only the operators' own shuffles are measured."""
    hot = [(1, epoch_ms(2013, 11, 1, 10, i % 60), 39, float(i), None, None, None, None) for i in range(ROWS // 3)]
    cold = [
        (2 + i % 500, epoch_ms(2013, 11, 1 + i % 5, i % 24, 0), 39, float(i % 13), None, None, None, None)
        for i in range(ROWS - ROWS // 3)
    ]
    df = spark.createDataFrame(hot + cold, S.ACTIVITY_SCHEMA).repartition(TASKS, F.col(S.INTERVAL_START))
    prepared = prepare_activity(df).cache()
    prepared.count()
    return prepared


def test_hot_group_ships_only_local_top_rows(spark):
    prepared = _hot_group_records(spark)
    hot = prepared.where(f"{S.GRID_ID} = 1")
    assert _shuffled_records(hot.repartition(4)) == ROWS // 3  # the measure sees a full shuffle
    # 8,000 rows in the group; each task forwards only its local top rows
    assert _shuffled_records(Q.grid_hour_peak_records(hot)) <= 2 * TASKS
    peaks = Q.grid_hour_peak_records(prepared).where(f"{S.GRID_ID} = 1").collect()
    assert [(r[S.ACTIVITY_DATE], r[S.HOUR], r[S.TOTAL_ACTIVITY]) for r in peaks] == [
        (dt.date(2013, 11, 1), 10, float(ROWS // 3 - 1))
    ]
    prepared.unpersist()


def test_hot_aggregate_key_is_combined_before_the_shuffle(spark):
    prepared = _hot_group_records(spark)
    hot = prepared.where(f"{S.GRID_ID} = 1")
    assert _shuffled_records(Q.A.grid_hourly_totals(hot)) <= TASKS  # one partial row per task
    assert _shuffled_records(Q.A.country_totals(prepared)) <= TASKS  # one country: a third and more
    prepared.unpersist()


def test_frequent_word_is_combined_before_the_shuffle(spark):
    lines = spark.createDataFrame([("the cat sat on a mat " * 50,)] * 400, "value string").repartition(TASKS).cache()
    lines.count()
    counts = word_count(lines, stop_words=(), partitions=None)
    # six distinct tokens per task, then at most as many words
    assert _shuffled_records(counts) <= 2 * 6 * TASKS
    assert {r.word: r["count"] for r in counts.collect()}["cat"] == 50 * 400
    lines.unpersist()


def test_tied_hot_group_is_split_by_the_join_strategy(spark):
    """Every row of a hot group ties at the top: the join strategy's output is
    produced by many tasks (skew split or broadcast), not one."""
    n = ROWS // 3
    rows = [(1, epoch_ms(2013, 11, 1, 10, i % 60), 39, 5.0, None, None, None, None) for i in range(n)]
    rows += [(2 + i % 50, epoch_ms(2013, 11, 1, i % 24), 39, float(i % 7), None, None, None, None) for i in range(n)]
    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA).repartition(TASKS)).cache()
    df.count()
    keys = [S.GRID_ID, S.ACTIVITY_DATE]
    out = peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks=True, strategy="join")
    per_task = out.where(f"{S.GRID_ID} = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == n
    assert len(per_task) > 1
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        map(tuple, peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks=True).collect()), key=repr
    )
    df.unpersist()


@contextmanager
def _planned_as_at_scale(spark):
    """Small inputs would be broadcast and merged into one partition; plan as for large ones."""
    at_scale = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in at_scale}
    for k, v in at_scale.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_one_huge_day_is_ranked_by_many_tasks(spark):
    rows = [(i, epoch_ms(2013, 11, 1, i % 24), 39, float(i % 4999), None, None, None, None) for i in range(ROWS)]
    daily = Q.A.grid_daily_totals(prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)))
    daily = daily.repartition(TASKS).cache()  # a large day arrives in many partitions
    daily.count()
    with _planned_as_at_scale(spark):
        ranked = with_rank(daily, [S.ACTIVITY_DATE], S.TOTAL_ACTIVITY, strategy="range")
        per_task = _rows_per_task(ranked)
        # the value ranks themselves are made by many tasks, none of which sees the day
        ranges = _rows_per_task(rows_before(daily, [S.ACTIVITY_DATE], S.TOTAL_ACTIVITY))
    assert len(per_task) == TASKS and sum(per_task) == ROWS
    assert max(per_task) < ROWS // 2
    assert sum(ranges) == 4999 and len(ranges) > TASKS // 2 and max(ranges) < 4999 // 2
    assert _same_rows(ranked, with_rank(daily, [S.ACTIVITY_DATE], S.TOTAL_ACTIVITY))
    daily.unpersist()


def test_a_value_of_a_third_of_the_rows_costs_one_count_a_task(spark):
    rows = [(i, epoch_ms(2013, 11, 1 + i % 2), 39, 7.0 if i % 3 == 0 else float(i), None, None, None, None) for i in range(ROWS)]
    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)).repartition(TASKS, S.GRID_ID).cache()
    df.count()
    keys = [S.ACTIVITY_DATE]
    tied = df.where(f"{S.TOTAL_ACTIVITY} = 7.0")
    assert _shuffled_records(tied.groupBy(*keys, S.TOTAL_ACTIVITY).count()) <= 2 * TASKS
    counted = rows_before(df, keys, S.TOTAL_ACTIVITY)
    hot = counted.where(f"{S.TOTAL_ACTIVITY} = 7.0").collect()
    assert len(hot) == 2 and sum(r[COUNT] for r in hot) == tied.count()
    assert _same_rows(with_rank(df, keys, S.TOTAL_ACTIVITY, strategy="range"), with_rank(df, keys, S.TOTAL_ACTIVITY))
    df.unpersist()


def test_ranks_with_null_keys_null_values_and_nan(spark):
    rows = [(None, 1.0), (None, None), (1, None), (1, None), (1, float("nan")), (1, 0.0), (1, -0.0), (1, -5.0), (2, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    assert _same_rows(with_rank(df, ["k"], "v", strategy="range"), with_rank(df, ["k"], "v"))
    assert with_rank(df.limit(0), ["k"], "v", strategy="range").count() == 0


def test_tied_records_of_a_hot_group_are_finished_by_many_tasks(spark):
    """Without the help of adaptive execution: the default plan of the peak records."""
    n = ROWS // 3
    rows = [(1, epoch_ms(2013, 11, 1, 10, i % 60), 39, 5.0, None, None, None, None) for i in range(n)]
    rows += [(1, epoch_ms(2013, 11, 1, 10), 39, 4.0, None, None, None, None)] * 500
    rows += [(2 + i % 50, epoch_ms(2013, 11, 1, i % 24), 39, float(i % 7), None, None, None, None) for i in range(n)]
    df = prepare_activity(spark.createDataFrame(rows, S.ACTIVITY_SCHEMA).repartition(TASKS)).cache()
    df.count()
    keys = [S.GRID_ID, S.ACTIVITY_DATE]
    plain = peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks=True)
    with _planned_as_at_scale(spark):
        out = peak_rows(df, keys, S.TOTAL_ACTIVITY, drop_null_peaks=True, strategy="spread", hot_rows=1000)
        hot = _rows_per_task(out.where(f"{S.GRID_ID} = 1"))
        assert max(_rows_per_task(plain.where(f"{S.GRID_ID} = 1"))) == n  # the window alone leaves them to one task
    assert sum(hot) == n and len(hot) > TASKS // 2 and max(hot) <= n // 2
    assert _same_rows(out, plain)
    df.unpersist()


def test_spread_peaks_of_null_groups_and_keys(spark):
    rows = [(None, 3.0), (None, 3.0), (None, 1.0)] * 5 + [(1, None)] * 20 + [(2, float("nan")), (2, 7.0), (3, 0.0), (3, -0.0), (4, None), (4, 2.0)]
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k int, v double, i int")
    for drop in (False, True):
        for hot_rows in (0, 3, 10_000):
            out = peak_rows(df, ["k"], "v", drop_null_peaks=drop, strategy="spread", hot_rows=hot_rows)
            assert out.columns == df.columns
            assert _same_rows(out, peak_rows(df, ["k"], "v", drop_null_peaks=drop))
    assert peak_rows(df.limit(0), ["k"], "v", strategy="spread").count() == 0


def test_exact_quantiles_of_many_keys(spark):
    import duckdb

    n = 300_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 8).alias("v")).cache()
    frame = df.toPandas()
    want = duckdb.sql("SELECT quantile_disc(v, 1.0/3), quantile_disc(v, 2.0/3) FROM frame").fetchall()[0]
    got = exact_quantiles(df.withColumn("g", F.lit(1)), ["g"], "v", 3).first()["quantiles"]
    assert tuple(got) == want
    sizes = {r.b: r["count"] for r in quantile_categories(df, {"v": "b"}).groupBy("b").count().collect()}
    below = int((frame.v < want[0]).sum()), int((frame.v < want[1]).sum())
    assert sizes == {0.0: below[0], 1.0: below[1] - below[0], 2.0: n - below[1]}
    df.unpersist()


def test_exact_quantiles_of_groups_ties_and_nulls(spark):
    rng = random.Random(8)
    rows = [(g, None if rng.random() < 0.1 else float(rng.choice([1, 1, 2, rng.randrange(40)]))) for g in [None, 0, 1, 1, 1, 1] for _ in range(60)]
    rows += [(5, None), (6, 4.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    for buckets in (2, 3, 7):
        got = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], "v", buckets).collect()}
        want = {}
        for g in {r[0] for r in rows}:
            x = sorted(v for k, v in rows if k == g and v is not None)
            if x:
                want[g] = [x[-(-i * len(x) // buckets) - 1] for i in range(1, buckets)]
        assert got == want
    assert exact_quantiles(df.limit(0), ["g"], "v", 3).count() == 0


def test_one_huge_text_is_spread_over_tasks(spark, scratch):
    words = ["alpha", "beta", "Ünï", "x" * 300, "dog.\tend"]
    text = " ".join(words * 20_000)
    lines = spark.createDataFrame([(text,)], "value string")
    pieces = lines.select(F.explode(text_pieces(F.col("value"), " ", 10_000)).alias("t"))
    sizes = [len(r.t) for r in pieces.collect()]
    assert len(sizes) > 100 and max(sizes) <= 10_000 + 300 and sum(sizes) == len(text)
    assert len(_rows_per_task(pieces.repartition(TASKS))) == TASKS
    want = {w.lower(): 20_000 for w in words}
    counts = word_count(lines, stop_words=(), partitions=TASKS, piece_chars=10_000)
    assert {r.word: r["count"] for r in counts.collect()} == want
    # the same from a file of one line, cut into byte ranges while reading
    path = scratch / "one-line.txt"
    path.write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        from gridpulse.sources import read_lines, read_text_pieces

        assert len(_rows_per_task(read_lines(spark, str(path)))) == 1
        read = read_text_pieces(spark, str(path))
        assert len(_rows_per_task(read)) > 4
        assert {r.word: r["count"] for r in word_count(read, stop_words=()).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
