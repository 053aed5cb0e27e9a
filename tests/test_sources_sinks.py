"""Delimited sources, text lines, JSON / text / Parquet sinks."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import epoch_ms

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.words import word_count
from gridpulse.sinks import write_by_date, write_json, write_word_counts
from gridpulse.sources import read_activity, read_activity_epoch, read_lines


def _tsv(path, lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def test_tsv_with_empty_fields_and_malformed_line(spark, scratch):
    ms = epoch_ms(2013, 11, 1, 10)
    p = _tsv(
        scratch / "day.txt",
        [
            f"1\t{ms}\t39\t1.5\t\t2.0\t\t0.5",
            f"oops\t{ms}\t39\t1.0\t1.0\t1.0\t1.0\t1.0",
            f"2\t{ms}\t0\t\t\t\t\t7.25",
        ],
    )
    raw = read_activity(spark, p)
    assert raw.schema == S.ACTIVITY_SCHEMA
    rows = raw.orderBy(S.GRID_ID).collect()
    assert len(rows) == 3
    assert rows[0][S.GRID_ID] is None  # malformed key -> null, not 0
    zero = prepare_activity(raw, S.ZERO).orderBy(S.GRID_ID).collect()
    assert [(r[S.GRID_ID], r[S.TOTAL_ACTIVITY]) for r in zero] == [(None, 5.0), (1, 4.0), (2, 7.25)]
    prop = prepare_activity(raw, S.PROPAGATE).where(f"{S.GRID_ID} = 1").collect()
    assert prop[0][S.TOTAL_ACTIVITY] is None


def test_directory_glob_and_epoch_schema(spark, scratch):
    ms = epoch_ms(2013, 11, 2)
    d = scratch / "full"
    d.mkdir()
    _tsv(d / "a.txt", [f"1\t{ms}\t39\t1\t1\t1\t1\t1"])
    _tsv(d / "b.txt", [f"2\t{ms}\t39\t1\t1\t1\t1\t1"])
    assert read_activity(spark, str(d)).count() == 2
    assert read_activity(spark, str(d / "*.txt")).count() == 2
    epoch = read_activity_epoch(spark, str(d))
    assert S.ACTIVITY_START_EPOCH in epoch.columns
    assert epoch.schema[S.GRID_ID].nullable  # file sources read every column nullable


def test_comma_delimiter(spark, scratch):
    p = _tsv(scratch / "c.csv", [f"3,{epoch_ms(2013, 11, 1)},39,1,2,3,4,5"])
    row = read_activity(spark, p, delimiter=",").collect()[0]
    assert row[S.GRID_ID] == 3 and row[S.INTERNET] == 5.0


def test_json_sink_omits_null_fields(spark, scratch):
    df = spark.createDataFrame([(1, None), (2, 3.5)], "a int, b double")
    out = str(scratch / "out.json")
    write_json(df, out)
    lines = [json.loads(x) for p in sorted((scratch / "out.json").glob("part-*")) for x in p.read_text().splitlines()]
    assert {"a": 1} in lines and {"a": 2, "b": 3.5} in lines
    write_json(df, out)  # overwrite is allowed


def test_word_count_text_sink_refuses_existing_path(spark, scratch):
    lines = read_lines(spark, _tsv(scratch / "in.txt", ["b a b"]))
    counts = word_count(lines, stop_words=())
    out = str(scratch / "counts")
    write_word_counts(counts, out)
    got = sorted(x for p in (scratch / "counts").glob("part-*") for x in p.read_text().splitlines())
    assert got == ["(a,1)", "(b,2)"]
    with pytest.raises(Exception):
        write_word_counts(counts, out)


def test_write_by_date_round_trip(spark, scratch, activity):
    from conftest import rec

    raw = activity([rec(1, epoch_ms(2013, 11, 1, 5), internet=1.0), rec(2, epoch_ms(2013, 11, 2, 6), internet=2.0)])
    prepared = prepare_activity(raw)
    out = str(scratch / "by_date")
    write_by_date(prepared, out)
    dirs = sorted(p.name for p in (scratch / "by_date").iterdir() if p.is_dir())
    assert dirs == ["activityDate=2013-11-01", "activityDate=2013-11-02"]
    back = spark.read.parquet(out).where(f"{S.ACTIVITY_DATE} = date'2013-11-02'")
    assert [r[S.GRID_ID] for r in back.collect()] == [2]
    assert back.collect()[0][S.ACTIVITY_DATE] == dt.date(2013, 11, 2)


def test_epoch_named_source_prepares_the_same(spark, scratch):
    ms = epoch_ms(2013, 11, 1, 7, 30)
    p = _tsv(scratch / "e.txt", [f"5\t{ms}\t39\t1\t2\t3\t4\t5", f"bad\t{ms}\t39\t1\t1\t1\t1\t1"])
    a = prepare_activity(read_activity(spark, p)).collect()
    b = prepare_activity(read_activity_epoch(spark, p)).collect()
    assert a == b and sorted(r[S.TOTAL_ACTIVITY] for r in a) == [5.0, 15.0]


def test_parquet_source_round_trip(spark, scratch, activity):
    from conftest import rec

    from gridpulse.sources import read_activity_parquet

    raw = activity([rec(1, epoch_ms(2013, 11, 1), internet=2.0), rec(2, epoch_ms(2013, 11, 2), internet=3.0)])
    raw.write.parquet(str(scratch / "raw"))
    back = read_activity_parquet(spark, str(scratch / "raw"))
    assert sorted(back.collect()) == sorted(raw.collect())
    assert read_activity_parquet(spark, [str(scratch / "raw")]).count() == 2


def test_write_by_date_cluster_limits_files(spark, scratch, activity):
    from conftest import rec

    rows = [rec(g, epoch_ms(2013, 11, 1 + i % 3, i % 24), internet=1.0) for i, g in enumerate(range(300))]
    raw = activity(rows).repartition(12)  # every task holds every date
    plain, clustered = scratch / "plain", scratch / "clustered"
    write_by_date(prepare_activity(raw), str(plain), cluster=False)
    write_by_date(prepare_activity(raw), str(clustered), cluster=True)
    count = lambda root: len(list(root.glob("activityDate=*/part-*.parquet")))
    assert count(plain) == 36  # 12 tasks x 3 dates
    assert count(clustered) < count(plain)
    assert spark.read.parquet(str(clustered)).count() == 300


def test_recursive_folders(spark, scratch):
    for day in (1, 2):
        sub = scratch / "full" / f"day={day}" / "part"
        sub.mkdir(parents=True)
        _tsv(sub / "x.txt", [f"{day}\t{epoch_ms(2013, 11, day)}\t39\t1\t1\t1\t1\t1"])
    assert read_activity(spark, str(scratch / "full"), recursive=True).count() == 2
