"""The activity report and the word-count job on small files."""

from __future__ import annotations

import json

from conftest import epoch_ms

from gridpulse import schema as S
from gridpulse.apps import REPORT_QUERIES, activity_report, rollup_report, word_count_job
from gridpulse.functions.columns import prepare_activity
from gridpulse.sources import read_activity


def _json_rows(folder):
    return [json.loads(x) for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_report_matches_direct_queries(spark, scratch):
    src = scratch / "in"
    src.mkdir()
    lines = []
    for d in (1, 2):
        for h in (3, 9, 17):
            for g in (1, 2, 3):
                lines.append(f"{g}\t{epoch_ms(2013, 11, d, h, 10)}\t{30 + g}\t{g}\t\t{h}\t1\t{d * g}")
    (src / "a.txt").write_text("\n".join(lines) + "\n")
    out = scratch / "out"
    paths = activity_report(spark, str(src), str(out), staging_dir=str(scratch / "staged"))
    together = scratch / "together"
    activity_report(
        spark, str(src), str(together), staging_dir=str(scratch / "staged2"), parallel=3, cluster_staging=True
    )
    assert set(paths) == set(REPORT_QUERIES)
    direct = prepare_activity(read_activity(spark, str(src)))
    for name, fn in REPORT_QUERIES.items():
        got = _json_rows(out / name)
        want = [json.loads(x) for x in fn(direct).toJSON().collect()]
        key = lambda r: json.dumps(r, sort_keys=True)
        assert sorted(got, key=key) == sorted(want, key=key), name
        assert sorted(_json_rows(together / name), key=key) == sorted(want, key=key), name
    peak = _json_rows(out / "busiest_hours")
    assert sorted((r[S.ACTIVITY_DATE], r[S.HOUR]) for r in peak) == [("2013-11-01", 17), ("2013-11-02", 17)]
    assert len(_json_rows(out / "country_bands")) == 3


def test_rollup_report_adds_files_one_by_one(spark, scratch):
    files = {}
    for d in (1, 2):
        lines = [f"{g}\t{epoch_ms(2013, 11, d, h, 10)}\t{30 + g}\t{g}\t\t{h}\t1\t{d * g}" for h in (3, 9, 17) for g in (1, 2, 3)]
        files[f"day{d}"] = str(scratch / f"day{d}.txt")
        (scratch / f"day{d}.txt").write_text("\n".join(lines) + "\n")
    table, out = str(scratch / "rollup"), scratch / "out"
    rollup_report(spark, {"day1": files["day1"]}, table, str(out))
    rollup_report(spark, {"day2": files["day2"]}, table, str(out))
    direct = prepare_activity(read_activity(spark, list(files.values())))
    for name, fn in REPORT_QUERIES.items():
        key = lambda r: json.dumps(r, sort_keys=True)
        assert sorted(_json_rows(out / name), key=key) == sorted((json.loads(x) for x in fn(direct).toJSON().collect()), key=key), name


def test_word_count_job(spark, scratch):
    (scratch / "t.txt").write_text("the cat\nThe dog the cat\n")
    out = word_count_job(spark, str(scratch / "t.txt"), str(scratch / "wc"))
    got = sorted(x for p in (scratch / "wc").glob("part-*") for x in p.read_text().splitlines())
    assert out.endswith("wc") and got == ["(cat,2)", "(dog,1)"]


def test_command_line_word_count(scratch):
    import subprocess
    import sys

    from conftest import ROOT

    (scratch / "t.txt").write_text("b#a b\nthe A\n")
    out = scratch / "wc"
    subprocess.run(
        [sys.executable, "-m", "gridpulse.apps", "wordcount", str(scratch / "t.txt"), str(out), "--separators", " #"],
        cwd=ROOT,
        check=True,
        capture_output=True,
        timeout=300,
    )
    got = sorted(x for p in out.glob("part-*") for x in p.read_text().splitlines())
    assert got == ["(a,2)", "(b,2)"]


def test_report_on_delimited_export_of_the_test_table(spark, scratch):
    """The events adapter's records written as headerless TSV (empty = null),
    then the report job: same answers as the questions on the Parquet table."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from gridpulse import schema as S
    from gridpulse.plans import registry as R

    raw = R.raw_long(spark, "/root/testdata/sf0.01")
    as_text = raw.select(*[F.col(c).cast("string") for c in raw.columns])
    as_text.write.option("delimiter", "\t").option("nullValue", "").csv(str(scratch / "tsv"))
    out = scratch / "out"
    exact = S.activity_schema(T.DecimalType(18, 2))  # the adapter's measure type: exact sums, same ties
    activity_report(spark, str(scratch / "tsv"), str(out), staging_dir=str(scratch / "staged"), parallel=2, schema=exact)
    direct = prepare_activity(raw)
    key = lambda r: json.dumps(r, sort_keys=True)
    for name, fn in REPORT_QUERIES.items():
        want = [json.loads(x) for x in fn(direct).toJSON().collect()]
        assert sorted(_json_rows(out / name), key=key) == sorted(want, key=key), name
    assert S.TOTAL_ACTIVITY in _json_rows(out / "peak_records")[0]
