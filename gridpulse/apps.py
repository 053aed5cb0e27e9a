"""Runnable jobs: the activity report and the word count.

``activity_report`` answers five questions over one set of delimited activity
files. Parsing delimited text is the dominant cost, so the prepared records
are parsed once and written as a date-partitioned Parquet table in a shared
folder (the session's ``spark.checkpoint.dir`` when set, else under the
output folder). That table cuts the lineage: a lost executor re-reads it
instead of re-parsing the sources. Each question then reads only the columns
it needs from the table and writes JSON lines to ``<out_dir>/<name>``. The
staged table is left in place for further questions; remove it when done.

Command line::

    python -m gridpulse.apps report  <input> <out_dir> [--null-policy zero|propagate] [--rollup DIR --batch NAME]
    python -m gridpulse.apps wordcount <input> <output> [--separators " "] [--stop-word the ...]
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridpulse import schema as S
from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.words import DEFAULT_SEPARATORS, DEFAULT_STOP_WORDS, word_count
from gridpulse.plans import queries as Q
from gridpulse.plans import rollup
from gridpulse.session import checkpoint_dir
from gridpulse.sinks import write_by_date, write_json, write_word_counts
from gridpulse.sources import read_activity, read_lines

REPORT_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "busiest_hours": Q.daily_peak_hour,
    "country_bands": Q.country_categories,
    "grid_day_means": Q.average_per_grid_day,
    "grid_ranking": Q.rank_grids_daily,
    "peak_records": Q.grid_hour_peak_records,
}


def stage_prepared(
    spark: SparkSession,
    source: str | list[str],
    null_policy: str = S.ZERO,
    delimiter: str = "\t",
    staging_dir: str | None = None,
    schema: T.StructType = S.ACTIVITY_SCHEMA,
    cluster: bool = True,
) -> DataFrame:
    """Parse and prepare the sources once; return the written table.

    ``cluster`` rebalances rows by date before writing (for sources not laid
    out by day; see ``sinks.write_by_date``)."""
    target = staging_dir
    if target is None:
        base = checkpoint_dir(spark)
        if not base:
            raise ValueError("give staging_dir or set spark.checkpoint.dir")
        target = f"{base.rstrip('/')}/gridpulse-staged-{uuid.uuid4().hex}"
    prepared = prepare_activity(read_activity(spark, source, delimiter, schema), null_policy)
    write_by_date(prepared, target, mode="errorifexists", cluster=cluster)
    return spark.read.parquet(target)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def activity_report(
    spark: SparkSession,
    source: str | list[str],
    out_dir: str,
    null_policy: str = S.ZERO,
    delimiter: str = "\t",
    staging_dir: str | None = None,
    questions: Mapping[str, Callable[[DataFrame], DataFrame]] = REPORT_QUERIES,
    parallel: int = 1,
    schema: T.StructType = S.ACTIVITY_SCHEMA,
    cluster_staging: bool = True,
    keep_staged: bool = False,
) -> dict[str, str]:
    """Write each question's answer as JSON lines; return ``name -> path``.

    ``parallel > 1`` submits that many questions at once from worker threads,
    each in its own scheduler pool (named after the question; pools share the
    cluster under ``spark.scheduler.mode=FAIR``), so small final stages of
    one question overlap with the work of another. ``schema`` may read the
    measures as decimals (``schema.activity_schema(DecimalType(18, 2))``).
    The staged copy of the input goes to a new folder (an existing
    ``staging_dir`` is an error) and is removed at the end unless
    ``keep_staged``.
    """
    out = out_dir.rstrip("/")
    if staging_dir is None:
        base = checkpoint_dir(spark)
        staging_dir = f"{base.rstrip('/') if base else out}/gridpulse-staged-{uuid.uuid4().hex}"
    table = stage_prepared(spark, source, null_policy, delimiter, staging_dir, schema, cluster_staging)
    paths = {name: f"{out}/{name}" for name in questions}

    def answer(name: str) -> None:
        sc = spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            write_json(questions[name](table), paths[name])
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    if parallel <= 1:
        for name in questions:
            answer(name)
    else:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for done in [pool.submit(answer, name) for name in questions]:
                done.result()
    if not keep_staged:
        _remove(spark, staging_dir)
    return paths


def rollup_report(
    spark: SparkSession,
    files: Mapping[str, str | list[str]],
    rollup_dir: str,
    out_dir: str,
    null_policy: str = S.ZERO,
    delimiter: str = "\t",
    schema: T.StructType = S.ACTIVITY_SCHEMA,
) -> dict[str, str]:
    """Add the files (batch name -> path) to the rollup table at ``rollup_dir`` and write
    the five questions' answers from the whole table; return ``name -> path``.

    Each file is parsed once, when it is added; later reports read only the table
    (``plans.rollup``). A batch that is added again replaces itself."""
    for batch, path in files.items():
        rollup.add_records(prepare_activity(read_activity(spark, path, delimiter, schema), null_policy), rollup_dir, batch)
    table = rollup.read_rollup(spark, rollup_dir)
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in rollup.QUESTIONS}
    for name, question in rollup.QUESTIONS.items():
        write_json(question(table), paths[name])
    return paths


def word_count_job(
    spark: SparkSession,
    source: str | list[str],
    output: str,
    separators: str = DEFAULT_SEPARATORS,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
) -> str:
    """Count the words of text files; write ``(word,count)`` lines (the output
    path must not exist)."""
    write_word_counts(word_count(read_lines(spark, source), separators, stop_words), output)
    return output


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridpulse")
    sub = parser.add_subparsers(dest="job", required=True)
    rep = sub.add_parser("report", help="five activity questions -> JSON lines")
    rep.add_argument("input")
    rep.add_argument("out_dir")
    rep.add_argument("--null-policy", default=S.ZERO, choices=S.NULL_POLICIES)
    rep.add_argument("--delimiter", default="\t")
    rep.add_argument("--staging-dir")
    rep.add_argument("--parallel", type=int, default=1, help="questions answered at once")
    rep.add_argument("--rollup", metavar="DIR", help="add the input to the rollup table in DIR and answer from it")
    rep.add_argument("--batch", default="all", help="name of the input within the rollup table")
    rep.add_argument("--cluster-staging", action="store_true", help="rebalance by date before staging")
    wc = sub.add_parser("wordcount", help="word count -> (word,count) lines")
    wc.add_argument("input")
    wc.add_argument("output")
    wc.add_argument("--separators", default=DEFAULT_SEPARATORS)
    wc.add_argument("--stop-word", action="append", dest="stop_words")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"gridpulse-{args.job}").getOrCreate()
    try:
        if args.job == "report" and args.rollup:
            rollup_report(spark, {args.batch: args.input}, args.rollup, args.out_dir, args.null_policy, args.delimiter)
        elif args.job == "report":
            activity_report(
                spark,
                args.input,
                args.out_dir,
                args.null_policy,
                args.delimiter,
                args.staging_dir,
                parallel=args.parallel,
                cluster_staging=args.cluster_staging,
            )
        else:
            stops = args.stop_words if args.stop_words is not None else DEFAULT_STOP_WORDS
            word_count_job(spark, args.input, args.output, args.separators, stops)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
