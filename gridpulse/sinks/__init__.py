"""Sinks: JSON lines, tuple text lines, date-partitioned Parquet, console preview.

Writes are distributed: every task writes its own part file. One output file is
not offered: it would send the whole result through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridpulse import schema as S
from gridpulse.functions.columns import activity_date
from gridpulse.operators.words import format_counts


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (null fields are omitted), one part file per task."""
    df.write.mode(mode).json(path)


def write_word_counts(counts: DataFrame, path: str) -> None:
    """``(word,count)`` text lines; fails if ``path`` exists."""
    format_counts(counts).write.mode("errorifexists").text(path)


def dated_for_write(
    df: DataFrame,
    ts: str = S.ACTIVITY_DATE_TIME,
    date_col: str = S.ACTIVITY_DATE,
    cluster: bool = True,
) -> DataFrame:
    """The frame ``write_by_date`` writes: ``df`` with its date column, and
    with a ``REBALANCE`` on the date when ``cluster`` is set."""
    out = df if date_col in df.columns else df.withColumn(date_col, activity_date(ts))
    return out.hint("rebalance", date_col) if cluster else out


def write_by_date(
    df: DataFrame,
    path: str,
    ts: str = S.ACTIVITY_DATE_TIME,
    mode: str = "overwrite",
    date_col: str = S.ACTIVITY_DATE,
    cluster: bool = True,
) -> None:
    """Parquet partitioned into one directory per date; later filters on the
    date prune whole directories.

    ``cluster=False`` shuffles nothing: each task writes the dates it holds,
    which suits input already laid out by time (one file per day). The default
    adds a ``REBALANCE`` on the date: rows are clustered by date, and adaptive execution splits the partition
    of a busy date and merges small ones, so each date gets a few files of
    about the advisory size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)
    instead of one small file per task.
    """
    dated_for_write(df, ts, date_col, cluster).write.mode(mode).partitionBy(date_col).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = (S.GRID_ID,), mode: str = "errorifexists"
) -> DataFrame:
    """Save ``df`` as the table ``table`` at ``path``, in ``buckets`` buckets by ``keys`` (grid
    cells, say), sorted in each; returns the table.

    Sums, averages, peaks and windows whose groups contain the keys then plan no
    exchange. One shuffle lays the rows out, so that a bucket is one file. All rows of
    a key lie in one bucket: choose keys of which none holds a large share."""
    df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def write_for_lookup(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = (S.GRID_ID,),
    date_col: str = S.ACTIVITY_DATE,
    row_group_bytes: int = 8 << 20,
    mode: str = "errorifexists",
) -> None:
    """Parquet in one folder per date, sorted by ``keys`` within, for point lookups.

    Range partitioning by (date, keys) gives each file a stretch of keys and spreads a
    busy date over files; row groups of ``row_group_bytes`` carry the keys' minimum and
    maximum, page indexes and Bloom filters, so a lookup reads few pages of few groups."""
    writer = df.repartitionByRange(date_col, *keys).sortWithinPartitions(date_col, *keys).write.mode(mode)
    writer = writer.option("parquet.block.size", str(row_group_bytes))
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.partitionBy(date_col).parquet(path)


def preview(df: DataFrame, n: int = 10, truncate: bool | int = True) -> None:
    """Print the first ``n`` rows (arbitrary rows unless ``df`` is ordered)."""
    df.show(n, truncate)


__all__ = ["dated_for_write", "preview", "write_bucketed", "write_by_date", "write_for_lookup", "write_json", "write_word_counts"]
