"""Window sums and their daily peaks, kept up to date as files arrive in any order.

Two Parquet tables, one folder per date each: the sums and numbers of values per
(grid, date, window) and the busiest window(s) of each (grid, date). ``add_file`` adds one file's records:

1. the file's window sums are computed (one aggregate over its records);
2. the sums of the dates that occur in the file are merged with those stored, and
   only these dates' folders are replaced;
3. only the (grid, date) groups that occur in the file are ranked again; the other
   peaks of these dates are kept as they are.

Other dates are neither read nor written. What is to be written is staged in the
session's shared folder first, as its input lies in the folders that it replaces.
Each file is added once; adding it twice counts its records twice. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schema as S
from gridpulse.operators.peaks import peak_rows
from gridpulse.session import cut_lineage, ensure_checkpoint_dir

DATE = "date"
VALUES = "values"
SUMS, PEAKS = "sums", "peaks"


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``; empty if it has not been written yet."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.read.schema(like.schema).parquet(path)
    return like.limit(0)


def _replace_dates(df: DataFrame, path: str) -> None:
    """Write the folders of the dates in ``df``; other folders stay."""
    spread = df.repartitionByRange(DATE, S.GRID_ID)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def window_sums(prepared: DataFrame, duration: str = "1 hour") -> DataFrame:
    """``gridId, start, end, summedActivity, values, date`` of one file's records."""
    window = F.window(S.ACTIVITY_DATE_TIME, duration)
    sums = prepared.groupBy(S.GRID_ID, F.to_date(S.ACTIVITY_DATE_TIME).alias(DATE), window).agg(
        F.sum(S.TOTAL_ACTIVITY).alias(S.SUMMED_ACTIVITY), F.count(S.TOTAL_ACTIVITY).alias(VALUES)
    )
    bounds = [F.col(f"window.{c}").alias(c) for c in ("start", "end")]
    return sums.select(S.GRID_ID, *bounds, S.SUMMED_ACTIVITY, VALUES, DATE)


def add_file(prepared: DataFrame, path: str, duration: str = "1 hour") -> None:
    """Merge the records of one file into the tables below ``path``."""
    spark = prepared.sparkSession
    ensure_checkpoint_dir(spark)
    new = cut_lineage(window_sums(prepared, duration))
    dates = new.select(DATE).distinct()
    kind = new.schema[S.SUMMED_ACTIVITY].dataType
    old = _stored(spark, f"{path}/{SUMS}", new).join(dates, DATE, "left_semi").select(new.columns)
    merged = old.unionByName(new).groupBy(S.GRID_ID, "start", "end", DATE)
    sums = merged.agg(F.sum(S.SUMMED_ACTIVITY).cast(kind).alias(S.SUMMED_ACTIVITY), F.sum(VALUES).alias(VALUES))
    sums = cut_lineage(sums.select(new.columns))
    _replace_dates(sums, f"{path}/{SUMS}")

    groups = new.select(S.GRID_ID, DATE).distinct()
    changed = _only(sums, groups, "left_semi").drop(VALUES)
    peaks = peak_rows(changed, [S.GRID_ID, DATE], S.SUMMED_ACTIVITY, drop_null_peaks=True)
    old_peaks = _stored(spark, f"{path}/{PEAKS}", changed).join(dates, DATE, "left_semi").select(changed.columns)
    _replace_dates(cut_lineage(_only(old_peaks, groups, "left_anti").unionByName(peaks)), f"{path}/{PEAKS}")


def _only(df: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose (grid, date) is (not) in ``groups``, null grids included."""
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (S.GRID_ID, DATE)]
    return df.alias("l").join(groups.alias("r"), same, how)


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{SUMS}")


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    """``gridId, start, end, summedActivity``: the busiest window(s) of each grid cell each day."""
    return spark.read.parquet(f"{path}/{PEAKS}").select(S.GRID_ID, "start", "end", S.SUMMED_ACTIVITY)



def read_averages(spark: SparkSession, path: str, duration: str = "7 days") -> DataFrame:
    """``gridId, start, end, averageActivity`` per tumbling window of dates, from the stored sums."""
    window = F.window(F.col(DATE).cast("timestamp"), duration)
    mean = F.try_divide(F.sum(S.SUMMED_ACTIVITY).cast("double"), F.sum(VALUES))
    averages = read_sums(spark, path).groupBy(S.GRID_ID, window).agg(mean.alias(S.AVERAGE_ACTIVITY))
    return averages.select(S.GRID_ID, F.col("window.start").alias("start"), F.col("window.end").alias("end"), S.AVERAGE_ACTIVITY)
