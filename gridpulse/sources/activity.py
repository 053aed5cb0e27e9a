"""Readers for headerless delimited activity files.

``path`` may be a file, a directory, a glob or a list of them: Spark splits
them into tasks by ``spark.sql.files.maxPartitionBytes``. The schema is always
given, so there is no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse import schema as S


def read_activity(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = "\t",
    schema: T.StructType = S.ACTIVITY_SCHEMA,
    recursive: bool = False,
) -> DataFrame:
    """Headerless delimited records (tab by default) with a fixed schema.

    Malformed fields become null (permissive mode); empty fields are null.
    ``recursive`` also reads files in sub-folders (e.g. one folder per day).
    Filters on the record columns are applied while parsing.
    """
    reader = spark.read.schema(schema).option("delimiter", delimiter).option("header", "false")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.csv(path)


def read_activity_epoch(
    spark: SparkSession, path: str | list[str], delimiter: str = "\t", recursive: bool = False
) -> DataFrame:
    """The same files, read with the epoch column named ``activityStartEpoch``."""
    return read_activity(spark, path, delimiter, schema=S.EPOCH_ACTIVITY_SCHEMA, recursive=recursive)


def read_activity_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Activity records already converted to Parquet (e.g. by ``write_by_date``)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


# Reasons for which a record is rejected, and the columns that name them.
SHORT_LINE, LONG_LINE, BAD_KEY, BAD_MEASURE = "short line", "long line", "bad key", "bad measure"
REASON, LINE = "reason", "line"
ACCEPTED = "accepted"


def _reason(delimiter: str, schema: T.StructType, line: Column) -> Column:
    """Why a line did not parse; ``accepted`` if it did."""
    # fields of the line, counted without splitting it
    fields = F.length(line) - F.length(F.replace(line, F.lit(delimiter), F.lit(""))) + 1
    keys = [F.col(f.name).isNull() for f in schema.fields if f.name not in S.MEASURES]
    bad_key = keys[0]
    for k in keys[1:]:
        bad_key = bad_key | k
    return (
        F.when(line.isNull() & ~bad_key, F.lit(ACCEPTED))
        .when(fields < len(schema), F.lit(SHORT_LINE))
        .when(fields > len(schema), F.lit(LONG_LINE))
        .when(bad_key, F.lit(BAD_KEY))
        .otherwise(F.lit(BAD_MEASURE))
    )


def read_activity_checked(
    spark: SparkSession, path: str | list[str], delimiter: str = "\t", schema: T.StructType = S.ACTIVITY_SCHEMA
) -> DataFrame:
    """The records of :func:`read_activity` with two more columns: ``reason`` (``accepted``, or
    why the line is rejected) and ``line`` (the text of a line that did not parse).

    A line of too few or too many fields, a key that is empty or not a number, and a
    measure that is not a number are rejected; an empty measure is null and accepted."""
    if len(delimiter) != 1:
        raise ValueError("the delimiter is one character")
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    reader = spark.read.schema(T.StructType([*fields, T.StructField(LINE, T.StringType())]))
    rows = reader.options(delimiter=delimiter, header="false", mode="PERMISSIVE", columnNameOfCorruptRecord=LINE).csv(path)
    return rows.withColumn(REASON, _reason(delimiter, schema, F.col(LINE)))


def stage_checked(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    delimiter: str = "\t",
    schema: T.StructType = S.ACTIVITY_SCHEMA,
) -> tuple[DataFrame, DataFrame]:
    """Parse once into the Parquet table ``target``, one folder per reason; returns the
    accepted records, and the rejected ones with ``reason`` and ``line``. Each reads its own folders."""
    read_activity_checked(spark, path, delimiter, schema).write.mode("errorifexists").partitionBy(REASON).parquet(target)
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    stored = T.StructType([*fields, T.StructField(LINE, T.StringType()), T.StructField(REASON, T.StringType())])
    table = spark.read.schema(stored).parquet(target)
    accepted = table.where(F.col(REASON) == ACCEPTED).drop(REASON, LINE)
    return accepted, table.where(F.col(REASON) != ACCEPTED)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """``reason, records`` of rejected records."""
    return rejected.groupBy(REASON).agg(F.count(F.lit(1)).alias("records"))
