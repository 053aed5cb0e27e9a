"""Plain text lines, one row per line in a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def read_text_pieces(spark: SparkSession, path: str | list[str], separator: str = " ") -> DataFrame:
    """The same text as pieces that end at ``separator`` or at a line end, in a ``value`` column.

    The files are split by byte ranges (``spark.sql.files.maxPartitionBytes``) at the
    separator instead of at line ends, so one huge line is read by many tasks and no
    text is shuffled. For counts of words that are cut at ``separator`` among others,
    pieces and lines give the same result. A UTF-8 separator of one character;
    compressed files are not split."""
    if len(separator) != 1:
        raise ValueError("the separator is one character")
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("lineSep", separator).text(paths)
    return raw.select(F.explode(F.split("value", "\r\n|\r|\n")).alias("value"))
