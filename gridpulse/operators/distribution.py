"""Ranks and exact quantiles of a grouped value, without a task that holds a group.

The values of a group are never brought together as rows.  They are counted per
distinct value (a partial count in each task, so a value shared by a third of all
rows costs one row a task), the counts are cut into ranges of about equal size by
(group, value), and the rows before a value are the sum of two prefixes: over the
ranges before its own (one total per range) and over the larger values inside
its range.

The range numbers are read by two consumers (totals and inner prefixes), which
must see the same cut: the counted, numbered values are checkpointed in the
session's shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.session import cut_lineage, ensure_checkpoint_dir

COUNT = "__count"
BEFORE = "__before"
_RANGE = "__range"
_RANGE_ROWS = "__range_rows"
_GROUP_ROWS = "__group_rows"


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` with null-safe equality; keeps ``left``'s copies."""
    lhs, rhs = left.alias("l"), right.alias("r")
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]
    extra = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return lhs.join(rhs, cond, how).select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def _counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct (keys, value) with their number of rows and range; largest values first, null last."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(COUNT))
    ranged = counts.repartitionByRange(*keys, F.col(value).desc_nulls_last())
    return cut_lineage(ranged.withColumn(_RANGE, F.spark_partition_id()))


def _range_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, range): its rows and the rows of the ranges before it (at most a row per range and group)."""
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(*keys, _RANGE).agg(F.sum(COUNT).alias(_RANGE_ROWS))
    return totals.withColumn(BEFORE, F.coalesce(F.sum(_RANGE_ROWS).over(earlier), F.lit(0)))


def _with_inner_prefix(counts: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Values of ``ranges`` with the number of rows of larger values in the group."""
    larger = (
        Window.partitionBy(*keys, _RANGE)
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    wanted = null_safe_join(counts, ranges, [*keys, _RANGE])
    return wanted.withColumn(BEFORE, F.col(BEFORE) + F.coalesce(F.sum(COUNT).over(larger), F.lit(0))).drop(_RANGE, _RANGE_ROWS)


def rows_before(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct ``keys, value`` with ``__count`` rows and ``__before`` rows of larger values in the group."""
    counts = _counted_values(df, keys, value)
    return _with_inner_prefix(counts, _range_totals(counts, keys), keys, value)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, buckets: int, out: str = "quantiles") -> DataFrame:
    """``keys, out``: per group the array of the ``buckets - 1`` inner quantiles.

    The i-th is the smallest value that at least ``ceil(i n / buckets)`` of the
    group's ``n`` non-null values do not exceed (``percentile_disc``). A group
    without a non-null value has no row. Only the ranges that hold such a rank
    are looked into."""
    if buckets < 2:
        raise ValueError("need at least two buckets")
    counts = _counted_values(df.where(F.col(value).isNotNull()), keys, value)
    n = F.col(_GROUP_ROWS)
    ranks: list[Column] = [F.expr(f"({_GROUP_ROWS} * {i} + {buckets - 1}) div {buckets}") for i in range(1, buckets)]
    ranges = _range_totals(counts, keys).withColumn(_GROUP_ROWS, F.sum(_RANGE_ROWS).over(Window.partitionBy(*keys)))
    # rows up to a range's largest value: n - before; up to below its smallest: n - before - range rows
    holds = [(r <= n - F.col(BEFORE)) & (r > n - F.col(BEFORE) - F.col(_RANGE_ROWS)) for r in ranks]
    wanted = holds[0]
    for h in holds[1:]:
        wanted = wanted | h
    near = _with_inner_prefix(counts, ranges.where(wanted), keys, value)
    at_most = n - F.col(BEFORE)  # rows that don't exceed the value
    found = near.groupBy(*keys).agg(*[F.min(F.when(at_most >= r, F.col(value))).alias(f"q{i}") for i, r in enumerate(ranks)])
    return found.select(*keys, F.array(*[f"q{i}" for i in range(buckets - 1)]).alias(out))
