"""Sums of doubles that don't depend on the order of addition.

A double is an integer times a power of two. Values are dealt into bins of
``BIN`` exponents; within a bin each is an exact whole multiple of the bin's unit
and is added as a decimal, which is exact in any order. Bins are summed per group
with a partial aggregate in each task, and a group's few bins (of about 260 that
exist) are folded from the largest down, always in the same order. So any
partitioning, shuffle or retry gives the same bits.

Non-finite values bypass the bins: their sum is infinite or NaN in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S

#: Exponents in a bin, and the fractional bits kept: a value of bin ``k`` is a multiple of
#: ``2 ** (BIN * k - BITS)``, also if its logarithm was rounded across the bin's border.
BIN = 8
BITS = 54

_BIN, _PART, _SPECIAL, _VALUES, _BINS = "__bin", "__part", "__special", "__values", "__bins"


def _scaled(c: Column, exponent: Column) -> Column:
    """``c * 2**exponent`` in two exact steps (one factor alone may overflow)."""
    half = F.floor(exponent / 2)
    two = F.lit(2.0)
    return c * F.pow(two, half.cast("double")) * F.pow(two, (exponent - half).cast("double"))


def is_reproducible(df: DataFrame, value: str) -> bool:
    """Whether ``value`` is a double that was marked for reproducible sums."""
    field = df.schema[value]
    return field.dataType.typeName() in ("double", "float") and bool(field.metadata.get(S.REPRODUCIBLE))


def reproducible_sums(df: DataFrame, keys: Sequence[str | Column], value: str, alias: str, count: str | None = None) -> DataFrame:
    """``keys, alias`` (and ``count``: non-null values): the sum per group, null if it has no non-null value."""
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    bin_ = F.when(finite & (x != 0), F.floor(F.log2(F.abs(x)) / BIN).cast("int"))
    part = _scaled(x, F.lit(BITS) - F.col(_BIN) * BIN).cast("bigint").cast("decimal(28,0)")
    binned = df.withColumn(_BIN, bin_).groupBy(*keys, _BIN).agg(
        F.sum(F.when(F.col(_BIN).isNotNull(), part)).alias(_PART),
        F.sum(F.when(~finite, x)).alias(_SPECIAL),
        F.count(x).alias(_VALUES),
    )
    names = [c for c in binned.columns if c not in (_BIN, _PART, _SPECIAL, _VALUES)]
    sums = binned.groupBy(*names).agg(
        F.sort_array(F.collect_list(F.when(F.col(_BIN).isNotNull(), F.struct(_BIN, _PART))), asc=False).alias(_BINS),
        F.sum(_SPECIAL).alias(_SPECIAL),
        F.sum(_VALUES).alias(_VALUES),
    )

    def add(total: Column, b: Column) -> Column:
        return total + _scaled(b[_PART].cast("double"), b[_BIN] * BIN - BITS)

    folded = F.coalesce(F.col(_SPECIAL), F.aggregate(_BINS, F.lit(0.0), add))
    out = sums.withColumn(alias, F.when(F.col(_VALUES) > 0, folded))
    if count:
        out = out.withColumn(count, F.col(_VALUES))
    return out.select(*names, alias, *([count] if count else []))
