"""Bucketing of a numeric column into labelled categories.

Boundaries come from a one-row aggregate of the same frame, attached as a
scalar subquery (``DataFrame.scalar()``): Spark computes it once per query,
inside the same plan, with a partial aggregate per task. There is no join and
no driver round trip, and what is shipped to each task is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.distribution import exact_quantiles

# Default category labels, lowest first.
DEFAULT_LABELS = ("low", "medium", "high")


def equal_width_bounds(df: DataFrame, value: str, buckets: int) -> Column:
    """Scalar subquery: the ``buckets - 1`` inner boundaries ``min + step * i``.

    ``step = (max - min) / buckets``, in double precision.
    """
    v = F.col(value).cast("double")
    lo, hi = F.col("lo"), F.col("hi")
    step = (hi - lo) / float(buckets)
    inner = [lo + step * float(i) for i in range(1, buckets)]
    return df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).select(F.array(*inner)).scalar()


def equal_width_categories(
    df: DataFrame,
    value: str,
    labels: Sequence[str] = DEFAULT_LABELS,
    out: str = "category",
) -> DataFrame:
    """Label each row by which of ``len(labels)`` equal-width ranges of
    ``[min, max]`` its ``value`` falls in.

    Lower bounds are inclusive, upper bounds exclusive, and the last range is
    closed, so the maximum is always in the top category. When all values are
    equal every row gets the top label. A null value gets a null label.
    """
    if len(labels) < 2:
        raise ValueError("need at least two labels")
    bounds = equal_width_bounds(df, value, len(labels))
    v = F.col(value).cast("double")
    label = F.when(v.isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(labels[:-1]):
        label = label.when(v < bounds[i], F.lit(name))
    return df.withColumn(out, label.otherwise(F.lit(labels[-1])))


def quantile_categories(
    df: DataFrame,
    columns: Mapping[str, str],
    buckets: int = 3,
    relative_error: float | None = None,
) -> DataFrame:
    """Quantile bucket index (as a double) for each ``input -> output`` column.

    Splits are the ``1/buckets, 2/buckets, ...`` quantiles of each input, with
    repeated splits merged: exact ones by distributed selection
    (``operators.distribution.exact_quantiles``), or, if ``relative_error`` is
    given, those of ``percentile_approx`` with accuracy ``1 / relative_error``. Bucket ``k`` holds values from the k-th distinct
    split (inclusive) to the next (exclusive), open at both outer ends. Null
    inputs get a null bucket.
    """
    if buckets < 2:
        raise ValueError("need at least two buckets")
    # One subquery: a struct or map holding every column's split array.
    if relative_error is None:
        named = [F.struct(F.lit(src).alias("name"), F.col(src).cast("double").alias("value")) for src in columns]
        values = df.select(F.explode(F.array(*named)).alias("x")).select("x.name", "x.value")
        splits = exact_quantiles(values, ["name"], "value", buckets, out="splits")
        all_splits = splits.agg(F.map_from_entries(F.collect_list(F.struct("name", "splits")))).scalar()  # a row per column
    else:
        probs = [i / buckets for i in range(1, buckets)]
        accuracy = max(1, int(round(1.0 / relative_error)))
        all_splits = df.agg(
            F.struct(*[F.percentile_approx(F.col(src).cast("double"), probs, accuracy).alias(src) for src in columns])
        ).scalar()
    buckets_of = {}
    for src, dst in columns.items():
        splits = all_splits[src]
        x = F.col(src).cast("double")
        # Splits come back in ascending order: count those <= x, each repeated
        # split once.
        below = F.lit(0)
        for i in range(buckets - 1):
            s_i = splits[i]
            new = s_i <= x if i == 0 else (s_i <= x) & (s_i != splits[i - 1])
            below = below + F.when(new, 1).otherwise(0)
        buckets_of[dst] = F.when(x.isNull(), F.lit(None)).otherwise(below.cast("double"))
    return df.withColumns(buckets_of)
