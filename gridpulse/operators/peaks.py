"""Per-group maxima ("peaks") and ranks.

``peak_rows`` keeps every row ranked first in its group (ties kept). Written as
``rank() = 1`` it lets Spark plan a partial ``WindowGroupLimit`` in each map
task before the shuffle, so a group with many rows sends only its local
top-tied rows across the network; a ``max()`` / ``first()`` window would ship
every row of the group. ``strategy="spread"`` also spreads groups whose top may
be shared by a great many rows over tasks.

``with_rank`` numbers rows within a group: in one task per group
(``strategy="window"``), or from counts per distinct value that are spread
over tasks (``strategy="range"``).

Null peaks: ``rank() = 1`` keeps a group whose values are all null (null
ranks first when nothing else is there). A "row equals the group max" filter
drops such a group instead; ``drop_null_peaks=True`` gives that behaviour by
removing null values before ranking, which is the same result (nulls sort last
in a descending order, so they never tie with a non-null top).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.operators.distribution import BEFORE, null_safe_join, rows_before

_PEAK_RANK = "__peak_rank"
_PEAK_MAX = "__peak_max"
_GROUP_ROWS = "__group_rows"
_SALT = "__salt"
STRATEGIES = ("window", "spread", "join")
#: A group is spread if it holds more rows than this and more than one in
#: ``HOT_GROUPS`` of all rows, so that there are fewer than ``HOT_GROUPS`` such groups.
HOT_ROWS = 10_000
HOT_GROUPS = 65_536


def peak_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    drop_null_peaks: bool = False,
    strategy: str = "window",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows with the largest ``order_by`` within each ``partition_by`` group.

    Ties are all kept. ``drop_null_peaks`` drops groups without a non-null
    value (and null rows) instead of keeping them.

    ``strategy="window"`` (default) ranks within each group; the partial
    group limit keeps the shuffle to each task's local top rows.
    ``strategy="spread"`` is for records, of which one group may hold a third
    and all of those may tie. Row counts and maxima per group (a partial
    aggregate) name the hot groups, fewer than ``HOT_GROUPS`` whatever the
    input, which are broadcast. Their rows below the maximum go at once; what
    is left of them is salted by the reading task, the rest is not, and one
    window with its partial group limit finishes both. The plan is the same
    for all sizes.
    ``strategy="join"`` is for groups whose top value is shared by a great
    many rows: it takes each group's maximum with a partial aggregate and
    joins the rows back to it. Adaptive execution broadcasts the maxima when
    they are small and otherwise splits a skewed key over several tasks, so
    a huge set of tied rows is not finished by one task. It ships every row
    when the maxima are too large to broadcast.
    """
    if not partition_by:
        raise ValueError("peak_rows needs at least one partition column")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if drop_null_peaks:
        df = df.where(F.col(order_by).isNotNull())
    if strategy == "join":
        return _peak_rows_by_join(df, list(partition_by), order_by)
    if strategy == "spread":
        return _peak_rows_spread(df, list(partition_by), order_by, hot_rows)
    w = Window.partitionBy(*partition_by).orderBy(F.col(order_by).desc())
    return df.withColumn(_PEAK_RANK, F.rank().over(w)).where(F.col(_PEAK_RANK) == 1).drop(_PEAK_RANK)


def _peak_rows_spread(df: DataFrame, keys: list[str], order_by: str, hot_rows: int) -> DataFrame:
    tops = df.groupBy(*keys).agg(F.max(order_by).alias(_PEAK_MAX), F.count(F.lit(1)).alias(_GROUP_ROWS))
    every = tops.agg(F.sum(_GROUP_ROWS).alias("n")).scalar()
    hot = tops.where((F.col(_GROUP_ROWS) > hot_rows) & (F.col(_GROUP_ROWS) * HOT_GROUPS > every))
    rows = null_safe_join(df, F.broadcast(hot), keys, "left")  # fewer than HOT_GROUPS rows
    is_hot = F.col(_GROUP_ROWS).isNotNull()
    rows = rows.where(~is_hot | F.col(order_by).eqNullSafe(F.col(_PEAK_MAX)))
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # all rows left of a hot group tie, so any deal of them gives each rank 1
    salt = F.when(is_hot, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0))
    w = Window.partitionBy(*keys, _SALT).orderBy(F.col(order_by).desc())
    ranked = rows.withColumn(_SALT, salt).withColumn(_PEAK_RANK, F.rank().over(w))
    return ranked.where(F.col(_PEAK_RANK) == 1).select(*df.columns)


def _peak_rows_by_join(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """Rows equal to their group's maximum; a group with no value keeps its
    null rows (as ``rank() = 1`` does). Keys match null-safely."""
    maxes = df.groupBy(*keys).agg(F.max(order_by).alias(_PEAK_MAX))
    value, mx = F.col(order_by), F.col(_PEAK_MAX)
    keep = (value == mx) | (mx.isNull() & value.isNull())
    return null_safe_join(df, maxes, keys).where(keep).drop(_PEAK_MAX)


RANK_STRATEGIES = ("window", "range")


def with_rank(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    name: str = "rank",
    strategy: str = "window",
) -> DataFrame:
    """Add ``rank()`` by ``order_by`` descending within each group (gaps after ties).

    ``strategy="window"`` (default) ranks each group in one task.

    ``strategy="range"`` is for groups too large for one task: a value's rank is
    one more than the rows of larger values in its group, which come from counts
    per distinct value and prefix sums over ranges of them (see
    ``operators.distribution``), and are joined back to the rows by group and
    value. The counts are checkpointed when the function is called.
    """
    if not partition_by:
        raise ValueError("with_rank needs at least one partition column")
    if strategy not in RANK_STRATEGIES:
        raise ValueError(f"strategy must be one of {RANK_STRATEGIES}, got {strategy!r}")
    if strategy == "range":
        keys = list(partition_by)
        ranks = rows_before(df, keys, order_by).select(*keys, order_by, (F.col(BEFORE) + 1).cast("int").alias(name))
        return null_safe_join(df, ranks, [*keys, order_by])
    w = Window.partitionBy(*partition_by).orderBy(F.col(order_by).desc())
    return df.withColumn(name, F.rank().over(w))
