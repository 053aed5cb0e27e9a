"""Point lookups and null-key counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse import schema as S


def point_lookup(df: DataFrame, not_null: Sequence[str] = (), **equals: Any) -> DataFrame:
    """Rows where every named column equals the given value (exact comparison;
    doubles compare bit for bit) and every ``not_null`` column is set.
    Filters on stored columns reach the scan."""
    if not equals and not not_null:
        raise ValueError("point_lookup needs at least one condition")
    conds = [F.col(name) == F.lit(value) for name, value in equals.items()]
    conds += [F.col(name).isNotNull() for name in not_null]
    return df.where(reduce(and_, conds))


def null_key_counts(df: DataFrame, keys: tuple[str, ...] = S.KEYS) -> DataFrame:
    """One row: number of records, and of records with each key null."""
    present = [k for k in keys if k in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in present],
    )
