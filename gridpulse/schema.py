"""Column names, record schemas and null policies of the activity data model.

An activity record is the traffic volume of one grid cell, one interval and
one country: SMS in/out, calls in/out and internet, each nullable.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the activity record, in file order.
GRID_ID = "gridId"
INTERVAL_START = "intervalStart"
ACTIVITY_START_EPOCH = "activityStartEpoch"
COUNTRY_CODE = "countryCode"
SMS_IN = "smsIn"
SMS_OUT = "smsOut"
CALL_IN = "callIn"
CALL_OUT = "callOut"
INTERNET = "internet"

# Derived column names.
ACTIVITY_DATE_TIME = "activityDateTime"
TOTAL_ACTIVITY = "totalActivity"
ACTIVITY_DATE = "activityDate"
HOUR = "hour"
SUMMED_ACTIVITY = "summedActivity"
AVERAGE_ACTIVITY = "averageActivity"
COUNTRY_ACTIVITY = "countryActivity"
CATEGORY = "category"
RANK = "rank"

MEASURES: tuple[str, ...] = (SMS_IN, SMS_OUT, CALL_IN, CALL_OUT, INTERNET)
KEYS: tuple[str, ...] = (GRID_ID, INTERVAL_START, COUNTRY_CODE)


def activity_schema(
    measure_type: T.DataType | None = None,
    epoch_name: str = INTERVAL_START,
    keys_nullable: bool = True,
) -> T.StructType:
    """Record schema; measures are doubles unless ``measure_type`` is given
    (e.g. ``DecimalType(18, 2)`` for exact, order-independent sums)."""
    measure = measure_type or T.DoubleType()
    return T.StructType(
        [
            T.StructField(GRID_ID, T.IntegerType(), keys_nullable),
            T.StructField(epoch_name, T.LongType(), keys_nullable),
            T.StructField(COUNTRY_CODE, T.IntegerType(), keys_nullable),
        ]
        + [T.StructField(m, measure, True) for m in MEASURES]
    )


# Raw record: epoch in milliseconds, five nullable measures.
ACTIVITY_SCHEMA = activity_schema()

# The same layout with the epoch column named ``activityStartEpoch`` and the
# keys declared non-nullable (file sources still read every column nullable).
EPOCH_ACTIVITY_SCHEMA = activity_schema(epoch_name=ACTIVITY_START_EPOCH, keys_nullable=False)

# Metadata key of a total whose sums of doubles are to be independent of their order.
REPRODUCIBLE = "reproducibleSum"

# Null policies for the total of the five measures:
#   "zero"      -> null and NaN measures become 0 before summing; every row counts
#   "propagate" -> total is null when any measure is null; sums and averages skip it
ZERO = "zero"
PROPAGATE = "propagate"
NULL_POLICIES = (ZERO, PROPAGATE)


def check_null_policy(null_policy: str) -> str:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {null_policy!r}")
    return null_policy
