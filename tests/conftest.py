from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from gridpulse import schema as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("gridpulse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from gridpulse.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="gridpulse-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return Path(tempfile.mkdtemp(prefix="gridpulse-test-"))


def epoch_ms(y, mo, d, h=0, mi=0, s=0, ms=0) -> int:
    return int(dt.datetime(y, mo, d, h, mi, s, tzinfo=UTC).timestamp()) * 1000 + ms


def rec(grid, ms, country=1, sms_in=0.0, sms_out=0.0, call_in=0.0, call_out=0.0, internet=0.0):
    return (grid, ms, country, sms_in, sms_out, call_in, call_out, internet)


@pytest.fixture()
def activity(spark):
    """Build a raw activity frame from ``rec(...)`` tuples."""

    def make(rows):
        return spark.createDataFrame(rows, S.ACTIVITY_SCHEMA)

    return make
