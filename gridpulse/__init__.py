"""gridpulse: mobile-network activity analytics as Spark DataFrame functions.

Read activity records (``sources``), add timestamps, dates and totals under a
null policy (``functions``), and answer peak, rank, average, category and
word-count questions (``plans.queries``, built from ``operators``). Results
are lazy DataFrames; write them with ``sinks``.
"""

from gridpulse.functions.columns import prepare_activity
from gridpulse.operators.words import word_count
from gridpulse.plans import queries
from gridpulse.sinks import write_by_date, write_json, write_word_counts
from gridpulse.sources import read_activity, read_activity_epoch, read_lines

__all__ = [
    "prepare_activity",
    "queries",
    "read_activity",
    "read_activity_epoch",
    "read_lines",
    "word_count",
    "write_by_date",
    "write_json",
    "write_word_counts",
]
