"""Sources: delimited activity files, text lines, and adapters over test tables."""

from gridpulse.sources.activity import (
    read_activity,
    read_activity_checked,
    read_activity_epoch,
    read_activity_parquet,
    reject_counts,
    stage_checked,
)
from gridpulse.sources.events import events_as_activity, events_as_cells, read_events
from gridpulse.sources.text import read_lines, read_text_pieces

__all__ = [
    "events_as_activity",
    "events_as_cells",
    "read_activity",
    "read_activity_checked",
    "read_activity_epoch",
    "read_activity_parquet",
    "read_events",
    "read_lines",
    "read_text_pieces",
    "reject_counts",
    "stage_checked",
]
