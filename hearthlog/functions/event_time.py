"""Event time and the day an event is counted under."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# The first and last millisecond of the years 1 to 9999 in UTC.
_FIRST_MS = -62135596800000
_LAST_MS = 253402300799999


def event_time(epoch_ms: Column) -> Column:
    """The timestamp, or NULL for a number outside the years 1 to 9999.

    A device that sends microseconds, say, would otherwise stop the job or count under
    a day in the far future. Such events have no day: a stream keeps them aside
    (``operators/unstorable.py``) and goes on.
    """
    return F.when(epoch_ms.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(epoch_ms))


def day(ts: Column) -> Column:
    """The calendar day in the session's time zone: a 4-byte grouping key."""
    return ts.cast("date")


def day_label(date: Column) -> Column:
    """The stored form of a day, made once per group rather than once per event."""
    return F.date_format(date, "yyyy-MM-dd")
