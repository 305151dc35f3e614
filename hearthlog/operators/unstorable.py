"""Events whose counts could not be stored: without a device, or without a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.schemas import DEVICE_LOG, ERROR_CODE, MODE_EVENTS, RECIPE


def is_storable() -> Column:
    """Whether an event has what the stored key needs of it; never NULL.

    An event time outside the years 1 to 9999 (a device that sends microseconds, say)
    gives no timestamp and so no day.
    """
    return F.col("ts_ltz").isNotNull() & F.col("iotId").isNotNull()


def is_counted() -> Column:
    """Whether an event is of a kind that is counted."""
    return F.col("eventName").isin([ERROR_CODE, *MODE_EVENTS, RECIPE])


def storable_events(log: DataFrame) -> DataFrame:
    return log.where(is_storable())


def unstorable_events(log: DataFrame) -> DataFrame:
    """The log rows that counting leaves out, to be kept and looked at."""
    return log.where(is_counted() & ~is_storable()).select(*DEVICE_LOG.names)
