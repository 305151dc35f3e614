"""Operations per device and day: the job's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from hearthlog.config import MAX_BROADCAST_BYTES
from hearthlog.functions.event_time import day
from hearthlog.operators.counts import count_by_day, daily_columns
from hearthlog.operators.fault_lookup import Normalizer, fits_broadcast, known_faults
from hearthlog.plans.single_scan import RAW_KEY, name_operations, raw_operations
from hearthlog.plans.views import operation_events


def daily_operation_counts_union(
    log: DataFrame, dictionary: DataFrame, broadcast: bool | None = None
) -> DataFrame:
    """The counts over the union of the views: easy to read, three scans."""
    return count_by_day(operation_events(log, dictionary, broadcast))


def daily_operation_counts(
    log: DataFrame,
    dictionary: DataFrame,
    broadcast: bool | None = None,
    last_event: bool = False,
    observation: Observation | str | None = None,
    normalize: Normalizer | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The counts in one scan.

    With a broadcast dictionary the only shuffle is the aggregate's, behind a map-side
    partial count. A bigger dictionary meets a batch log after it has been counted,
    when there are fewest rows left to shuffle; a stream is joined first, because a
    stream must not look up past events again when the dictionary changes.
    """
    known = known_faults(dictionary, normalize)
    if broadcast is not False:
        broadcast = fits_broadcast(known, max_broadcast_bytes)
    raw = raw_operations(log, observation)
    if broadcast or log.isStreaming:
        named = name_operations(raw, known, broadcast, normalize)
        return count_by_day(named, F.col("_copies"), last_event)
    return _count_then_name(raw, known, last_event, normalize)


def _count_then_name(
    raw: DataFrame, known: DataFrame, last_event: bool, normalize: Normalizer | None
) -> DataFrame:
    measures = [F.count("*").alias("cnt")]
    if last_event:
        measures.append(F.max("ts_ltz").alias("last_ts"))
    counted = raw.groupBy(day(F.col("ts_ltz")).alias("_day"), *RAW_KEY).agg(*measures)
    named = name_operations(counted, known, broadcast=False, normalize=normalize)
    total = F.col("cnt") * F.col("_copies")
    return named.withColumn("cnt", total).select(*daily_columns(last_event))
