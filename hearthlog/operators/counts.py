"""Counting operations per day, and what happens to counts on the stored key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.functions.event_time import day, day_label
from hearthlog.schemas import DAILY_COUNT, OPERATION_KEY, UPSERT_KEY


def count_by_day(
    operations: DataFrame, weight: Column | None = None, last_event: bool = False
) -> DataFrame:
    """Events per operation key and day.

    Days are grouped as dates and written out once per group. ``weight`` counts a row
    as several; ``last_event`` adds the time of the newest event as ``last_ts``.
    """
    cnt = F.count("*") if weight is None else F.sum(weight)
    measures = [cnt.alias("cnt")]
    if last_event:
        measures.append(F.max("ts_ltz").alias("last_ts"))
    return (
        operations.groupBy(day(F.col("ts_ltz")).alias("_day"), *OPERATION_KEY)
        .agg(*measures)
        .select(*daily_columns(last_event))
    )


def daily_columns(last_event: bool) -> list[Column]:
    """The stored columns of counts that are grouped by ``_day``."""
    label = day_label(F.col("_day")).alias("ds")
    names = [*DAILY_COUNT.names, *(["last_ts"] if last_event else [])]
    return [label if name == "ds" else F.col(name) for name in names]


def last_write_per_key(counts: DataFrame) -> DataFrame:
    """One count per stored key: the group with the newest event, the others are lost.

    Counts are grouped by more columns than the stored key has, and groups that share
    a key overwrite one another. Ties go to the greatest remaining columns, so that
    reruns agree. ``overwritten`` tells how many groups the winner replaced.
    """
    rest = [c for c in DAILY_COUNT.names if c not in UPSERT_KEY]
    return (
        counts.groupBy(*UPSERT_KEY)
        .agg(
            F.max(F.struct("last_ts", *rest)).alias("_last"),
            (F.count("*") - 1).alias("overwritten"),
        )
        .select(*UPSERT_KEY, *[F.col(f"_last.{c}") for c in ("last_ts", *rest)], "overwritten")
        .select(*DAILY_COUNT.names, "last_ts", "overwritten")
    )


def sink_key_collisions(counts: DataFrame) -> DataFrame:
    """Stored keys that several groups share, with the count they have together."""
    return (
        counts.groupBy(*UPSERT_KEY)
        .agg(F.count("*").alias("groups"), F.sum("cnt").alias("total_cnt"))
        .where(F.col("groups") > 1)
    )


def has_null_key() -> Column:
    """True for a count that cannot be stored because a key column is NULL."""
    missing = F.lit(False)
    for name in UPSERT_KEY:
        missing = missing | F.col(name).isNull()
    return missing


def require_keys(counts: DataFrame) -> DataFrame:
    """Fail the job, with a message, on a count that has a NULL in its stored key."""
    message = F.lit(f"a daily count has NULL in one of its key columns {UPSERT_KEY}")
    checked = F.when(has_null_key(), F.raise_error(message).cast("bigint"))
    return counts.withColumn("cnt", checked.otherwise(F.col("cnt")))
