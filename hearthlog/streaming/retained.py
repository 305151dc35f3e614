"""Read the totals that a stream keeps in its state, and begin another stream with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthlog.functions.event_time import day_label
from hearthlog.schemas import DAILY_COUNT, OPERATION_KEY

GROUP = ["ds", *OPERATION_KEY]


def retained_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals in the state of ``start_daily_counts``: daily counts with ``last_ts``.

    They are those of the last finished micro-batch, read by Spark's state data source
    with one task per state partition.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # Keys are the day and OPERATION_KEY, values the count and the newest event, in the
    # order in which ``count_by_day`` groups and aggregates them.
    keys = [f.name for f in state.schema["key"].dataType]
    values = [f.name for f in state.schema["value"].dataType]
    if len(keys) != 1 + len(OPERATION_KEY) or len(values) != 2:
        raise ValueError(f"{checkpoint} does not hold the state of daily counts")
    day, *names = [F.col("key").getField(name) for name in keys]
    cnt, last_ts = [F.col("value").getField(name) for name in values]
    return state.select(
        day_label(day).alias("ds"),
        *[column.alias(name) for column, name in zip(names, OPERATION_KEY)],
        cnt.cast("bigint").alias("cnt"),
        last_ts.alias("last_ts"),
    )


def with_base(counts: DataFrame, base: DataFrame) -> DataFrame:
    """``counts`` of a stream that went on where one with the totals ``base`` had ended.

    Both are daily counts with ``last_ts``. Only groups of ``counts`` come back: the others
    have not changed since ``base``.
    """
    before = base.select(
        *[F.col(name).alias(f"_{name}") for name in GROUP],
        F.col("cnt").alias("_cnt"),
        F.col("last_ts").alias("_last_ts"),
    )
    same = F.lit(True)
    for name in GROUP:
        same = same & counts[name].eqNullSafe(before[f"_{name}"])
    return counts.join(before, same, "left").select(
        *[name for name in DAILY_COUNT.names if name != "cnt"],
        (F.col("cnt") + F.coalesce("_cnt", F.lit(0))).alias("cnt"),
        F.greatest("last_ts", "_last_ts").alias("last_ts"),
    )
