"""Counts in files: the changes of each micro-batch, added up when they are read."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce
from typing import ClassVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from hearthlog.operators.counts import last_write_per_key
from hearthlog.schemas import DAILY_COUNT, OPERATION_KEY

GROUP = ["ds", *OPERATION_KEY]
_ROWS = T.StructType(
    [
        *DAILY_COUNT.fields,
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
        T.StructField("restarted", T.BooleanType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("epoch", T.LongType()),
    ]
)

# Kinds of change, as changelogs write them.
INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


@dataclass(frozen=True)
class ChangeTable:
    """A table of counts kept as the changes of each micro-batch.

    A batch is one partition, written by Spark's dynamic partition overwrite: a replayed
    batch replaces itself. So many consecutive batches are an epoch. Once a later epoch
    has begun no batch of it can come any more, and ``close_epochs``, a job of its own,
    groups its rows and overwrites the epoch's partition of the closed half. Reading takes
    an epoch from the closed half if it is there, else from the open one, so the job may
    run beside the stream and may be ended and repeated at any moment. A table belongs to
    one checkpoint, whose batch numbers it uses.

    Rows are kept per group with the time of its newest event, and groups that share a
    stored key are settled when the table is read. What is read does not depend on how
    the input was cut into batches. With ``partial`` the counts of all batches add up;
    without it they are absolute, and a group's newest change is its value.

    With ``ttl_ms`` a group that no batch changed for that long starts again from its next
    change. No state decides that but the times of the batches, which the rows carry.
    """

    keyed: ClassVar[bool] = True
    settles: ClassVar[bool] = True

    path: str
    partial: bool = False
    ttl_ms: int | None = None
    epoch_batches: int = 1000

    def __post_init__(self) -> None:
        if self.ttl_ms is not None and not self.partial:
            raise ValueError("a time to live needs a table that adds batches up (partial)")

    def write(self, counts: DataFrame, batch_id: int, at: float | None = None) -> None:
        """Store a batch that was begun ``at`` seconds since 1970 (default: now)."""
        seen = F.timestamp_micros(F.lit(round((time.time() if at is None else at) * 1_000_000)))
        last = F.col("last_ts") if "last_ts" in counts.columns else F.lit(None)
        rows = counts.withColumns(
            {
                "last_ts": last.cast("timestamp"),
                "first_seen": seen,
                "last_seen": seen,
                "restarted": F.lit(False),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "epoch": F.lit(batch_id // self.epoch_batches).cast("bigint"),
            }
        )
        self._overwrite(rows.select(*_ROWS.names).hint("rebalance"), "open", "epoch", "batch_id")

    def current(self, spark: SparkSession) -> DataFrame:
        """One count per stored key."""
        return self.settled(spark).select(*DAILY_COUNT.names)

    def settled(self, spark: SparkSession) -> DataFrame:
        """``current`` with ``last_ts`` and the number of groups ``overwritten``, over all batches."""
        return last_write_per_key(self.groups(spark))

    def groups(self, spark: SparkSession) -> DataFrame:
        """One count per group, before groups that share a stored key are settled."""
        return self._combined(self.rows(spark)).select(*DAILY_COUNT.names, "last_ts")

    def changed(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``groups`` that a batch changed. Only files that may hold their days are read."""
        return self._combined(self._of_batch(spark, batch_id)).select(*DAILY_COUNT.names, "last_ts")

    def changes(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """The changelog: ``batch_id``, ``kind`` and a count, of one or all open batches.

        A group's first count is an insert; later ones are the old count taken back and the
        new one. A group that starts again after its time to live is an insert, too: the
        count it had is forgotten. Closed epochs only give the counts that went before.
        """
        rows = self.rows(spark) if batch_id is None else self._of_batch(spark, batch_id)
        in_turn = Window.partitionBy(*GROUP).orderBy("batch_id")
        starts = F.lag("after").over(in_turn).isNull()
        if self.ttl_ms is None:
            after = F.sum("cnt").over(in_turn) if self.partial else F.col("cnt")
            valued = rows.withColumn("after", after)
        else:
            rows = self._with_islands(rows, GROUP)
            island = Window.partitionBy(*GROUP, "island").orderBy("batch_id")
            valued = rows.withColumn("after", F.sum("cnt").over(island))
            starts = starts | (F.lag("island").over(in_turn) != F.col("island"))

        def change(kind: str, cnt: str) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.col(cnt).alias("cnt"))

        made = F.when(F.col("starts"), F.array(change(INSERT, "after"))).otherwise(
            F.array(change(UPDATE_BEFORE, "before"), change(UPDATE_AFTER, "after"))
        )
        which = ~F.col("closed")
        if batch_id is not None:
            which &= F.col("batch_id") == batch_id
        return (
            valued.withColumns({"starts": starts, "before": F.lag("after").over(in_turn)})
            .where(which)
            .select("batch_id", *GROUP, F.inline(made))
            .select("batch_id", "kind", *DAILY_COUNT.names)
        )

    def rows(self, spark: SparkSession) -> DataFrame:
        """The stored rows, each epoch from the half that holds it for good."""
        closed = self._read(spark, "closed")
        done = closed.select("epoch").distinct()
        still = self._read(spark, "open").join(F.broadcast(done), "epoch", "left_anti")
        return still.withColumn("closed", F.lit(False)).unionByName(
            closed.withColumn("closed", F.lit(True))
        )

    def close_epochs(self, spark: SparkSession) -> list[int]:
        """Group the rows of every epoch that is over, and empty its open half.

        One row per group and epoch is left. Repeating it changes nothing. Returns the
        epochs; their number is that of the batches since the last time by
        ``epoch_batches``.
        """
        batches = self._read(spark, "open")
        newest = batches.agg(F.max("epoch")).first()[0]
        over = sorted(
            r.epoch for r in batches.where(F.col("epoch") < (newest or 0)).select("epoch").distinct().collect()
        )
        if not over:
            return []
        done = {r.epoch for r in self._read(spark, "closed").select("epoch").distinct().collect()}
        rows = batches.where(F.col("epoch").isin([e for e in over if e not in done]))
        grouped = self._combined(rows, "epoch").select(*_ROWS.names)
        # Days lie together, so reading one passes most files by.
        self._overwrite(grouped.repartitionByRange("epoch", "ds").sortWithinPartitions("ds"), "closed", "epoch")
        for epoch in over:
            empty = spark.createDataFrame([], _ROWS).drop("epoch")
            empty.write.mode("overwrite").partitionBy("batch_id").parquet(f"{self.path}/open/epoch={epoch}")
        return over

    def _of_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All rows of the groups that a batch changed, up to that batch."""
        batch = self._read(spark, "open").where(
            (F.col("epoch") == batch_id // self.epoch_batches) & (F.col("batch_id") == batch_id)
        )
        days = batch.agg(F.min("ds").alias("first"), F.max("ds").alias("last")).first()
        rows = self.rows(spark).where(F.col("batch_id") <= batch_id)
        if days.first is not None:
            rows = rows.where(F.col("ds").between(days.first, days.last))
        changed = batch.select(*[F.col(name).alias(f"_{name}") for name in GROUP]).distinct()
        same = [rows[name].eqNullSafe(changed[f"_{name}"]) for name in GROUP]
        return rows.join(changed, reduce(lambda a, b: a & b, same), "left_semi")

    def _with_islands(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """``island``: how often a group has started again, up to and with a row."""
        in_turn = Window.partitionBy(*keys).orderBy("batch_id")
        idle = F.unix_micros("first_seen") - F.unix_micros(F.lag("last_seen").over(in_turn))
        again = F.col("restarted") | F.coalesce(idle >= self.ttl_ms * 1000, F.lit(False))
        return rows.withColumn("_again", again.cast("int")).withColumn(
            "island", F.sum("_again").over(in_turn)
        )

    def _combined(self, rows: DataFrame, *epoch: str) -> DataFrame:
        """One row per group; with ``epoch``, one per epoch, which knows nothing of those before."""
        keys = [*GROUP, *epoch]
        measures = {
            "first_seen": F.min("first_seen"),
            "last_seen": F.max("last_seen"),
            "restarted": F.max("restarted"),
            "batch_id": F.max("batch_id"),
        }
        if not self.partial:
            newest = F.max_by(F.struct("cnt", "last_ts"), "batch_id").alias("_newest")
            grouped = rows.groupBy(*keys).agg(newest, *[c.alias(n) for n, c in measures.items()])
            return grouped.select("*", "_newest.cnt", "_newest.last_ts")
        if self.ttl_ms is None:
            measures |= {"cnt": F.sum("cnt"), "last_ts": F.max("last_ts")}
            return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
        rows = self._with_islands(rows, keys)
        newest = F.max("island").over(Window.partitionBy(*keys))
        last = rows.withColumn("_last", F.col("island") == newest)
        measures |= {
            "restarted": F.max("island") > 0,
            "cnt": F.sum(F.when(F.col("_last"), F.col("cnt"))),
            "last_ts": F.max(F.when(F.col("_last"), F.col("last_ts"))),
        }
        return last.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])

    def _read(self, spark: SparkSession, half: str) -> DataFrame:
        try:
            return spark.read.schema(_ROWS).parquet(f"{self.path}/{half}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _ROWS)

    def _overwrite(self, rows: DataFrame, half: str, *partitions: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(f"{self.path}/{half}")
