"""Daily counts of a stream without state: every micro-batch adds its own counts.

A micro-batch is counted like a batch log and its counts are stored as they are; reading
the table adds them up. Nothing is kept between batches, so there is no state to bound,
no event is too late, and replaying a batch overwrites what it had written. Each batch is
planned anew: the dictionary is read and measured for it, and broadcast or merged
accordingly, whatever its size was when the stream began.

A batch is read and decoded once, also where bad messages and events without a place in
the counts are kept aside, and other sinks (a database, say) take the totals that it
changed from the table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthlog.config import MAX_BROADCAST_BYTES
from hearthlog.operators.fault_lookup import Normalizer
from hearthlog.operators.unstorable import is_counted, unstorable_events
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.sinks.batch_writer import (
    CountSink,
    append_batches,
    log_metrics,
    read_metrics,
    upsert_batches,
)
from hearthlog.sinks.change_table import ChangeTable
from hearthlog.sources.device_log import bad_messages, good_rows
from hearthlog.streaming.daily_counts import trigger_of

# The setting that turns adaptive rules off, and the rule that replaces a plan
# once a part of it came out empty.
_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_DROPS_OBSERVATIONS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"

#: A dictionary, or a function that reads it as it is at the time (in seconds since 1970)
#: at which a micro-batch begins.
Dictionary = DataFrame | Callable[[float], DataFrame]


@dataclass(frozen=True)
class Aside:
    """Where a batch's rows go that are not counted. A replayed batch replaces its own."""

    unstorable: str | None = None
    bad_messages: str | None = None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """``rows`` as decoded, with ``bad_message`` if bad messages are to be kept."""
        batch = F.lit(batch_id).cast("bigint").alias("batch_id")
        if self.bad_messages:
            bad = bad_messages(rows).select(F.col("bad_message").alias("value"), batch)
            self._writer(bad).text(self.bad_messages)
        if self.unstorable:
            lost = unstorable_events(_good(rows)).select("*", batch)
            self._writer(lost).json(self.unstorable)

    @staticmethod
    def _writer(rows: DataFrame):
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        return writer.partitionBy("batch_id")


def _good(rows: DataFrame) -> DataFrame:
    return good_rows(rows) if "bad_message" in rows.columns else rows


def start_partial_counts(
    log: DataFrame,
    dictionary: Dictionary,
    table: ChangeTable,
    checkpoint: str,
    interval: str = "60 seconds",
    until_caught_up: bool = False,
    null_keys: str = "drop",
    normalize: Normalizer | None = None,
    on_metrics: Callable[[int, dict[str, int]], None] = log_metrics,
    name: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    forward: CountSink | None = None,
    aside: Aside | None = None,
    clock: Callable[[int], float] = lambda batch_id: time.time(),
    after_batch: Callable[[int], None] = lambda batch_id: None,
) -> StreamingQuery:
    """Start counting ``log`` into ``table``, which must add its batches up (``partial``).

    ``forward`` is written the totals that each batch changed. Rows go ``aside`` from the
    same read: the decoded batch is held by the executors until it has been stored. The
    ``clock`` gives a batch's time, which decides what a versioned dictionary holds and
    when the counts of a table with a time to live expire. The metrics of a batch also
    tell its ``bad_error_codes``.
    """
    if not table.partial:
        raise ValueError("partial counts need a table that adds them up")

    def count(rows: DataFrame, batch_id: int, at: float) -> None:
        parsed = Observation()
        counts = daily_operation_counts(
            _good(rows),
            dictionary(at) if callable(dictionary) else dictionary,
            last_event=True,
            observation=parsed,
            normalize=normalize,
            max_broadcast_bytes=max_broadcast_bytes,
        )
        stored: dict[str, int] = {}
        sink = _AtTime(table, at)
        upsert_batches(sink, null_keys, lambda _, found: stored.update(found))(counts, batch_id)
        if forward is not None:
            changed = table.changed(rows.sparkSession, batch_id)
            write = upsert_batches(forward, null_keys) if forward.keyed else append_batches(forward)
            write(changed, batch_id)
        on_metrics(batch_id, {**stored, **(read_metrics(parsed) if stored else {})})

    def process(batch: DataFrame, batch_id: int) -> None:
        _keep_observations(batch.sparkSession)
        if aside is None:
            count(batch, batch_id, clock(batch_id))
        else:
            wanted = is_counted()
            if "bad_message" in batch.columns:
                wanted = wanted | F.col("bad_message").isNotNull()
            held = batch.where(wanted).persist()
            try:
                aside.write(held, batch_id)
                count(held, batch_id, clock(batch_id))
            finally:
                held.unpersist()
        after_batch(batch_id)

    writer = (
        log.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval, until_caught_up))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def _keep_observations(session: SparkSession) -> None:
    """An empty result must still count its bad codes. The session is the stream's own copy."""
    rules = [r for r in session.conf.get(_EXCLUDED, "").split(",") if r]
    if _DROPS_OBSERVATIONS not in rules:
        session.conf.set(_EXCLUDED, ",".join([*rules, _DROPS_OBSERVATIONS]))


@dataclass(frozen=True)
class _AtTime:
    """A change table that is written at a given time."""

    table: ChangeTable
    at: float
    keyed: bool = True
    settles: bool = True

    def write(self, counts: DataFrame, batch_id: int) -> None:
        self.table.write(counts, batch_id, self.at)
