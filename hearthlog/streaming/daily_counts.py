"""The continuous job: device log in, daily counts out."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hearthlog.config import MAX_BROADCAST_BYTES
from hearthlog.operators.fault_lookup import Normalizer, fits_broadcast, known_faults
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.sinks.batch_writer import (
    CountSink,
    append_batches,
    log_metrics,
    upsert_batches,
)
from hearthlog.operators.unstorable import unstorable_events
from hearthlog.sources.device_log import bad_messages
from hearthlog.streaming.retained import with_base

log = logging.getLogger(__name__)

# Fixed value: name of the state store provider that keeps state off the JVM heap.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Name under which progress reports carry ``bad_error_codes``.
METRICS = "device_log"


def configure_streaming(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """Keep state in RocksDB and checkpoint its changes only.

    ``shuffle_partitions`` is the number of state partitions. It is fixed by the first
    start of a checkpoint, so choose it for the state that the job will grow to.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))


class OutgrownDictionary(RuntimeError):
    """The dictionary no longer fits a broadcast."""

    MARK = "the fault dictionary has outgrown"


def dictionary_strategy(
    dictionary: DataFrame, broadcast: bool | None, max_bytes: int, every: int = 10
) -> tuple[bool, Callable[[], None] | None]:
    """Whether to broadcast, and a check that it still holds, made every so many batches.

    A dictionary may grow while a stream runs. The check ends the query before its next
    batch; ``keep_counting`` starts it again from its checkpoint with a merge join.
    """
    if broadcast is False:
        return False, None
    known = known_faults(dictionary)
    if not fits_broadcast(known, max_bytes):
        return False, None
    batches = itertools.count()

    def still_fits() -> None:
        if next(batches) % every == 0 and not fits_broadcast(known, max_bytes):
            raise OutgrownDictionary(f"{OutgrownDictionary.MARK} {max_bytes} bytes")

    return True, still_fits


def keep_counting(
    start: Callable[[bool | None], StreamingQuery], beside: Sequence[StreamingQuery] = ()
) -> None:
    """Run a query to its end; end everything when it or one ``beside`` it fails.

    ``start`` takes what ``broadcast`` shall be. When the dictionary has outgrown memory
    the query is started again with a merge join: the batch that found it out had not
    begun, so nothing is lost or counted twice. The queries beside are awaited too if
    they end by themselves.
    """
    main = start(None)
    merged = False
    try:
        while True:
            try:
                if main.awaitTermination(1):
                    break
            except StreamingQueryException as error:
                if merged or OutgrownDictionary.MARK not in str(error):
                    raise
                log.warning("%s memory: going on with a merge join", OutgrownDictionary.MARK)
                main, merged = start(False), True
            for query in beside:
                if not query.isActive and query.exception():
                    raise query.exception()
        for query in beside:
            query.awaitTermination()
    finally:
        for query in (main, *beside):
            if query.isActive:
                query.stop()


def start_daily_counts(
    events: DataFrame,
    dictionary: DataFrame,
    sink: CountSink,
    checkpoint: str,
    interval: str = "60 seconds",
    until_caught_up: bool = False,
    null_keys: str = "drop",
    broadcast: bool | None = None,
    normalize: Normalizer | None = None,
    on_metrics=log_metrics,
    name: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    base: DataFrame | None = None,
) -> StreamingQuery:
    """Start counting ``events`` and upserting every changed count.

    The state holds every count for good. There is no watermark: no event is too late, and
    a count is never lowered. Faults are looked up once, when their micro-batch runs; later
    dictionary changes leave past counts alone. Absolute counts and keyed upserts make a
    replayed batch harmless. ``until_caught_up`` stops after the input present at the start.

    ``base`` holds the totals of a stream that this one goes on with (``retained_counts``,
    written to files). That is how the number of state partitions can change: a new
    checkpoint, with the old one's totals and offsets.
    """
    broadcast, before = dictionary_strategy(dictionary, broadcast, max_broadcast_bytes)
    counts = daily_operation_counts(
        events,
        dictionary,
        broadcast=broadcast,
        last_event=True,
        observation=METRICS,
        normalize=normalize,
    )
    write = (
        upsert_batches(sink, null_keys, on_metrics, before)
        if sink.keyed
        else append_batches(sink, before)
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        write(batch if base is None else with_base(batch, base), batch_id)

    writer = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(process)
    )
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger_of(interval, until_caught_up)).start()


def trigger_of(interval: str, until_caught_up: bool) -> dict:
    return {"availableNow": True} if until_caught_up else {"processingTime": interval}


def start_bad_messages(
    decoded: DataFrame, path: str, checkpoint: str, until_caught_up: bool = False
) -> StreamingQuery:
    """Keep the messages that ``decode_json(..., quarantine=True)`` set aside, as text files."""
    return (
        bad_messages(decoded)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of("60 seconds", until_caught_up))
        .start()
    )


def start_unstorable(
    events: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "60 seconds",
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Keep the events that counting leaves out, as JSON files. It reads the source again."""
    return (
        unstorable_events(events)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval, until_caught_up))
        .start()
    )


def start_console(
    frame: DataFrame,
    checkpoint: str,
    output_mode: str = "append",
    interval: str = "60 seconds",
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Print a log or a view as it arrives (``append``), or changed counts (``update``)."""
    return (
        frame.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .option("truncate", "false")
        .format("console")
        .trigger(**trigger_of(interval, until_caught_up))
        .start()
    )
