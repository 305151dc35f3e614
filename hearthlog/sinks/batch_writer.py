"""What happens to a micro-batch of changed counts before a sink stores it."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F

from hearthlog.operators.counts import has_null_key, last_write_per_key, require_keys

log = logging.getLogger(__name__)


class CountSink(Protocol):
    #: Whether rows replace those of the same key, as opposed to being added.
    keyed: bool
    #: Whether the sink takes every group and settles shared keys itself.
    settles: bool

    def write(self, counts: DataFrame, batch_id: int) -> None: ...


def log_metrics(batch_id: int, metrics: dict[str, int]) -> None:
    log.info("batch %s: %s", batch_id, metrics)


def read_metrics(observation: Observation) -> dict[str, int]:
    """What was observed, or nothing where the plan ended without the observing step.

    Adaptive execution drops a step whose input it has seen to be empty. A metric must
    not stop the job over that.
    """
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


def upsert_batches(
    sink: CountSink,
    null_keys: str = "fail",
    on_metrics: Callable[[int, dict[str, int]], None] = log_metrics,
    before: Callable[[], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: check keys, settle shared keys, write.

    ``null_keys`` says what to do with a count whose stored key holds a NULL: ``fail``
    the job or ``drop`` it (``unstorable_events`` keeps the events behind it). Metrics per
    batch are ``null_key_rows`` and, for a sink that does not settle shared keys itself,
    ``overwritten`` (groups of the batch that lost a stored key to another one).
    Everything runs in the sink's one write: a second action on the batch would repeat
    the stateful work. ``before`` runs ahead of every batch and may raise to stop the job.
    """
    if null_keys not in ("fail", "drop"):
        raise ValueError("null_keys must be 'fail' or 'drop'")

    def write(counts: DataFrame, batch_id: int) -> None:
        if before:
            before()
        keys, stored = Observation(), Observation()
        checked = counts.observe(keys, F.count_if(has_null_key()).alias("null_key_rows"))
        if null_keys == "fail":
            checked = require_keys(checked)
        else:
            checked = checked.where(~has_null_key())
        if sink.settles:
            sink.write(checked, batch_id)
            on_metrics(batch_id, read_metrics(keys))
            return
        overwritten = F.coalesce(F.sum("overwritten"), F.lit(0)).alias("overwritten")
        rows = last_write_per_key(checked).observe(stored, overwritten)
        sink.write(rows, batch_id)
        on_metrics(batch_id, {**read_metrics(keys), **read_metrics(stored)})

    return write


def append_batches(
    sink: CountSink, before: Callable[[], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a sink without a key: every changed count, as it is."""

    def write(counts: DataFrame, batch_id: int) -> None:
        if before:
            before()
        sink.write(counts, batch_id)

    return write
