from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hearthlog import fixtures
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.schemas import DAILY_COUNT, DEVICE_LOG
from hearthlog.sinks.analytic_table import AnalyticTable
from hearthlog.sinks.change_table import ChangeTable
from hearthlog.sources.device_log import read_files
from hearthlog.sources.fault_dictionary import read_dictionary_files
from hearthlog.streaming.daily_counts import (
    METRICS,
    configure_streaming,
    start_daily_counts,
    start_unstorable,
)
from hearthlog.streaming.offsets import OffsetExport, exported_offsets
from hearthlog.streaming.partial_counts import Aside, start_partial_counts
from hearthlog.streaming.retained import retained_counts

EVENTS = "/root/testdata/sf0.001/events.parquet"


def bag(frame):
    return sorted(map(repr, frame.select(*DAILY_COUNT.names).collect()))


def add_rows(log, path, part):
    """One more file in a log folder, as a batch of arriving events."""
    log.select(*DEVICE_LOG.names).coalesce(1).write.mode("append").parquet(f"{path}/part={part}")


@pytest.fixture
def split_log(spark, tmp_path):
    """The test log as four files that arrive one per micro-batch."""
    log = fixtures.device_log(spark.read.parquet(EVENTS)).cache()
    for part in range(4):
        add_rows(log.where(F.col("requestId").cast("int") % 4 == part), tmp_path / "log", part)
    yield log
    log.unpersist()


def stream_of(spark, tmp_path):
    return read_files(spark, f"{tmp_path}/log/*", max_files_per_trigger=1)


def run(query):
    assert query.awaitTermination(120)
    return query


def start(spark, tmp_path, dictionary, sink=None, **options):
    table = ChangeTable(f"{tmp_path}/table")
    query = start_daily_counts(
        stream_of(spark, tmp_path),
        dictionary,
        sink or table,
        f"{tmp_path}/checkpoint",
        until_caught_up=True,
        **options,
    )
    return query, table


@pytest.mark.parametrize("broadcast", [True, False])
def test_stream_equals_batch(spark, tmp_path, split_log, broadcast):
    dictionary = fixtures.fault_dictionary(spark)
    metrics = {}
    query, table = start(
        spark, tmp_path, dictionary, broadcast=broadcast, on_metrics=metrics.__setitem__
    )
    run(query)
    assert bag(table.current(spark)) == bag(daily_operation_counts(split_log, dictionary))
    reports = [p for p in query.recentProgress if p.numInputRows]
    # Four micro-batches, and the source is read once.
    assert len(reports) == 4
    assert sum(p.numInputRows for p in reports) == split_log.count()
    bad = sum(p.observedMetrics[METRICS].bad_error_codes for p in reports)
    is_bad = (F.col("eventName") == "ErrorCode") & F.col("eventValue").startswith("ErrorCode:x")
    assert bad == split_log.where(is_bad).count() > 0
    assert metrics == {i: {"null_key_rows": 0} for i in range(4)}


def test_restart_continues_the_counts(spark, tmp_path, split_log):
    dictionary = fixtures.fault_dictionary(spark)
    run(start(spark, tmp_path, dictionary)[0])
    add_rows(split_log, tmp_path / "log", 4)
    query, table = start(spark, tmp_path, dictionary)
    run(query)
    twice = daily_operation_counts(split_log.unionAll(split_log), dictionary)
    assert bag(table.current(spark)) == bag(twice)


class FailsOnce:
    """Writes a batch, then fails before the stream can commit it."""

    keyed = True
    settles = True
    partial = True

    def __init__(self, table):
        self.table, self.failed, self.batches = table, False, []

    def write(self, counts, batch_id, *at):
        self.table.write(counts, batch_id, *at)
        self.batches.append(batch_id)
        if batch_id == 2 and not self.failed:
            self.failed = True
            raise RuntimeError("lost the driver")


def test_replayed_batch_changes_nothing(spark, tmp_path, split_log):
    dictionary = fixtures.fault_dictionary(spark)
    sink = FailsOnce(ChangeTable(f"{tmp_path}/table"))
    query, table = start(spark, tmp_path, dictionary, sink)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    run(start(spark, tmp_path, dictionary, sink)[0])
    assert sink.batches == [0, 1, 2, 2, 3]
    assert bag(table.current(spark)) == bag(daily_operation_counts(split_log, dictionary))


MODE = {"eventName": "StOvMode", "eventValue": "StOvMode:1"}
FAULT = {"eventName": "ErrorCode", "eventValue": "ErrorCode:1", "eventOriValue": "ErrorCode:0"}


def test_null_keys_fail_or_are_dropped(spark, tmp_path, log_of, dictionary_of):
    add_rows(log_of(MODE, {**MODE, "gmtCreate": None}, {**MODE, "iotId": None}), tmp_path / "log", 0)
    dictionary = dictionary_of(("T", "P1", "E1", "one"))
    query, table = start(spark, tmp_path, dictionary, null_keys="fail")
    with pytest.raises(StreamingQueryException, match="NULL in one of its key columns"):
        query.awaitTermination(120)
    metrics = {}
    query, table = start(spark, tmp_path, dictionary, on_metrics=metrics.__setitem__)
    run(query)
    assert [(r.iotId, r.cnt) for r in table.current(spark).collect()] == [("iot1", 1)]
    assert metrics == {0: {"null_key_rows": 2}}


def test_unstorable_events_are_kept(spark, tmp_path, log_of, dictionary_of):
    late = {**MODE, "gmtCreate": 1667491200000000}
    add_rows(log_of(MODE, late, {**MODE, "iotId": None}, {"eventName": "Temp", "iotId": None}), tmp_path / "log", 0)
    query = start_unstorable(
        stream_of(spark, tmp_path), f"{tmp_path}/aside", f"{tmp_path}/c", until_caught_up=True
    )
    run(query)
    kept = spark.read.json(f"{tmp_path}/aside").collect()
    assert sorted(r.gmtCreate for r in kept) == [1667491200000, 1667491200000000]


LATER = {**MODE, "productKey": "P0", "gmtCreate": 1667491200001}
EARLIER = {**MODE, "productKey": "P0", "gmtCreate": 1667491199999}


@pytest.mark.parametrize("partial", [True, False])
@pytest.mark.parametrize("cut", [1, 2, 4])
@pytest.mark.parametrize("other, kept", [(LATER, ("P0", 1)), (EARLIER, ("P1", 3))])
def test_shared_keys_are_settled_whatever_the_batches(
    spark, tmp_path, log_of, dictionary_of, partial, cut, other, kept
):
    rows = [MODE, MODE, MODE, other]
    for part in range(cut):
        add_rows(log_of(*rows[part::cut]), tmp_path / "log", part)
    dictionary = dictionary_of(("T", "P1", "E1", "one"))
    table = ChangeTable(f"{tmp_path}/table", partial)
    begin = start_partial_counts if partial else start_daily_counts
    run(
        begin(stream_of(spark, tmp_path), dictionary, table, f"{tmp_path}/c", until_caught_up=True)
    )
    rows = table.settled(spark).collect()
    assert [(r.productKey, r.cnt, r.overwritten) for r in rows] == [(*kept, 1)]


def start_partial(spark, tmp_path, dictionary, sink=None, **options):
    table = ChangeTable(f"{tmp_path}/table", partial=True)
    query = start_partial_counts(
        stream_of(spark, tmp_path), dictionary, sink or table, f"{tmp_path}/checkpoint",
        until_caught_up=True, **options,
    )
    return query, table


@pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])
def test_partial_counts_equal_batch(spark, tmp_path, split_log, max_broadcast_bytes):
    dictionary, metrics = fixtures.fault_dictionary(spark), {}
    query, table = start_partial(
        spark, tmp_path, dictionary, on_metrics=metrics.__setitem__,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    run(query)
    assert bag(table.current(spark)) == bag(daily_operation_counts(split_log, dictionary))
    is_bad = (F.col("eventName") == "ErrorCode") & F.col("eventValue").startswith("ErrorCode:x")
    assert sum(m["bad_error_codes"] for m in metrics.values()) == split_log.where(is_bad).count()
    # No operator of the query keeps state.
    assert all(not p.stateOperators for p in query.recentProgress)
    add_rows(split_log, tmp_path / "log", 4)
    run(start_partial(spark, tmp_path, dictionary)[0])
    twice = daily_operation_counts(split_log.unionAll(split_log), dictionary)
    assert bag(table.current(spark)) == bag(twice)


def test_replayed_partial_counts_do_not_add(spark, tmp_path, split_log):
    dictionary = fixtures.fault_dictionary(spark)
    sink = FailsOnce(ChangeTable(f"{tmp_path}/table", partial=True))
    query, table = start_partial(spark, tmp_path, dictionary, sink)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    run(start_partial(spark, tmp_path, dictionary, sink)[0])
    assert sink.batches == [0, 1, 2, 2, 3]
    assert bag(table.current(spark)) == bag(daily_operation_counts(split_log, dictionary))
    with pytest.raises(ValueError, match="adds them up"):
        start_partial(spark, tmp_path, dictionary, ChangeTable("unused"))


def test_a_sink_without_a_key_gets_every_group(spark, tmp_path, log_of, dictionary_of):
    rows = [MODE, MODE, {**MODE, "productKey": "P0"}, {**MODE, "iotId": None}]
    add_rows(log_of(*rows), tmp_path / "log", 0)
    add_rows(log_of(MODE), tmp_path / "log", 1)
    sink = AnalyticTable("parquet", {"path": f"{tmp_path}/analytic"})
    run(start(spark, tmp_path, dictionary_of(("T", "P1", "E1", "one")), sink)[0])
    written = spark.read.parquet(f"{tmp_path}/analytic").collect()
    assert sorted((r.productkey, r.iotid or "", r.cnt) for r in written) in (
        [("P0", "iot1", 1), ("P1", "", 1), ("P1", "iot1", 2), ("P1", "iot1", 3)],
        [("P0", "iot1", 1), ("P1", "", 1), ("P1", "iot1", 1), ("P1", "iot1", 3)],
    )


def test_dictionary_changes_leave_past_counts_alone(spark, tmp_path, log_of, dictionary_of):
    add_rows(log_of(FAULT), tmp_path / "log", 0)
    run(start(spark, tmp_path, dictionary_of(("T", "P9", "E1", "other")))[0])
    add_rows(log_of(FAULT, FAULT), tmp_path / "log", 1)
    run(start(spark, tmp_path, dictionary_of(("T", "P1", "E1", "one")))[0])
    add_rows(log_of(FAULT), tmp_path / "log", 2)
    query, table = start(spark, tmp_path, dictionary_of(("T", "P1", "E1", "renamed")))
    run(query)
    # The first event found no entry and stays uncounted. The new name is a group of its
    # own, which overwrites the old one under the stored key.
    rows = table.current(spark).collect()
    assert [(r.optId, r.optName, r.cnt) for r in rows] == [("E1", "renamed", 1)]
    groups = table.groups(spark).orderBy("optName").collect()
    assert [(r.optName, r.cnt) for r in groups] == [("one", 2), ("renamed", 1)]


@pytest.fixture
def rocksdb(spark):
    configure_streaming(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")


def test_rocksdb_state_gives_the_same_counts(spark, tmp_path, split_log, rocksdb):
    dictionary = fixtures.fault_dictionary(spark)
    query, table = start(spark, tmp_path, dictionary)
    run(query)
    assert bag(table.current(spark)) == bag(daily_operation_counts(split_log, dictionary))


def test_json_messages_as_a_stream(spark, tmp_path, log_of, dictionary_of):
    log = log_of(MODE, FAULT, FAULT)
    messages = log.select(F.to_json(F.struct(*DEVICE_LOG.names)).alias("value"))
    messages.coalesce(1).write.text(f"{tmp_path}/log")
    dictionary = dictionary_of(("T", "P1", "E1", "one"))
    table = ChangeTable(f"{tmp_path}/table")
    query = start_daily_counts(
        read_files(spark, f"{tmp_path}/log", "json"),
        dictionary,
        table,
        f"{tmp_path}/checkpoint",
        until_caught_up=True,
    )
    run(query)
    assert bag(table.current(spark)) == bag(daily_operation_counts(log, dictionary))
    assert [p.name for p in Path(f"{tmp_path}/table/open/epoch=0").glob("batch*")] == ["batch_id=0"]


def test_a_fresh_dictionary_applies_from_the_next_batch(spark, tmp_path, log_of, dictionary_of):
    folder = f"{tmp_path}/dictionary"
    other, named = dictionary_of(("T", "P9", "E1", "other")), dictionary_of(("T", "P1", "E1", "one"))
    other.coalesce(1).write.parquet(folder)
    table = ChangeTable(f"{tmp_path}/table", partial=True)
    add_rows(log_of(FAULT), tmp_path / "log", 0)
    query = start_partial_counts(
        stream_of(spark, tmp_path),
        lambda at: read_dictionary_files(spark, folder),
        table,
        f"{tmp_path}/checkpoint",
        interval="0 seconds",
    )
    try:
        query.processAllAvailable()
        assert table.current(spark).count() == 0
        named.coalesce(1).write.mode("append").parquet(folder)
        add_rows(log_of(FAULT, FAULT), tmp_path / "log", 1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert [(r.optName, r.cnt) for r in table.current(spark).collect()] == [("one", 2)]


def test_a_grown_dictionary_is_merged_without_losing_a_count(
    spark, tmp_path, log_of, dictionary_of, monkeypatch
):
    from hearthlog.streaming import daily_counts as job

    sizes = iter([True, True, False])
    monkeypatch.setattr(job, "fits_broadcast", lambda known, limit: next(sizes))
    dictionary = dictionary_of(("T", "P1", "E1", "one"))
    for part in range(12):
        add_rows(log_of(FAULT), tmp_path / "log", part)
    queries = []

    def begin(broadcast):
        queries.append(broadcast)
        return start(spark, tmp_path, dictionary, broadcast=broadcast)[0]

    job.keep_counting(begin)
    # Measured at the start, before batch 0, and before batch 10, which finds it grown.
    assert queries == [None, False]
    rows = ChangeTable(f"{tmp_path}/table").current(spark).collect()
    assert [(r.optName, r.cnt) for r in rows] == [("one", 12)]


def test_a_query_beside_that_fails_ends_the_job(spark, tmp_path, log_of, dictionary_of):
    from hearthlog.streaming.daily_counts import keep_counting

    add_rows(log_of(FAULT), tmp_path / "log", 0)
    failing = (
        stream_of(spark, tmp_path)
        .withColumn("x", F.raise_error(F.lit("quarantine is lost")))
        .writeStream.format("noop")
        .option("checkpointLocation", f"{tmp_path}/beside")
        .start()
    )
    main = []

    def begin(broadcast):
        table = ChangeTable(f"{tmp_path}/table", partial=True)
        main.append(
            start_partial_counts(
                stream_of(spark, tmp_path), dictionary_of(("T", "P1", "E1", "one")), table,
                f"{tmp_path}/checkpoint", interval="0 seconds",
            )
        )
        return main[0]

    with pytest.raises(StreamingQueryException, match="quarantine is lost"):
        keep_counting(begin, [failing])
    assert not main[0].isActive


@pytest.mark.parametrize("ttl_ms, expected", [(3_600_001, 3), (3_600_000, 1), (None, 3)])
def test_idle_counts_expire(spark, tmp_path, log_of, dictionary_of, ttl_ms, expected):
    add_rows(log_of(FAULT, FAULT), tmp_path / "log", 0)
    add_rows(log_of(FAULT), tmp_path / "log", 1)
    table = ChangeTable(f"{tmp_path}/table", partial=True, ttl_ms=ttl_ms)
    run(
        start_partial_counts(
            stream_of(spark, tmp_path), dictionary_of(("T", "P1", "E1", "one")), table,
            f"{tmp_path}/checkpoint", until_caught_up=True, clock=lambda batch: 3600.0 * batch,
        )
    )
    assert [r.cnt for r in table.current(spark).collect()] == [expected]
    plan = table.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_read_gives_counts_and_what_goes_aside(spark, tmp_path, log_of, dictionary_of):
    late = {**MODE, "gmtCreate": 1667491200000000}
    log = log_of(MODE, FAULT, late, {**MODE, "iotId": None}, {"eventName": "Temp", "iotId": None})
    messages = log.select(F.to_json(F.struct(*DEVICE_LOG.names)).alias("value"))
    bad = spark.createDataFrame([("{oops",)], "value string")
    messages.unionAll(bad).coalesce(1).write.text(f"{tmp_path}/log/part=0")
    messages.coalesce(1).write.text(f"{tmp_path}/log/part=1")
    aside = Aside(f"{tmp_path}/unstorable", f"{tmp_path}/bad")
    sink = FailsOnce(ChangeTable(f"{tmp_path}/table", partial=True))
    sink.failed = True
    decoded = read_files(
        spark, f"{tmp_path}/log/*", "json", max_files_per_trigger=1, quarantine=True
    )
    query = start_partial_counts(
        decoded, dictionary_of(("T", "P1", "E1", "one")), sink, f"{tmp_path}/checkpoint",
        until_caught_up=True, aside=aside,
    )
    run(query)
    assert sum(p.numInputRows for p in query.recentProgress) == 11
    assert sorted(r.cnt for r in sink.table.current(spark).collect()) == [2, 2]
    kept = spark.read.json(f"{tmp_path}/unstorable").collect()
    assert sorted((r.batch_id, r.gmtCreate) for r in kept) == [
        (batch, ms) for batch in (0, 1) for ms in (1667491200000, 1667491200000000)
    ]
    assert [r.value for r in spark.read.text(f"{tmp_path}/bad").collect()] == ["{oops"]
    # A replayed batch replaces what it had set aside.
    aside.write(decoded_rows(spark, tmp_path, 1), 1)
    assert spark.read.json(f"{tmp_path}/unstorable").count() == 4


def decoded_rows(spark, tmp_path, part):
    return read_files(
        spark, f"{tmp_path}/log/part={part}", "json", streaming=False, quarantine=True
    )


class Collects:
    """A sink that keeps what it is given."""

    keyed, settles = True, False

    def __init__(self):
        self.batches = {}

    def write(self, counts, batch_id):
        self.batches[batch_id] = sorted((r.iotId, r.optId, r.cnt) for r in counts.collect())


def test_another_sink_gets_the_totals_that_changed(spark, tmp_path, log_of, dictionary_of):
    other = {**MODE, "iotId": "iot2"}
    for part, rows in enumerate([(MODE, other), (MODE, MODE), (other, FAULT), (MODE,)]):
        add_rows(log_of(*rows), tmp_path / "log", part)
    sink = Collects()
    table = ChangeTable(f"{tmp_path}/table", partial=True, epoch_batches=2)
    run(
        start_partial_counts(
            stream_of(spark, tmp_path), dictionary_of(("T", "P1", "E1", "one")), table,
            f"{tmp_path}/checkpoint", until_caught_up=True, forward=sink,
            after_batch=lambda batch: table.close_epochs(spark) if batch == 2 else None,
        )
    )
    assert sink.batches == {
        0: [("iot1", "1", 1), ("iot2", "1", 1)],
        1: [("iot1", "1", 3)],
        2: [("iot1", "E1", 1), ("iot2", "1", 2)],
        3: [("iot1", "1", 4)],
    }
    changes = table.changes(spark, 3).collect()
    assert sorted((r.kind, r.cnt) for r in changes) == [("+U", 4), ("-U", 3)]


def test_offsets_are_handed_over(spark, tmp_path, log_of, dictionary_of):
    """A job that begins at the exported offsets counts what the first one has not."""
    from steps_source import StepsSource

    spark.dataSource.register(StepsSource)
    assert exported_offsets(spark, f"{tmp_path}/offsets") is None

    def source(until, **options):
        return spark.readStream.format("steps").option("until", until).options(**options).load()

    export = OffsetExport(spark, f"{tmp_path}/offsets")
    spark.streams.addListener(export)
    try:
        for until in (30, 70):
            query = (
                source(until).writeStream.format("parquet").option("path", f"{tmp_path}/first")
                .option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
            )
            export.follow(query)
            run(query)
        deadline = time.time() + 30
        while exported_offsets(spark, f"{tmp_path}/offsets") != '{"steps": {"0": 70}}':
            assert time.time() < deadline, exported_offsets(spark, f"{tmp_path}/offsets")
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(export)
    begin = exported_offsets(spark, f"{tmp_path}/offsets")
    run(
        source(100, startingOffsets=begin).writeStream.format("parquet")
        .option("path", f"{tmp_path}/second").option("checkpointLocation", f"{tmp_path}/c2")
        .trigger(availableNow=True).start()
    )
    first = {r.number for r in spark.read.parquet(f"{tmp_path}/first").collect()}
    second = {r.number for r in spark.read.parquet(f"{tmp_path}/second").collect()}
    assert first == set(range(70)) and second == set(range(70, 100))


def test_totals_go_on_with_other_partitions(spark, tmp_path, log_of, dictionary_of, rocksdb):
    """4 state partitions, then 8, without losing a count."""
    dictionary = dictionary_of(("T", "P1", "E1", "one"))
    devices = [{**MODE, "iotId": f"iot{i}"} for i in range(20)]
    add_rows(log_of(*devices, *devices, FAULT), tmp_path / "a" / "log", 0)
    add_rows(log_of(*devices[:5], {**MODE, "iotId": "new"}), tmp_path / "b" / "log", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        run(start(spark, tmp_path / "a", dictionary)[0])
        retained_counts(spark, f"{tmp_path}/a/checkpoint").write.parquet(f"{tmp_path}/base")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        base = spark.read.parquet(f"{tmp_path}/base")
        query, table = start(spark, tmp_path / "b", dictionary, base=base)
        run(query)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    states = [p.stateOperators[0].numShufflePartitions for p in query.recentProgress]
    assert states and set(states) == {8}
    assert base.groupBy().sum("cnt").first()[0] == 41
    changed = {r.iotId: r.cnt for r in table.current(spark).collect()}
    assert changed == {**{f"iot{i}": 3 for i in range(5)}, "new": 1}


def test_state_of_another_query_is_not_taken_for_counts(spark, tmp_path, log_of, rocksdb):
    add_rows(log_of(MODE), tmp_path / "log", 0)
    run(
        stream_of(spark, tmp_path).groupBy("iotId").count().writeStream.format("noop")
        .outputMode("update").option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True).start()
    )
    with pytest.raises(ValueError, match="does not hold the state of daily counts"):
        retained_counts(spark, f"{tmp_path}/c")
