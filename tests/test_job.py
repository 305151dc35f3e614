from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hearthlog import __main__ as job
from hearthlog.__main__ import _device_log, _sink, main, parser
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.plans.views import working_mode_events
from hearthlog.schemas import DAILY_COUNT, DEVICE_LOG
from hearthlog.sinks.analytic_table import AnalyticTable
from hearthlog.sinks.change_table import ChangeTable
from hearthlog.sinks.jdbc_upsert import JdbcUpsert
from hearthlog.sources.device_log import read_files
from hearthlog.streaming.daily_counts import start_console


@pytest.fixture
def inputs(tmp_path, log_of, dictionary_of):
    mode = {"eventName": "StOvMode", "eventValue": "StOvMode:1", "gmtCreate": 1667500000000}
    fault = {"eventName": "ErrorCode", "eventValue": "ErrorCode:1", "eventOriValue": "ErrorCode:0"}
    log, dictionary = log_of(mode, mode, fault), dictionary_of(("T", "P1", "E1", "one"))
    log.select(*DEVICE_LOG.names).write.parquet(f"{tmp_path}/log")
    dictionary.write.parquet(f"{tmp_path}/dictionary")
    return log, dictionary


def arguments(tmp_path, *more):
    paths = ["--log-path", f"{tmp_path}/log", "--dictionary-path", f"{tmp_path}/dictionary"]
    return [*paths, "--checkpoint", f"{tmp_path}/checkpoint", *more]


def bag(frame):
    return sorted(map(repr, frame.select(*DAILY_COUNT.names).collect()))


@pytest.fixture
def session(spark):
    names = ["spark.sql.session.timeZone", "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name) for name in names}
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")


def test_stream_into_a_table(session, tmp_path, inputs):
    sink = ["--sink-path", f"{tmp_path}/table", "--until-caught-up", "--shuffle-partitions", "4"]
    main(arguments(tmp_path, *sink), session)
    expected = bag(daily_operation_counts(*inputs))
    assert len(expected) == 2
    table = ChangeTable(f"{tmp_path}/table", partial=True)
    assert bag(table.current(session)) == expected


def test_bad_messages_are_kept_apart(session, tmp_path, inputs):
    log, dictionary = inputs
    messages = log.select(F.to_json(F.struct(*DEVICE_LOG.names)).alias("value"))
    bad = session.createDataFrame([("{oops",), ('{"gmtCreate": "soon"}',)], "value string")
    messages.unionAll(bad).coalesce(1).write.text(f"{tmp_path}/messages")
    main(
        [
            *["--log-path", f"{tmp_path}/messages", "--log-format", "json"],
            *["--dictionary-path", f"{tmp_path}/dictionary", "--sink-path", f"{tmp_path}/table"],
            *["--checkpoint", f"{tmp_path}/checkpoint", "--until-caught-up"],
            *["--bad-messages-path", f"{tmp_path}/bad"],
        ],
        session,
    )
    counts = ChangeTable(f"{tmp_path}/table", partial=True).current(session)
    assert bag(counts) == bag(daily_operation_counts(log, dictionary))
    kept = session.read.text(f"{tmp_path}/bad").collect()
    assert sorted(r.value for r in kept) == sorted(["{oops", '{"gmtCreate": "soon"}'])


def test_an_event_without_a_day_neither_stops_the_job_nor_vanishes(
    session, tmp_path, inputs, log_of, capsys
):
    wrong = {"eventName": "StOvMode", "eventValue": "StOvMode:1", "gmtCreate": 1667500000000000}
    rows = log_of(wrong, {"eventName": "ErrorCode", "eventValue": "ErrorCode:x"})
    rows.select(*DEVICE_LOG.names).write.mode("append").parquet(f"{tmp_path}/log")
    expected = bag(daily_operation_counts(*inputs))
    main(arguments(tmp_path, "--sink-path", f"{tmp_path}/table", "--until-caught-up"), session)
    table = ChangeTable(f"{tmp_path}/table", partial=True)
    assert bag(table.current(session)) == expected
    kept = session.read.json(f"{tmp_path}/checkpoint-unstorable/events").collect()
    assert [r.gmtCreate for r in kept] == [1667500000000000]
    main(arguments(tmp_path, "--sink", "batch", "--sink-path", f"{tmp_path}/out"), session)
    assert bag(session.read.parquet(f"{tmp_path}/out")) == expected
    kept = session.read.json(f"{tmp_path}/out-unstorable").collect()
    assert [r.gmtCreate for r in kept] == [1667500000000000]
    assert "bad_error_codes: 1" in capsys.readouterr().out


def test_batch_into_files_in_another_zone(session, tmp_path, inputs):
    sink = ["--sink", "batch", "--sink-path", f"{tmp_path}/out", "--time-zone", "Asia/Shanghai"]
    main(arguments(tmp_path, *sink), session)
    written = session.read.parquet(f"{tmp_path}/out")
    assert {r.ds for r in written.collect()} == {"2022-11-04"}
    assert bag(written) == bag(daily_operation_counts(*inputs))


def test_console(session, tmp_path, inputs):
    main(arguments(tmp_path, "--sink", "console", "--until-caught-up"), session)
    for what in ("log", "faults", "modes", "recipes"):
        paths = arguments(f"{tmp_path}/{what}", "--sink", "console", "--until-caught-up")
        paths[1], paths[3] = f"{tmp_path}/log", f"{tmp_path}/dictionary"
        main([*paths, "--print", what], session)
    view = working_mode_events(read_files(session, f"{tmp_path}/log"))
    query = start_console(view, f"{tmp_path}/view-checkpoint", until_caught_up=True)
    assert query.awaitTermination(60)
    # The scan skips the file of the fault event, so not all three rows are read.
    assert sum(p.numInputRows for p in query.recentProgress) >= 2


def test_console_prints_kinds_of_change(session, tmp_path, inputs, capsys):
    arguments_ = arguments(tmp_path, "--sink", "console", "--until-caught-up")
    main(arguments_, session)
    inputs[0].select(*DEVICE_LOG.names).write.mode("append").parquet(f"{tmp_path}/log")
    main(arguments_, session)
    printed = capsys.readouterr().out
    assert printed.count("|+I ") == 2 and printed.count("|-U ") == printed.count("|+U ") == 2


def test_a_versioned_dictionary_and_exported_offsets(session, tmp_path, inputs):
    log, dictionary = inputs
    old = dictionary.withColumn("valid_from", F.lit(None).cast("timestamp"))
    new = dictionary.withColumn("fault_name", F.lit("now")).withColumn("valid_from", F.lit("2020-01-01").cast("timestamp"))
    later = dictionary.withColumn("fault_name", F.lit("later")).withColumn("valid_from", F.lit("2999-01-01").cast("timestamp"))
    old.unionByName(new).unionByName(later).write.mode("overwrite").parquet(f"{tmp_path}/dictionary")
    options = ["--sink-path", f"{tmp_path}/table", "--dictionary-versioned", "--until-caught-up"]
    main(arguments(tmp_path, *options, "--export-offsets", f"{tmp_path}/offsets"), session)
    table = ChangeTable(f"{tmp_path}/table", partial=True)
    names = {r.optName for r in table.current(session).where("eventName = 'ErrorCode'").collect()}
    assert names == {"now"}
    main(arguments(tmp_path, "--sink-path", f"{tmp_path}/table", "--close-epochs"), session)


def test_totals_in_state_go_on_in_another_job(session, tmp_path, inputs, monkeypatch):
    """Exported from a job with 4 state partitions, gone on with by one with 8."""
    monkeypatch.setattr(job, "_sink", lambda args: ChangeTable(f"{args.checkpoint}-table"))
    database = ["--sink", "jdbc", "--sink-url", "u", "--sink-table", "t", "--staging-table", "s"]
    sink = [*database, "--keep-state", "--until-caught-up"]
    main(arguments(tmp_path, *sink, "--shuffle-partitions", "4"), session)
    main(arguments(tmp_path, *sink, "--export-totals", f"{tmp_path}/totals"), session)
    assert bag(session.read.parquet(f"{tmp_path}/totals")) == bag(daily_operation_counts(*inputs))
    again = arguments(tmp_path, *sink, "--shuffle-partitions", "8", "--base-totals", f"{tmp_path}/totals")
    again[again.index("--checkpoint") + 1] = f"{tmp_path}/second"
    main(again, session)
    log, dictionary = inputs
    expected = bag(daily_operation_counts(log.unionAll(log), dictionary))
    assert bag(ChangeTable(f"{tmp_path}/second-table").current(session)) == expected


def test_sinks_take_their_secrets_from_files(tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"user": "u", "password": "w"}))
    database = ["--sink-url", "jdbc:x", "--sink-table", "t", "--staging-table", "s"]
    secrets = ["--sink-properties", str(tmp_path / "p.json")]
    args = parser().parse_args(["--sink", "jdbc", *database, *secrets])
    assert _sink(args) == JdbcUpsert(
        "jdbc:x", "t", "s", properties={"user": "u", "password": "w"}, connections=16
    )
    args = parser().parse_args(["--sink", "analytic", *database, *secrets])
    assert _sink(args) == AnalyticTable(
        "jdbc", {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "w"}
    )


def test_kafka_needs_its_connector(spark):
    args = parser().parse_args(["--kafka-servers", "h:1", "--kafka-topic", "log"])
    with pytest.raises(Exception, match="(?i)kafka"):
        _device_log(spark, args)


@pytest.mark.parametrize(
    "argv",
    [
        ["--dictionary-path", "d", "--checkpoint", "c"],
        ["--log-path", "l", "--kafka-servers", "h", "--dictionary-path", "d", "--checkpoint", "c"],
        ["--log-path", "l", "--checkpoint", "c"],
        ["--log-path", "l", "--dictionary-path", "d"],
        ["--log-path", "l", "--dictionary-path", "d", "--sink", "batch", "--ttl-hours", "1"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c"],
        ["--log-path", "l", "--dictionary-path", "d", "--sink", "batch"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c", "--sink", "jdbc",
         "--sink-url", "u", "--sink-table", "t"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c", "--sink", "analytic",
         "--sink-url", "u"],
        ["--kafka-servers", "h", "--dictionary-path", "d", "--checkpoint", "c", "--sink-path", "p"],
        ["--log-path", "l", "--dictionary-url", "d", "--checkpoint", "c", "--sink-path", "p"],
        ["--kafka-servers", "h", "--kafka-topic", "t", "--dictionary-path", "d", "--sink", "batch",
         "--sink-path", "p", "--starting-offsets", "latest"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c", "--sink", "console",
         "--keep-state"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c", "--sink-path", "p",
         "--base-totals", "b"],
        ["--log-path", "l", "--dictionary-path", "d", "--checkpoint", "c", "--sink-path", "p",
         "--starting-offsets", "earliest", "--starting-offsets-from", "o"],
    ],
)
def test_incomplete_arguments(argv):
    with pytest.raises(SystemExit):
        main(argv)
