"""Run the job: ``spark-submit ... -m hearthlog`` or ``python -m hearthlog --help``.

Source, dictionary, sink and checkpoint are all arguments, so that a trial run cannot
write where the real one does. Database users and passwords come from JSON files of JDBC
properties, never from the command line.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthlog.config import configure_session
from hearthlog.operators.unstorable import (
    is_counted,
    is_storable,
    storable_events,
    unstorable_events,
)
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.plans.views import fault_events, recipe_events, working_mode_events
from hearthlog.schemas import STORED
from hearthlog.sinks.analytic_table import AnalyticTable
from hearthlog.sinks.batch_writer import CountSink
from hearthlog.sinks.change_table import INSERT, ChangeTable
from hearthlog.sinks.jdbc_upsert import JdbcUpsert
from hearthlog.sources.device_log import good_rows, kafka_options, read_files, read_kafka
from hearthlog.sources.fault_dictionary import (
    dictionary_at,
    read_dictionary_files,
    read_jdbc_dictionary,
)
from hearthlog.streaming.daily_counts import (
    configure_streaming,
    keep_counting,
    start_bad_messages,
    start_console,
    start_daily_counts,
    start_unstorable,
)
from hearthlog.streaming.offsets import OffsetExport, exported_offsets
from hearthlog.streaming.partial_counts import Aside, Dictionary, start_partial_counts
from hearthlog.streaming.retained import retained_counts


_VIEWS = ["faults", "modes", "recipes"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hearthlog", description="Count device operations per day.")
    log = p.add_argument_group("device log: Kafka or files")
    log.add_argument("--kafka-servers")
    log.add_argument("--kafka-topic")
    log.add_argument("--kafka-group")
    log.add_argument(
        "--starting-offsets", help="earliest, latest or JSON; a batch begins at earliest"
    )
    log.add_argument("--ending-offsets", help="batch: latest (the default) or JSON")
    log.add_argument("--max-offsets-per-trigger", type=int)
    log.add_argument("--min-partitions", type=int, help="read with more tasks than partitions")
    log.add_argument("--log-path")
    log.add_argument("--log-format", default="parquet", choices=["parquet", "orc", "json"])
    log.add_argument(
        "--bad-messages-path", help="keep undecodable JSON messages here instead of failing"
    )
    dictionary = p.add_argument_group("fault dictionary: files or a database table")
    dictionary.add_argument("--dictionary-path")
    dictionary.add_argument(
        "--dictionary-fresh",
        action="store_true",
        help="list the files again per micro-batch",
    )
    dictionary.add_argument("--dictionary-url")
    dictionary.add_argument("--dictionary-table")
    dictionary.add_argument("--dictionary-properties", help="JSON file of JDBC properties")
    dictionary.add_argument(
        "--dictionary-partitions", type=int, default=8, help="connections that read the table"
    )
    dictionary.add_argument(
        "--dictionary-versioned",
        action="store_true",
        help="entries have a column valid_from: each batch looks up in those of its time",
    )
    sink = p.add_argument_group("sink")
    sink.add_argument(
        "--sink", default="table", choices=["table", "jdbc", "analytic", "console", "batch"]
    )
    sink.add_argument("--sink-path", help="table and batch: folder to write")
    sink.add_argument(
        "--counts-path",
        help="jdbc, analytic, console: where the counts of batches are kept "
        "(default: beside the checkpoint)",
    )
    sink.add_argument(
        "--keep-state",
        action="store_true",
        help="jdbc, analytic: keep running totals in state, for good, instead of in files",
    )
    sink.add_argument(
        "--print",
        default="counts",
        choices=["counts", "log", *_VIEWS],
        help="console: what to print",
    )
    sink.add_argument("--print-rows", type=int, default=1000, help="console: counts per batch")
    sink.add_argument("--sink-url")
    sink.add_argument("--sink-table")
    sink.add_argument("--staging-table")
    sink.add_argument("--dialect", default="mysql", choices=["mysql", "postgresql", "ansi"])
    sink.add_argument("--sink-properties", help="JSON file of JDBC properties")
    sink.add_argument("--sink-connections", type=int, default=16, help="jdbc: at most so many")
    job = p.add_argument_group("job")
    job.add_argument("--checkpoint")
    job.add_argument("--interval", default="60 seconds")
    job.add_argument("--until-caught-up", action="store_true")
    job.add_argument("--time-zone", default="UTC", help="where a day begins and ends")
    job.add_argument("--null-keys", default="drop", choices=["fail", "drop"])
    job.add_argument(
        "--unstorable-path",
        help="where events without a device or a day are kept "
        "(default: beside the checkpoint, or beside the folder a batch writes)",
    )
    job.add_argument("--shuffle-partitions", type=int, help="also the state's; fixed once started")
    job.add_argument("--ttl-hours", type=float, help="forget counts idle for so long")
    job.add_argument("--export-offsets", help="where the source's offsets are written per batch")
    job.add_argument("--starting-offsets-from", help="begin where another job's export ends")
    job.add_argument(
        "--export-totals", help="only write the running totals in the checkpoint's state here"
    )
    job.add_argument(
        "--base-totals", help="with --keep-state: go on with the totals another job exported"
    )
    job.add_argument(
        "--close-epochs", action="store_true", help="only group old batches of the stored counts"
    )
    return p


def _properties(path: str | None) -> dict[str, str]:
    if not path:
        return {}
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _device_log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    streaming = args.sink != "batch"
    decode = {"quarantine": True} if args.bad_messages_path else {}
    if args.kafka_servers:
        options = kafka_options(
            args.kafka_servers,
            args.kafka_topic,
            _starting_offsets(spark, args) or ("latest" if streaming else "earliest"),
            args.kafka_group,
            args.max_offsets_per_trigger,
            args.min_partitions,
            None if streaming else args.ending_offsets,
        )
        return read_kafka(spark, options, streaming, **decode)
    return read_files(spark, args.log_path, args.log_format, streaming, **decode)


def _starting_offsets(spark: SparkSession, args: argparse.Namespace) -> str | None:
    if not args.starting_offsets_from:
        return args.starting_offsets
    offsets = exported_offsets(spark, args.starting_offsets_from)
    if offsets is None:
        raise ValueError(f"no offsets were exported to {args.starting_offsets_from}")
    return offsets


def _dictionary(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.dictionary_url:
        return read_jdbc_dictionary(
            spark,
            args.dictionary_url,
            args.dictionary_table,
            _properties(args.dictionary_properties),
            args.dictionary_versioned,
            args.dictionary_partitions,
        )
    return read_dictionary_files(spark, args.dictionary_path, versioned=args.dictionary_versioned)


def _dictionary_per_batch(spark: SparkSession, args: argparse.Namespace) -> Dictionary:
    """What a micro-batch looks faults up in: a table is asked again, files if wanted so."""
    again = args.dictionary_fresh or args.dictionary_url
    once = None if again else _dictionary(spark, args)

    def read(at: float) -> DataFrame:
        found = _dictionary(spark, args) if again else once
        return dictionary_at(found, at) if args.dictionary_versioned else found

    return read


def _table(args: argparse.Namespace) -> ChangeTable:
    """Where the counts of batches are kept."""
    path = args.sink_path if args.sink == "table" else args.counts_path
    ttl_ms = round(args.ttl_hours * 3_600_000) if args.ttl_hours else None
    return ChangeTable(path or f"{args.checkpoint}-counts", partial=True, ttl_ms=ttl_ms)


def _sink(args: argparse.Namespace) -> CountSink:
    properties = _properties(args.sink_properties)
    if args.sink == "jdbc":
        return JdbcUpsert(
            args.sink_url,
            args.sink_table,
            args.staging_table,
            args.dialect,
            properties,
            args.sink_connections,
        )
    return AnalyticTable("jdbc", {"url": args.sink_url, "dbtable": args.sink_table, **properties})


#: What each sink needs beside the arguments that every job needs.
_NEEDED = {
    "table": ["sink_path", "checkpoint"],
    "batch": ["sink_path"],
    "jdbc": ["sink_url", "sink_table", "staging_table", "checkpoint"],
    "analytic": ["sink_url", "sink_table", "checkpoint"],
    "console": ["checkpoint"],
}


def _check(p: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    if bool(args.kafka_servers) == bool(args.log_path):
        p.error("give either --kafka-servers or --log-path")
    if args.kafka_servers and not args.kafka_topic:
        p.error("--kafka-servers needs --kafka-topic")
    if bool(args.dictionary_url) == bool(args.dictionary_path):
        p.error("give either --dictionary-url or --dictionary-path")
    if args.dictionary_url and not args.dictionary_table:
        p.error("--dictionary-url needs --dictionary-table")
    for name in _NEEDED[args.sink]:
        if not getattr(args, name):
            p.error(f"--sink {args.sink} needs --{name.replace('_', '-')}")
    if args.bad_messages_path and (
        args.sink == "batch" or not (args.kafka_servers or args.log_format == "json")
    ):
        p.error("--bad-messages-path works with a stream of JSON messages only")
    if args.keep_state and (args.sink not in ("jdbc", "analytic") or args.ttl_hours):
        p.error("--keep-state works with --sink jdbc or analytic without --ttl-hours only")
    if args.keep_state and (args.dictionary_fresh or args.dictionary_versioned):
        p.error("a dictionary that changes needs counts in files, not --keep-state")
    if args.base_totals and not args.keep_state:
        p.error("--base-totals works with --keep-state only")
    if args.sink == "batch" and (args.ttl_hours or args.dictionary_versioned):
        p.error("--ttl-hours and --dictionary-versioned work with micro-batches only")
    if args.starting_offsets and args.starting_offsets_from:
        p.error("give either --starting-offsets or --starting-offsets-from")
    if args.sink == "batch" and args.starting_offsets == "latest":
        p.error("a batch cannot begin at the latest offsets")


def _batch(log: DataFrame, dictionary: DataFrame, args: argparse.Namespace) -> None:
    parsed, lost = Observation(), Observation()
    counted = log.where(is_counted()).observe(
        lost, F.count_if(~is_storable()).alias("unstorable_events")
    )
    counts = daily_operation_counts(storable_events(counted), dictionary, observation=parsed)
    counts.write.parquet(args.sink_path)
    if lost.get["unstorable_events"]:
        # Only a log that has such events is read again for them.
        aside = args.unstorable_path or f"{args.sink_path.rstrip('/')}-unstorable"
        unstorable_events(log).write.json(aside)
    print(f"bad_error_codes: {parsed.get['bad_error_codes']}")


def _printed_view(log: DataFrame, dictionary: DataFrame, what: str) -> DataFrame:
    """A log or view with the kind of its changes: rows are only ever added."""
    views = {
        "log": lambda: log,
        "faults": lambda: fault_events(log, dictionary),
        "modes": lambda: working_mode_events(log),
        "recipes": lambda: recipe_events(log),
    }
    return views[what]().select(F.lit(INSERT).alias("kind"), "*")


def _keep_state(
    spark: SparkSession, log: DataFrame, args: argparse.Namespace, timing: dict
) -> None:
    """Running totals in state. What is kept aside takes queries of its own."""
    beside = []
    if args.bad_messages_path:
        checkpoint = f"{args.checkpoint}-bad-messages"
        beside.append(
            start_bad_messages(log, args.bad_messages_path, checkpoint, args.until_caught_up)
        )
        log = good_rows(log)
    aside = args.unstorable_path or f"{args.checkpoint}-unstorable/events"
    beside.append(start_unstorable(log, aside, f"{args.checkpoint}-unstorable/checkpoint", **timing))
    dictionary = _dictionary(spark, args)
    base = spark.read.schema(STORED).parquet(args.base_totals) if args.base_totals else None

    def start(broadcast: bool | None) -> StreamingQuery:
        return start_daily_counts(
            log,
            dictionary,
            _sink(args),
            args.checkpoint,
            null_keys=args.null_keys,
            broadcast=broadcast,
            base=base,
            **timing,
        )

    keep_counting(start, beside)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    _check(p, args)
    spark = spark or SparkSession.builder.appName("hearthlog").getOrCreate()
    configure_session(spark, args.time_zone)
    if args.export_totals:
        retained_counts(spark, args.checkpoint).write.parquet(args.export_totals)
        return
    if args.close_epochs:
        print(f"closed epochs: {_table(args).close_epochs(spark)}")
        return
    log = _device_log(spark, args)
    if args.sink == "batch":
        _batch(log, _dictionary(spark, args), args)
        return
    configure_streaming(spark, args.shuffle_partitions)
    timing = {"interval": args.interval, "until_caught_up": args.until_caught_up}
    export = OffsetExport(spark, args.export_offsets) if args.export_offsets else None
    if export:
        spark.streams.addListener(export)
    try:
        if args.sink == "console" and args.print != "counts":
            frame = _printed_view(log, _dictionary(spark, args), args.print)
            keep_counting(lambda _: start_console(frame, args.checkpoint, **timing))
        elif args.keep_state:
            _keep_state(spark, log, args, timing)
        else:
            _count(spark, log, args, timing)
    finally:
        if export:
            spark.streams.removeListener(export)


def _count(spark: SparkSession, log: DataFrame, args: argparse.Namespace, timing: dict) -> None:
    """Counts without state: the source is read once, whatever is written."""
    table = _table(args)
    stored = args.sink != "console"
    aside = Aside(
        unstorable=args.unstorable_path or f"{args.checkpoint}-unstorable/events",
        bad_messages=args.bad_messages_path,
    )

    def show(batch_id: int) -> None:
        changes = table.changes(spark, batch_id)
        changes.orderBy("ds", "iotId", "eventName", "optId").show(args.print_rows, truncate=False)

    keep_counting(
        lambda _: start_partial_counts(
            log,
            _dictionary_per_batch(spark, args),
            table,
            args.checkpoint,
            null_keys=args.null_keys,
            forward=_sink(args) if args.sink in ("jdbc", "analytic") else None,
            aside=aside,
            **({} if stored else {"after_batch": show}),
            **timing,
        )
    )


if __name__ == "__main__":
    main()
