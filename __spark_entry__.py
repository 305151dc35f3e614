"""

Every query maps the ``events`` table to a device log (``hearthlog.fixtures``) and runs
over all of it. ``oracle_sql`` states the same mapping and the same result for DuckDB,
written independently of the Spark code.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hearthlog import fixtures  # noqa: E402
from hearthlog.config import configure_session, shared_dir  # noqa: E402
from hearthlog.functions.event_time import day, day_label  # noqa: E402
from hearthlog.functions.payload import payload_map, payload_value  # noqa: E402
from hearthlog.operators.counts import (  # noqa: E402
    count_by_day,
    last_write_per_key,
    sink_key_collisions,
)
from hearthlog.operators.fault_lookup import lookup_faults, lookup_faults_as_of  # noqa: E402
from hearthlog.operators.newly_raised import is_bad_code, newly_raised_faults  # noqa: E402
from hearthlog.operators.unstorable import storable_events, unstorable_events  # noqa: E402
from hearthlog.plans import sql_views, views  # noqa: E402
from hearthlog.plans.daily_counts import (  # noqa: E402
    daily_operation_counts,
    daily_operation_counts_union,
)
from hearthlog.schemas import (  # noqa: E402
    DAILY_COUNT,
    DEVICE_LOG,
    ERROR_CODE,
    MODE,
    RECIPE,
    STORED,
)
from hearthlog.sinks.analytic_table import analytic_rows  # noqa: E402
from hearthlog.sinks.change_table import UPDATE_BEFORE, ChangeTable  # noqa: E402
from hearthlog.sources.device_log import decode_json, read_files  # noqa: E402
from hearthlog.sources.fault_dictionary import dictionary_at  # noqa: E402
from hearthlog.streaming.daily_counts import (  # noqa: E402
    configure_streaming,
    start_daily_counts,
)
from hearthlog.streaming.partial_counts import Aside, start_partial_counts  # noqa: E402
from hearthlog.streaming.retained import retained_counts  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _log(spark: SparkSession, sf_dir: str, renamed: bool = False) -> DataFrame:
    configure_session(spark)
    events = spark.read.schema(fixtures.EVENTS).parquet(f"{sf_dir}/events.parquet")
    return fixtures.device_log(events, renamed)


def _edge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_session(spark)
    return fixtures.edge_log(spark.read.schema(fixtures.EVENTS).parquet(f"{sf_dir}/events.parquet"))


def _duplicated(dictionary: DataFrame) -> DataFrame:
    """The dictionary with a second row for every fault with an even number."""
    number = F.substring("fault_code", 2, 2).cast("int")
    return dictionary.unionByName(dictionary.where(number % 2 == 0))


def _with_ms(operations: DataFrame) -> DataFrame:
    """Event time as epoch milliseconds, which both engines write alike."""
    return operations.withColumn("ts_ms", F.unix_millis("ts_ltz")).drop("ts_ltz")


def entry(spark: SparkSession) -> DataFrame:
    return _daily(spark, SMOKE_DIR)


def _payload(read: Callable, log: Callable = _log) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        value, previous = F.col("eventValue"), F.col("eventOriValue")
        return log(spark, sf_dir).select(
            "requestId",
            read(value, ERROR_CODE).alias("error_code"),
            read(previous, ERROR_CODE).alias("previous_code"),
            read(value, MODE).alias("mode"),
            read(value, RECIPE).alias("recipe"),
        )

    return query


def _event_time_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts_ltz")
    return _log(spark, sf_dir).select(
        "requestId",
        "gmtCreate",
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
        day_label(day(ts)).alias("ds"),
    )


def _decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    messages = log.select(F.to_json(F.struct(*DEVICE_LOG.names)).alias("value"))
    return _with_ms(decode_json(messages))


def _raised(spark: SparkSession, sf_dir: str, read: Callable = _log) -> DataFrame:
    log = read(spark, sf_dir).where(F.col("eventName") == ERROR_CODE)
    codes = log.select(
        "requestId",
        "productKey",
        payload_value(F.col("eventValue"), ERROR_CODE).alias("new_code"),
        payload_value(F.col("eventOriValue"), ERROR_CODE).alias("old_code"),
    )
    return newly_raised_faults(codes, "new_code", "old_code")


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = _raised(spark, sf_dir)
    named = lookup_faults(raised, fixtures.fault_dictionary(spark))
    return named.select("requestId", "productKey", "fault_code", "fault_name")


def _bad_codes(spark: SparkSession, sf_dir: str, read: Callable = _log) -> DataFrame:
    codes = views.error_codes(read(spark, sf_dir))
    return codes.agg(F.count_if(is_bad_code("new_code", "old_code")).alias("bad_error_codes"))


def _faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ms(views.fault_events(_log(spark, sf_dir), fixtures.fault_dictionary(spark)))


def _faults_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, dictionary = _log(spark, sf_dir), fixtures.fault_dictionary(spark)
    return _with_ms(views.fault_events(log, dictionary, broadcast=False))


def _modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ms(views.working_mode_events(_log(spark, sf_dir)))


def _recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ms(views.recipe_events(_log(spark, sf_dir)))


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return _with_ms(views.operation_events(log, fixtures.fault_dictionary(spark)))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_operation_counts(_log(spark, sf_dir), fixtures.fault_dictionary(spark))


def _daily_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_operation_counts_union(_log(spark, sf_dir), fixtures.fault_dictionary(spark))


def _daily_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = fixtures.fault_dictionary(spark)
    return daily_operation_counts(_log(spark, sf_dir), dictionary, max_broadcast_bytes=0)


def _daily_duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = _duplicated(fixtures.fault_dictionary(spark))
    return daily_operation_counts(_log(spark, sf_dir), dictionary)


def _daily_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql_views.register_functions(spark)
    sql_views.register_views(spark, _log(spark, sf_dir), fixtures.fault_dictionary(spark))
    return spark.sql(sql_views.DAILY_OPERATION_COUNTS)


@contextmanager
def _streaming_settings(spark: SparkSession) -> Iterator[None]:
    """The job's state store settings, for as long as a query runs."""
    names = [
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    ]
    before = {name: spark.conf.get(name, None) for name in names}
    configure_streaming(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_session(spark)
    # A pattern, as a file stream takes folders and patterns but no single file.
    return spark.readStream.schema(fixtures.EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def _daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_stream(spark, sf_dir)
    work = shared_dir(spark, "daily-counts")
    sink = ChangeTable(f"{work}/table")
    with _streaming_settings(spark):
        query = start_daily_counts(
            fixtures.device_log(events),
            fixtures.fault_dictionary(spark),
            sink,
            f"{work}/checkpoint",
            until_caught_up=True,
        )
        query.awaitTermination()
    return sink.current(spark)


def _stateless_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_stream(spark, sf_dir)
    work = shared_dir(spark, "partial-counts")
    table = ChangeTable(f"{work}/table", partial=True)
    start_partial_counts(
        fixtures.device_log(events),
        lambda at: fixtures.fault_dictionary(spark),
        table,
        f"{work}/checkpoint",
        until_caught_up=True,
    ).awaitTermination()
    return table.current(spark)


def _last_write_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The renamed log in several micro-batches, whose groups collide across batches."""
    work = shared_dir(spark, "last-write")
    log = _log(spark, sf_dir, renamed=True).select(*DEVICE_LOG.names)
    part = F.col("requestId").cast("bigint") % 4
    log.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(f"{work}/log")
    table = ChangeTable(f"{work}/table", partial=True, epoch_batches=2)
    start_partial_counts(
        read_files(spark, f"{work}/log", max_files_per_trigger=1),
        fixtures.fault_dictionary(spark),
        table,
        f"{work}/checkpoint",
        until_caught_up=True,
    ).awaitTermination()
    table.close_epochs(spark)
    return table.settled(spark).drop("last_ts")


#: When four batches begin, in hours from the first, and how long a count may be idle.
BATCH_HOURS, TTL_HOURS = (0, 10, 40, 50), 24


def _batch_time(batch_id: int) -> float:
    """The second version of the dictionary begins between the second and the third batch."""
    return fixtures.VERSION_CUT + 3600 * (BATCH_HOURS[batch_id] - 20)


def _in_parts(
    spark: SparkSession, sf_dir: str, work: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Run a stream over a quarter of the log at a time, each of which is a micro-batch."""
    log = _log(spark, sf_dir).select(*DEVICE_LOG.names)
    for part in range(len(BATCH_HOURS)):
        rows = log.where(F.col("requestId").cast("bigint") % len(BATCH_HOURS) == part)
        rows.write.parquet(f"{work}/log/part={part}")
        start(read_files(spark, f"{work}/log/*")).awaitTermination()


def _partial_table(spark: SparkSession, sf_dir: str, dictionary=None, **options) -> ChangeTable:
    """The counts of four micro-batches, of which the first two are a closed epoch."""
    work = shared_dir(spark, "partial-counts")
    table = ChangeTable(f"{work}/table", partial=True, epoch_batches=2, **options)
    _in_parts(
        spark,
        sf_dir,
        work,
        lambda log: start_partial_counts(
            log,
            dictionary or fixtures.fault_dictionary(spark),
            table,
            f"{work}/checkpoint",
            until_caught_up=True,
            clock=_batch_time,
        ),
    )
    return table


def _expiring_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a time to live that no count outlasts."""
    table = _partial_table(spark, sf_dir, ttl_ms=51 * 3_600_000)
    table.close_epochs(spark)
    return table.current(spark)


def _ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _partial_table(spark, sf_dir, ttl_ms=TTL_HOURS * 3_600_000)
    table.close_epochs(spark)
    return table.current(spark)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partial_table(spark, sf_dir).changes(spark)


def _folded_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every group when its changes are taken back and made in turn."""
    rows = _changes(spark, sf_dir)
    signed = F.when(F.col("kind") == UPDATE_BEFORE, -F.col("cnt")).otherwise(F.col("cnt"))
    group = [name for name in DAILY_COUNT.names if name != "cnt"]
    return rows.groupBy(*group).agg(F.sum(signed).alias("cnt"))


def _versioned_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = fixtures.versioned_dictionary(spark)
    table = _partial_table(spark, sf_dir, lambda at: dictionary_at(versions, at))
    return table.groups(spark).drop("last_ts")


def _lookup_as_of(spark: SparkSession, sf_dir: str, max_broadcast_bytes: int) -> DataFrame:
    log = _log(spark, sf_dir).where(F.col("eventName") == ERROR_CODE)
    codes = log.select(
        "requestId",
        "productKey",
        "iotId",
        F.lit(None).cast("string").alias("_id"),
        "ts_ltz",
        payload_value(F.col("eventValue"), ERROR_CODE).alias("new_code"),
        payload_value(F.col("eventOriValue"), ERROR_CODE).alias("old_code"),
    )
    raised = newly_raised_faults(codes, "new_code", "old_code")
    named = lookup_faults_as_of(
        raised, fixtures.versioned_dictionary(spark), max_broadcast_bytes=max_broadcast_bytes
    )
    return named.select("requestId", "productKey", "fault_code", "fault_name")


def _routed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that a counting stream has set aside, in the one read that it makes."""
    work = shared_dir(spark, "routed")
    events = _event_stream(spark, sf_dir)
    start_partial_counts(
        fixtures.edge_log(events),
        fixtures.fault_dictionary(spark),
        ChangeTable(f"{work}/table", partial=True),
        f"{work}/checkpoint",
        until_caught_up=True,
        aside=Aside(unstorable=f"{work}/unstorable"),
    ).awaitTermination()
    kept = spark.read.schema(DEVICE_LOG).json(f"{work}/unstorable")
    return kept.select("requestId", "iotId", "gmtCreate", "eventName")


def _with_state(
    spark: SparkSession, log: DataFrame, work: str, base: DataFrame | None = None
) -> StreamingQuery:
    return start_daily_counts(
        log,
        fixtures.fault_dictionary(spark),
        ChangeTable(f"{work}/table"),
        f"{work}/checkpoint",
        until_caught_up=True,
        base=base,
    )


def _retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "retained")
    with _streaming_settings(spark):
        _in_parts(spark, sf_dir, work, lambda log: _with_state(spark, log, work))
    return retained_counts(spark, f"{work}/checkpoint").drop("last_ts")


def _rescaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with 4 state partitions, and one with 8 that goes on with its totals."""
    work = shared_dir(spark, "rescaled")
    log = _log(spark, sf_dir).select(*DEVICE_LOG.names)
    second = F.col("requestId").cast("bigint") % 2 == 1
    log.where(~second).write.parquet(f"{work}/first/log")
    log.where(second).write.parquet(f"{work}/second/log")
    partitions = "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    try:
        with _streaming_settings(spark):
            spark.conf.set(partitions, "4")
            first = f"{work}/first"
            _with_state(spark, read_files(spark, f"{first}/log"), first).awaitTermination()
            retained_counts(spark, f"{first}/checkpoint").write.parquet(f"{work}/base")
            spark.conf.set(partitions, "8")
            base = spark.read.schema(STORED).parquet(f"{work}/base")
            log = read_files(spark, f"{work}/second/log")
            _with_state(spark, log, f"{work}/second", base).awaitTermination()
    finally:
        spark.conf.set(partitions, before)
    # The first table's groups that did not change again hold what they held.
    later = ChangeTable(f"{work}/second/table").groups(spark)
    group = [name for name in DAILY_COUNT.names if name != "cnt"]
    return (
        base.unionByName(later).groupBy(*group).agg(F.max("cnt").alias("cnt"))
    )


def _renamed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir, renamed=True)
    return daily_operation_counts(log, fixtures.fault_dictionary(spark), last_event=True)


def _collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink_key_collisions(_renamed_counts(spark, sf_dir))


def _last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_write_per_key(_renamed_counts(spark, sf_dir)).drop("last_ts")


def _analytic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytic_rows(_daily(spark, sf_dir))


def _event_time_day_shanghai(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    configure_session(spark, "Asia/Shanghai")
    try:
        # The zone becomes part of the expressions here, not when they run.
        return log.select("requestId", day_label(day(F.col("ts_ltz"))).alias("ds"))
    finally:
        configure_session(spark)


def _unstorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unstorable_events(_edge_log(spark, sf_dir))
    return rows.select("requestId", "iotId", "gmtCreate", "eventName")


def _daily_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = storable_events(_edge_log(spark, sf_dir))
    return daily_operation_counts(log, fixtures.fault_dictionary(spark))


def _daily_union_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = storable_events(_edge_log(spark, sf_dir))
    return daily_operation_counts_union(log, fixtures.fault_dictionary(spark))


def _mode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_day(views.working_mode_events(_log(spark, sf_dir)))


def _llm():
    """The queries and oracles of the ``llm`` subpackage and its pipeline, if they are there."""
    try:
        import corpus_pipeline
        from hearthlog.llm import queries as llm_queries
    except ModuleNotFoundError as error:
        missing = error.name or ""
        if missing != "corpus_pipeline" and not missing.startswith("hearthlog.llm"):
            raise
        return {}, {}
    return (
        {**llm_queries.queries(), "pipeline": corpus_pipeline.run},
        {
            **llm_queries.oracle_sql(),
            **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
        },
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**core_queries(), **_llm()[0]}


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the device log, which need no subpackage."""
    return {
        "payload_map_lookup": _payload(lambda text, key: payload_map(text)[key]),
        "payload_value_lookup": _payload(payload_value),
        "event_time_day": _event_time_day,
        "decoded_messages": _decoded_messages,
        "newly_raised_faults": lambda spark, sf_dir: _raised(spark, sf_dir).select(
            "requestId", "fault_number"
        ),
        "fault_dictionary_lookup": _lookup,
        "bad_error_codes": _bad_codes,
        "fault_events": _faults,
        "fault_events_shuffled_dictionary": _faults_shuffled,
        "working_mode_events": _modes,
        "recipe_events": _recipes,
        "operation_events": _operations,
        "working_mode_counts": _mode_counts,
        "daily_operation_counts": _daily_union,
        "daily_operation_counts_single_scan": _daily,
        "daily_operation_counts_shuffled_dictionary": _daily_shuffled,
        "daily_operation_counts_duplicated_dictionary": _daily_duplicated,
        "daily_operation_counts_sql": _daily_sql,
        "daily_operation_counts_stream": _daily_stream,
        "daily_operation_counts_stateless_stream": _stateless_stream,
        "daily_operation_counts_expiring_stream": _expiring_stream,
        "daily_operation_counts_ttl_stream": _ttl_stream,
        "daily_operation_counts_changes_stream": _changes,
        "daily_operation_counts_folded_changes_stream": _folded_changes,
        "daily_operation_counts_versioned_dictionary_stream": _versioned_stream,
        "daily_operation_counts_retained_state": _retained,
        "daily_operation_counts_rescaled_stream": _rescaled,
        "unstorable_events_routed_stream": _routed_stream,
        "fault_lookup_as_of": lambda spark, sf_dir: _lookup_as_of(spark, sf_dir, 1 << 20),
        "fault_lookup_as_of_shuffled": lambda spark, sf_dir: _lookup_as_of(spark, sf_dir, 0),
        "sink_key_collisions": _collisions,
        "last_write_per_key": _last_write,
        "last_write_per_key_stream": _last_write_stream,
        "analytic_rows": _analytic_rows,
        "event_time_day_shanghai": _event_time_day_shanghai,
        "payload_value_lookup_edges": _payload(payload_value, _edge_log),
        "newly_raised_faults_edges": lambda spark, sf_dir: _raised(
            spark, sf_dir, _edge_log
        ).select("requestId", "fault_number"),
        "bad_error_codes_edges": lambda spark, sf_dir: _bad_codes(spark, sf_dir, _edge_log),
        "unstorable_events": _unstorable,
        "daily_operation_counts_edges": _daily_edges,
        "daily_operation_counts_union_edges": _daily_union_edges,
    }


def _device_log_sql(name: str) -> str:
    return f"""
device_log AS (
  SELECT
    CAST(event_id AS VARCHAR) AS "requestId",
    'iot' || user_id AS "iotId",
    'P' || (user_id % 4) AS "productKey",
    {name} AS "deviceName",
    epoch_us(ts) // 1000 AS "gmtCreate",
    CASE event_type
      WHEN 'error' THEN 'ErrorCode'
      WHEN 'view' THEN 'StOvMode'
      WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'LStOvMode' ELSE 'RStOvMode' END
      WHEN 'click' THEN 'MultiStageName'
      WHEN 'purchase' THEN 'Temp'
    END AS "eventName",
    CASE event_type
      WHEN 'error' THEN 'ErrorCode:'
        || CASE WHEN event_id % 17 = 0 THEN 'x'
                ELSE CAST((event_id * 37) % 16384 AS VARCHAR) END || ',Z:1'
      WHEN 'view' THEN 'StOvMode:' || (event_id % 4)
        || CASE event_id % 3 WHEN 0 THEN ',MultiStageName:soup'
                             WHEN 1 THEN ',MultiStageName:' ELSE '' END
      WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'LStOvMode:2' ELSE 'RStOvMode:2' END
        || CASE WHEN event_id % 5 = 0 THEN ',StOvMode:3' ELSE '' END
      WHEN 'click' THEN 'MultiStageName:'
        || CASE WHEN event_id % 4 = 0 THEN '' ELSE 'dish' || (event_id % 6) END
      WHEN 'purchase' THEN 'Temp:1'
    END AS "eventValue",
    CASE WHEN event_type = 'error' THEN 'ErrorCode:' || (event_id % 64) ELSE '' END
      AS "eventOriValue"
  FROM events
)"""


def _entry_sql(payload: str, key: str) -> str:
    """The last pair of a payload whose key is ``key``, or NULL."""
    return (
        f"list_filter(string_split({payload}, ','), "
        f"lambda pair: string_split(pair, ':')[1] = '{key}')[-1]"
    )


def _value_sql(payload: str, key: str) -> str:
    pair = _entry_sql(payload, key)
    return f"CASE WHEN contains({pair}, ':') THEN substr({pair}, {len(key) + 2}) END"


_EDGE_CODES = """(VALUES
    (0, 'ErrorCode:+5', 'ErrorCode:0'), (1, 'ErrorCode: 5 ', 'ErrorCode:0'),
    (2, 'ErrorCode:9223372036854775808', 'ErrorCode:0'),
    (3, 'ErrorCode:4611686018427387904', 'ErrorCode:0'),
    (4, 'ErrorCode:4611686018427387905', 'ErrorCode:0'),
    (5, 'ErrorCode:5', 'ErrorCode:-1'), (6, 'ErrorCode:-3', 'ErrorCode:0'),
    (7, 'ErrorCode:1,ErrorCode:6', 'ErrorCode:2,ErrorCode:4'),
    (8, 'ErrorCode:3,ErrorCode', 'ErrorCode:0'), (9, 'ErrorCode:', 'ErrorCode:0'),
    (10, 'ErrorCode:12', NULL)) AS edge_codes(code, new_value, old_value)"""

_STORABLE = """("iotId" IS NOT NULL AND "gmtCreate" IS NOT NULL
    AND "gmtCreate" BETWEEN -62135596800000 AND 253402300799999)"""


def _edge_log_sql() -> str:
    """The device log with edge rows, over the plain one (``plain_log``)."""
    return f"""
numbered AS (
  SELECT *, CAST("requestId" AS BIGINT) % 7 AS kind, CAST("requestId" AS BIGINT) // 7 AS turn
  FROM plain_log
),
device_log AS (
  SELECT "requestId",
    CASE WHEN kind = 1 AND turn % 3 = 1 THEN NULL ELSE "iotId" END AS "iotId",
    CASE WHEN kind = 1 AND turn % 3 = 0 THEN NULL ELSE "productKey" END AS "productKey",
    CASE WHEN kind = 1 AND turn % 3 = 2 THEN NULL ELSE "deviceName" END AS "deviceName",
    CASE WHEN kind = 2 AND turn % 2 = 0 THEN "gmtCreate" * 1000
         WHEN kind = 2 AND turn % 6 = 1 THEN NULL ELSE "gmtCreate" END AS "gmtCreate",
    CASE WHEN kind = 0 THEN 'ErrorCode' ELSE "eventName" END AS "eventName",
    CASE kind WHEN 0 THEN new_value
      WHEN 3 THEN "eventValue" || ',StOvMode:5,StOvMode:6,MultiStageName:'
      ELSE "eventValue" END AS "eventValue",
    CASE kind WHEN 0 THEN old_value ELSE "eventOriValue" END AS "eventOriValue"
  FROM numbered JOIN {_EDGE_CODES} ON code = turn % 11
)"""


def _oracle_ctes(
    name: str = "'d' || user_id",
    duplicated: bool = False,
    edges: bool = False,
    version: str | None = None,
) -> str:
    """The device log, the dictionary, the three kinds of operation and their union."""
    log = _device_log_sql(name)
    if edges:
        log = log.replace("device_log AS", "plain_log AS", 1) + "," + _edge_log_sql()
    again = "UNION ALL SELECT * FROM entries WHERE fault % 2 = 0" if duplicated else ""
    dictionary = "d.fault_code = 'E' || fault_number AND d.smart_product_code = \"productKey\""
    if version:
        # Whether the second version holds: it renames every third fault, ends every fourth.
        dictionary += f" AND NOT ({version} AND CAST(fault_number AS INTEGER) % 4 = 0)"
        newer = f"{version} AND CAST(fault_number AS INTEGER) % 3 = 0"
        fault_name = f"CASE WHEN {newer} THEN 'newer ' || d.fault_name ELSE d.fault_name END"
    else:
        fault_name = "d.fault_name"
    return f"""
WITH {log},
entries AS (
  SELECT p.range AS product, b.range AS fault
  FROM range(0, 4) p, range(1, 13) b
  WHERE b.range <> 3 + p.range
),
fault_dictionary AS (
  SELECT CASE WHEN fault % 5 = 0 THEN NULL ELSE 'T' END AS fault_type_code,
         'P' || product AS smart_product_code,
         'E' || fault AS fault_code,
         'fault' || fault AS fault_name
  FROM (SELECT * FROM entries {again})
),
payloads AS (
  SELECT *,
    {_value_sql('"eventValue"', 'ErrorCode')} AS error_code,
    {_value_sql('"eventOriValue"', 'ErrorCode')} AS previous_code,
    {_value_sql('"eventValue"', 'StOvMode')} AS mode,
    {_value_sql('"eventValue"', 'MultiStageName')} AS recipe
  FROM device_log
),
codes AS (
  SELECT *,
    CASE WHEN regexp_full_match(error_code, '[+-]?[0-9]+')
         THEN TRY_CAST(error_code AS BIGINT) END AS new_code,
    CASE WHEN regexp_full_match(previous_code, '[+-]?[0-9]+')
         THEN TRY_CAST(previous_code AS BIGINT) END AS old_code
  FROM payloads WHERE "eventName" = 'ErrorCode'
),
raised AS (
  SELECT codes.*, '64' AS fault_number FROM codes
  WHERE new_code > 4611686018427387904 AND old_code <= 4611686018427387904
  UNION ALL
  SELECT codes.*, CAST(bit.range + 1 AS VARCHAR) AS fault_number
  FROM codes, range(0, 63) bit
  WHERE new_code IS NOT NULL AND old_code IS NOT NULL
    AND (greatest(new_code, 0) >> bit.range) & 1 = 1
    AND (greatest(old_code, 0) >> bit.range) & 1 = 0
),
named AS (
  SELECT raised.*, d.fault_code, {fault_name} AS fault_name
  FROM raised LEFT JOIN fault_dictionary d ON {dictionary}
  WHERE d.fault_type_code IS NOT NULL
),
fault_events AS (
  SELECT "productKey", "iotId", "deviceName", "gmtCreate" AS ts_ms, 'ErrorCode' AS "eventName",
         fault_code AS "optId", fault_name AS "optName"
  FROM named
),
working_mode_events AS (
  SELECT "productKey", "iotId", "deviceName", "gmtCreate" AS ts_ms, 'StOvMode' AS "eventName",
         mode AS "optId", CAST(NULL AS VARCHAR) AS "optName"
  FROM payloads
  WHERE "eventName" IN ('StOvMode', 'LStOvMode', 'RStOvMode')
    AND mode <> '0' AND (recipe = '' OR recipe IS NULL)
),
recipe_events AS (
  SELECT "productKey", "iotId", "deviceName", "gmtCreate" AS ts_ms,
         'MultiStageName' AS "eventName", recipe AS "optId", recipe AS "optName"
  FROM payloads
  WHERE "eventName" = 'MultiStageName' AND recipe <> ''
),
operation_events AS (
  SELECT * FROM fault_events
  UNION ALL SELECT * FROM working_mode_events
  UNION ALL SELECT * FROM recipe_events
),
daily AS (
  SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS ds,
         "productKey", "iotId", "deviceName", "eventName", "optId", "optName",
         count(*) AS cnt, max(ts_ms) AS last_ms
  FROM operation_events
  {f"WHERE {_STORABLE.replace('gmtCreate', 'ts_ms')}" if edges else ""}
  GROUP BY ALL
)
"""


_DAILY_SQL = """
SELECT ds, "productKey", "iotId", "deviceName", "eventName", "optId", "optName", cnt FROM daily
"""

_GROUP = 'ds, "productKey", "iotId", "deviceName", "eventName", "optId", "optName"'

#: Every group's counts by quarter of the log, whose number is written behind the device's name.
_QUARTERS = f"""
, quarters AS (
  SELECT * REPLACE (split_part("deviceName", '#', 1) AS "deviceName"),
         CAST(split_part("deviceName", '#', 2) AS INTEGER) AS batch
  FROM daily
),
running AS (
  SELECT *, CAST(sum(cnt) OVER in_turn AS BIGINT) AS total,
         CAST(sum(cnt) OVER in_turn - cnt AS BIGINT) AS before,
         {list(BATCH_HOURS)}[batch + 1] AS hour
  FROM quarters
  WINDOW in_turn AS (PARTITION BY {_GROUP} ORDER BY batch)
)
"""

_TTL_SQL = f"""
, gaps AS (
  SELECT *, hour - lag(hour) OVER (PARTITION BY {_GROUP} ORDER BY batch) >= {TTL_HOURS} AS idle
  FROM running
),
started AS (
  SELECT *, coalesce(max(batch) FILTER (idle) OVER (PARTITION BY {_GROUP}), 0) AS since FROM gaps
)
SELECT {_GROUP}, CAST(sum(cnt) AS BIGINT) AS cnt FROM started WHERE batch >= since GROUP BY ALL
"""

_CHANGES_SQL = f"""
SELECT CAST(batch AS BIGINT) AS batch_id, '+I' AS kind, {_GROUP}, total AS cnt FROM running WHERE before = 0
UNION ALL
SELECT batch, '-U', {_GROUP}, before FROM running WHERE before > 0
UNION ALL
SELECT batch, '+U', {_GROUP}, total FROM running WHERE before > 0
"""

_PAYLOAD_SQL = 'SELECT "requestId", error_code, previous_code, mode, recipe FROM payloads'


def oracle_sql() -> dict[str, str]:
    return {**core_oracle_sql(), **_llm()[1]}


def core_oracle_sql() -> dict[str, str]:
    ctes = _oracle_ctes()
    edges = _oracle_ctes(edges=True)
    renamed = _oracle_ctes("'d' || user_id || '-' || (event_id % 2)")
    daily = ctes + _DAILY_SQL
    quarters = _oracle_ctes("'d' || user_id || '#' || (event_id % 4)")
    as_of = (
        _oracle_ctes(version=f'"gmtCreate" >= {fixtures.VERSION_CUT * 1000}')
        + 'SELECT "requestId", "productKey", fault_code, fault_name FROM named'
    )
    unstorable = (
        edges
        + f"""
SELECT "requestId", "iotId", "gmtCreate", "eventName" FROM device_log
WHERE "eventName" IN ('ErrorCode', 'StOvMode', 'LStOvMode', 'RStOvMode', 'MultiStageName')
  AND NOT {_STORABLE}"""
    )
    last_write = (
        renamed
        + """
SELECT ds, "productKey", "iotId", "deviceName", "eventName", "optId", "optName", cnt,
       count(*) OVER (PARTITION BY ds, "iotId", "eventName", "optId") - 1 AS overwritten
FROM daily
QUALIFY row_number() OVER (
  PARTITION BY ds, "iotId", "eventName", "optId"
  ORDER BY last_ms DESC, "productKey" DESC, "deviceName" DESC, "optName" DESC NULLS LAST
) = 1"""
    )
    return {
        "payload_map_lookup": ctes + _PAYLOAD_SQL,
        "payload_value_lookup": ctes + _PAYLOAD_SQL,
        "event_time_day": ctes
        + """
SELECT "requestId", "gmtCreate",
       strftime(make_timestamp("gmtCreate" * 1000), '%Y-%m-%d %H:%M:%S.%g') AS event_time,
       strftime(make_timestamp("gmtCreate" * 1000), '%Y-%m-%d') AS ds
FROM device_log""",
        "decoded_messages": ctes
        + """
SELECT CAST(NULL AS VARCHAR) AS "deviceType", "iotId", "requestId",
       CAST(NULL AS VARCHAR) AS "checkFailedData", "productKey", "gmtCreate", "deviceName",
       "eventName", "eventValue", "eventOriValue", "gmtCreate" AS ts_ms
FROM device_log""",
        "newly_raised_faults": ctes + 'SELECT "requestId", fault_number FROM raised',
        "fault_dictionary_lookup": ctes
        + 'SELECT "requestId", "productKey", fault_code, fault_name FROM named',
        "bad_error_codes": ctes
        + """
SELECT count(*) AS bad_error_codes FROM codes WHERE new_code IS NULL OR old_code IS NULL""",
        "fault_events": ctes + "SELECT * FROM fault_events",
        "fault_events_shuffled_dictionary": ctes + "SELECT * FROM fault_events",
        "working_mode_events": ctes + "SELECT * FROM working_mode_events",
        "recipe_events": ctes + "SELECT * FROM recipe_events",
        "operation_events": ctes + "SELECT * FROM operation_events",
        "working_mode_counts": daily + "WHERE \"eventName\" = 'StOvMode'",
        "daily_operation_counts": daily,
        "daily_operation_counts_single_scan": daily,
        "daily_operation_counts_shuffled_dictionary": daily,
        "daily_operation_counts_duplicated_dictionary": _oracle_ctes(duplicated=True)
        + _DAILY_SQL,
        "daily_operation_counts_sql": daily,
        "daily_operation_counts_stream": daily,
        "daily_operation_counts_stateless_stream": daily,
        "daily_operation_counts_expiring_stream": daily,
        "daily_operation_counts_ttl_stream": quarters + _QUARTERS + _TTL_SQL,
        "daily_operation_counts_changes_stream": quarters + _QUARTERS + _CHANGES_SQL,
        "daily_operation_counts_folded_changes_stream": daily,
        "daily_operation_counts_versioned_dictionary_stream": _oracle_ctes(
            version='CAST("requestId" AS BIGINT) % 4 >= 2'
        )
        + _DAILY_SQL,
        "daily_operation_counts_retained_state": daily,
        "daily_operation_counts_rescaled_stream": daily,
        "unstorable_events_routed_stream": unstorable,
        "fault_lookup_as_of": as_of,
        "fault_lookup_as_of_shuffled": as_of,
        "sink_key_collisions": renamed
        + """
SELECT ds, "iotId", "eventName", "optId", count(*) AS groups,
       CAST(sum(cnt) AS BIGINT) AS total_cnt
FROM daily GROUP BY ds, "iotId", "eventName", "optId" HAVING count(*) > 1""",
        "last_write_per_key": last_write,
        "last_write_per_key_stream": last_write,
        "analytic_rows": ctes
        + """
SELECT "productKey" AS productkey, "iotId" AS iotid, "deviceName" AS devicename,
       "eventName" AS event_name, "optId" AS opt_id, "optName" AS opt_name, cnt
FROM daily""",
        "event_time_day_shanghai": ctes
        + """
SELECT "requestId",
       strftime(make_timestamp("gmtCreate" * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d') AS ds
FROM device_log""",
        "payload_value_lookup_edges": edges + _PAYLOAD_SQL,
        "newly_raised_faults_edges": edges + 'SELECT "requestId", fault_number FROM raised',
        "bad_error_codes_edges": edges
        + """
SELECT count(*) AS bad_error_codes FROM codes WHERE new_code IS NULL OR old_code IS NULL""",
        "unstorable_events": unstorable,
        "daily_operation_counts_edges": edges + _DAILY_SQL,
        "daily_operation_counts_union_edges": edges + _DAILY_SQL,
    }
