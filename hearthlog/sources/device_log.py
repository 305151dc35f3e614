"""The device log: Kafka, files, and decoding of its JSON messages."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hearthlog.functions.event_time import event_time
from hearthlog.schemas import DEVICE_LOG

#: Every field as text. A number may come quoted, and a nested value keeps its JSON.
_MESSAGE = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in DEVICE_LOG]
    + [T.StructField("_corrupt", T.StringType())]
)

Offsets = str | Mapping[str, Mapping[str, int]]


def with_event_time(log: DataFrame) -> DataFrame:
    return log.withColumn("ts_ltz", event_time(F.col("gmtCreate")))


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: Offsets = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    ending_offsets: Offsets | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``min_partitions`` reads a topic with more tasks than it has partitions. A batch
    starts at ``earliest`` or given offsets and may end at ``ending_offsets``.

    A running query resumes from its checkpoint. ``starting_offsets`` matters for its
    first start only: ``earliest``, ``latest``, or ``{topic: {partition: offset}}``,
    which takes over the committed offsets of a consumer group.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": _offsets(starting_offsets),
    }
    if ending_offsets is not None:
        options["endingOffsets"] = _offsets(ending_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _offsets(given: Offsets) -> str:
    return given if isinstance(given, str) else json.dumps({t: dict(o) for t, o in given.items()})


def read_kafka(
    spark: SparkSession, options: Mapping[str, str], streaming: bool = True, **decode
) -> DataFrame:
    """Device log from Kafka. Spark's Kafka connector must be on the class path."""
    reader = spark.readStream if streaming else spark.read
    messages = reader.format("kafka").options(**options).load()
    return decode_json(messages.select(F.col("value").cast("string")), **decode)


def read_files(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    **decode,
) -> DataFrame:
    """Device log from files: parquet or orc rows, or ``json`` messages one per line."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "json":
        return decode_json(reader.format("text").load(path), **decode)
    return with_event_time(reader.schema(DEVICE_LOG).format(file_format).load(path))


def decode_json(
    messages: DataFrame, value: str = "value", quarantine: bool = False
) -> DataFrame:
    """Decode JSON messages to log rows; a missing field is NULL.

    A message that cannot be decoded fails the job, or with ``quarantine`` becomes a
    row whose ``bad_message`` holds its text, to be split off with ``good_rows`` and
    ``bad_messages``.

    The fields come out of a generator (``inline``), which no filter passes. A later
    filter on the event's name would otherwise be moved below the decoding: it would
    parse every message a second time and drop the bad ones before they are noticed.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
        "allowSingleQuotes": "false",
    }
    parsed = messages.select(
        F.col(value).alias("_text"), F.from_json(value, _MESSAGE, options).alias("_message")
    )
    message = F.col("_message")
    written = message["gmtCreate"]
    is_bad = message["_corrupt"].isNotNull() | (
        written.isNotNull() & _epoch_ms(written).isNull()
    )
    if not quarantine:
        error = F.concat(F.lit("undecodable device log message: "), F.col("_text"))
        message = F.when(is_bad, F.raise_error(error)).otherwise(message)
    bad_message = F.when(is_bad, F.col("_text")).alias("bad_message")
    fields = [
        _epoch_ms(F.col(f.name)).alias(f.name) if f.name == "gmtCreate" else F.col(f.name)
        for f in DEVICE_LOG
    ]
    return with_event_time(
        parsed.select(*([bad_message] if quarantine else []), F.inline(F.array(message))).select(
            *fields, *(["bad_message"] if quarantine else [])
        )
    )


def _epoch_ms(text: Column) -> Column:
    """A whole number, also as ``1.6e12`` or ``5.0``; NULL for anything else."""
    number = F.trim(text)
    exact = number.try_cast("decimal(38,6)")
    whole = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
    return F.coalesce(number.try_cast("bigint"), whole)


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("bad_message").isNull()).drop("bad_message")


def bad_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("bad_message").isNotNull()).select("bad_message")
