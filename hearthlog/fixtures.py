"""The device log and fault dictionary derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthlog.functions.event_time import event_time

#: The columns of the ``events`` table that are used.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"

_EVENT_NAME = """
CASE event_type
  WHEN 'error' THEN 'ErrorCode'
  WHEN 'view' THEN 'StOvMode'
  WHEN 'signup' THEN if(event_id % 2 = 0, 'LStOvMode', 'RStOvMode')
  WHEN 'click' THEN 'MultiStageName'
  WHEN 'purchase' THEN 'Temp'
END
"""
_EVENT_VALUE = """
CASE event_type
  WHEN 'error' THEN
    concat('ErrorCode:', if(event_id % 17 = 0, 'x', string(event_id * 37 % 16384)), ',Z:1')
  WHEN 'view' THEN
    concat('StOvMode:', event_id % 4,
           CASE event_id % 3 WHEN 0 THEN ',MultiStageName:soup'
                             WHEN 1 THEN ',MultiStageName:' ELSE '' END)
  WHEN 'signup' THEN
    concat(if(event_id % 2 = 0, 'LStOvMode:2', 'RStOvMode:2'),
           if(event_id % 5 = 0, ',StOvMode:3', ''))
  WHEN 'click' THEN
    concat('MultiStageName:', if(event_id % 4 = 0, '', concat('dish', event_id % 6)))
  WHEN 'purchase' THEN 'Temp:1'
END
"""


def device_log(events: DataFrame, renamed: bool = False) -> DataFrame:
    """Map ``events`` (batch or stream) to device-log rows.

    ``renamed`` gives every device two names, so that groups collide on the key
    of the stored table.
    """
    name = "concat('d', user_id, '-', event_id % 2)" if renamed else "concat('d', user_id)"
    log = events.selectExpr(
        "string(NULL) AS deviceType",
        "concat('iot', user_id) AS iotId",
        "string(event_id) AS requestId",
        "string(NULL) AS checkFailedData",
        "concat('P', user_id % 4) AS productKey",
        "unix_millis(timestamp(ts)) AS gmtCreate",
        f"{name} AS deviceName",
        f"{_EVENT_NAME} AS eventName",
        f"{_EVENT_VALUE} AS eventValue",
        "if(event_type = 'error', concat('ErrorCode:', event_id % 64), '') AS eventOriValue",
    )
    return log.withColumn("ts_ltz", event_time(F.col("gmtCreate")))


def fault_dictionary(spark: SparkSession) -> DataFrame:
    """Products P0..P3 with faults E1..E12: one fault each is missing, some have no type."""
    product, fault = F.col("id") % 4, F.shiftright("id", 2) + 1
    return (
        spark.range(0, 48, 1, numPartitions=1)
        .where(fault != product + 3)
        .select(
            F.when(fault % 5 != 0, F.lit("T")).alias("fault_type_code"),
            F.concat(F.lit("P"), product.cast("string")).alias("smart_product_code"),
            F.concat(F.lit("E"), fault.cast("string")).alias("fault_code"),
            F.concat(F.lit("fault"), fault.cast("string")).alias("fault_name"),
        )
    )


# Fixed value: when the second version of the dictionary begins, in seconds since 1970.
VERSION_CUT = 1_705_276_800


def versioned_dictionary(spark: SparkSession) -> DataFrame:
    """``fault_dictionary`` from the beginning, and since VERSION_CUT a version of some entries.

    Every third fault has another name then, and every fourth is no longer known.
    """
    first = fault_dictionary(spark)
    number = F.substring("fault_code", 2, 2).cast("int")
    second = first.where((number % 3 == 0) | (number % 4 == 0)).withColumns(
        {
            "fault_type_code": F.when(number % 4 != 0, F.col("fault_type_code")),
            "fault_name": F.concat(F.lit("newer "), F.col("fault_name")),
        }
    )
    return first.withColumn("valid_from", F.lit(None).cast("timestamp")).unionByName(
        second.withColumn("valid_from", F.timestamp_seconds(F.lit(VERSION_CUT)))
    )


# Codes (new, previous) that the plain log does not have. An event's
# kind of edge is chosen by its id.
EDGE_STEP = 7
_CODES = [
    ("ErrorCode:+5", "ErrorCode:0"),
    ("ErrorCode: 5 ", "ErrorCode:0"),
    ("ErrorCode:9223372036854775808", "ErrorCode:0"),
    ("ErrorCode:4611686018427387904", "ErrorCode:0"),
    ("ErrorCode:4611686018427387905", "ErrorCode:0"),
    ("ErrorCode:5", "ErrorCode:-1"),
    ("ErrorCode:-3", "ErrorCode:0"),
    ("ErrorCode:1,ErrorCode:6", "ErrorCode:2,ErrorCode:4"),
    ("ErrorCode:3,ErrorCode", "ErrorCode:0"),
    ("ErrorCode:", "ErrorCode:0"),
    ("ErrorCode:12", None),
]


def edge_log(events: DataFrame) -> DataFrame:
    """The device log with edge rows in it.

    Of every seven events one gets an unusual code, one a missing device field, one an
    event time in microseconds or none, and one a payload with duplicate keys.
    """
    log = device_log(events).drop("ts_ltz")
    number = F.col("requestId").cast("bigint")
    kind, turn = number % EDGE_STEP, F.floor(number / EDGE_STEP)
    code = (turn % len(_CODES)).cast("int")

    def at(position: int) -> Column:
        return F.get(F.array(*[F.lit(pair[position]) for pair in _CODES]), code)

    field = turn % 3
    edges = log.withColumns(
        {
            "eventName": F.when(kind == 0, F.lit("ErrorCode")).otherwise(F.col("eventName")),
            "eventValue": F.when(kind == 0, at(0))
            .when(kind == 3, F.concat("eventValue", F.lit(",StOvMode:5,StOvMode:6,MultiStageName:")))
            .otherwise(F.col("eventValue")),
            "eventOriValue": F.when(kind == 0, at(1)).otherwise(F.col("eventOriValue")),
            "productKey": F.when((kind == 1) & (field == 0), None).otherwise(F.col("productKey")),
            "iotId": F.when((kind == 1) & (field == 1), None).otherwise(F.col("iotId")),
            "deviceName": F.when((kind == 1) & (field == 2), None).otherwise(F.col("deviceName")),
            "gmtCreate": F.when((kind == 2) & (turn % 2 == 0), F.col("gmtCreate") * 1000)
            .when((kind == 2) & (turn % 6 == 1), None)
            .otherwise(F.col("gmtCreate")),
        }
    )
    return edges.withColumn("ts_ltz", event_time(F.col("gmtCreate")))
