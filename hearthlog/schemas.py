"""Fixed schemas of the device log, the fault dictionary and the daily counts."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


DEVICE_LOG = T.StructType(
    _strings("deviceType", "iotId", "requestId", "checkFailedData", "productKey")
    + [T.StructField("gmtCreate", T.LongType())]
    + _strings("deviceName", "eventName", "eventValue", "eventOriValue")
)

FAULT_DICTIONARY = T.StructType(
    _strings("fault_type_code", "smart_product_code", "fault_code", "fault_name")
)

#: A dictionary that also tells since when an entry holds; one without a type ends it.
VERSIONED_DICTIONARY = T.StructType(
    [*FAULT_DICTIONARY.fields, T.StructField("valid_from", T.TimestampType())]
)

OPERATION_EVENT = T.StructType(
    _strings("productKey", "iotId", "deviceName")
    + [T.StructField("ts_ltz", T.TimestampType())]
    + _strings("eventName", "optId", "optName")
)

DAILY_COUNT = T.StructType(
    _strings("ds", "productKey", "iotId", "deviceName", "eventName", "optId", "optName")
    + [T.StructField("cnt", T.LongType())]
)

#: One stored row per device, operation and day.
UPSERT_KEY = ["ds", "iotId", "eventName", "optId"]

#: A stored count with the time of its group's newest event.
STORED = T.StructType([*DAILY_COUNT.fields, T.StructField("last_ts", T.TimestampType())])

#: Groups that share a stored key: the last of them by these columns is the one kept.
SETTLE_ORDER = ["last_ts", "productKey", "deviceName", "optName", "cnt"]

#: What a count is grouped by, beside the day.
OPERATION_KEY = ["productKey", "iotId", "deviceName", "eventName", "optId", "optName"]

# Event and payload key names as the devices send them.
ERROR_CODE = "ErrorCode"
MODE = "StOvMode"
LEFT_MODE = "LStOvMode"
RIGHT_MODE = "RStOvMode"
RECIPE = "MultiStageName"
MODE_EVENTS = [MODE, LEFT_MODE, RIGHT_MODE]
