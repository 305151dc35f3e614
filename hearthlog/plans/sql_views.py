"""The same operations for SQL users: a function and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthlog.functions.fault_codes import OTHER_DIGIT_VALUES, OTHER_DIGITS
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.plans.views import fault_events, recipe_events, working_mode_events

# A function's body is put in the place of its call, and a filter that the optimizer derives
# from an explode is put there once more. So the statement below computes a mask in a
# projection, explodes positions behind it and tests bits: every text is parsed once.
_FUNCTIONS = {
    "strict_long(code STRING) RETURNS BIGINT": rf"""
        CASE WHEN code RLIKE '\\A[+-]?[0-9]+\\z' THEN try_cast(code AS BIGINT)
             WHEN code RLIKE '\\A[+-]?\\p{{Nd}}+\\z'
             THEN try_cast(translate(code, '{OTHER_DIGITS}', '{OTHER_DIGIT_VALUES}') AS BIGINT)
        END
    """,
    "fault_mask(code BIGINT) RETURNS BIGINT": """
        CASE WHEN code > 4611686018427387904 THEN code | shiftleft(1L, 63)
             WHEN code > 0 THEN code
             WHEN code IS NOT NULL THEN 0L END
    """,
    "mask_faults(mask BIGINT) RETURNS ARRAY<STRING>": """
        transform(filter(sequence(0, length(bin(mask)) - 1), p -> getbit(mask, p) = 1),
                  p -> CAST(p + 1 AS STRING))
    """,
    "raised_mask(new_code BIGINT, old_code BIGINT) RETURNS BIGINT":
        "fault_mask(new_code) & ~fault_mask(old_code)",
    "newly_raised_faults(new_code STRING, old_code STRING) RETURNS ARRAY<STRING>":
        "mask_faults(raised_mask(strict_long(new_code), strict_long(old_code)))",
}


def register_functions(spark: SparkSession) -> None:
    """Create ``newly_raised_faults(new, old)``, an array to use with ``LATERAL VIEW explode``."""
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_views(spark: SparkSession, log: DataFrame, dictionary: DataFrame) -> None:
    """Create the log, the dictionary, the three views and the counts as views."""
    views = {
        "device_log": log,
        "fault_dictionary": dictionary,
        "fault_events": fault_events(log, dictionary),
        "working_mode_events": working_mode_events(log),
        "recipe_events": recipe_events(log),
        "daily_operation_counts": daily_operation_counts(log, dictionary),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


_LAST_VALUE = """
  CASE WHEN contains(concat(',', {text}, ','), ',{key}:')
        AND NOT contains(substring_index(concat(',', {text}, ','), ',{key}:', -1), ',{key},')
       THEN substring_index(substring_index(concat(',', {text}, ','), ',{key}:', -1), ',', 1) END
"""


def _value(text: str, key: str) -> str:
    return _LAST_VALUE.format(text=text, key=key).strip()


#: The whole job as one statement over ``device_log`` and ``fault_dictionary``: one scan,
#: every event exploded into its operations.
DAILY_OPERATION_COUNTS = f"""
WITH payloads AS (
  SELECT productKey, iotId, deviceName, ts_ltz, eventName,
         eventName = 'ErrorCode' AS is_error,
         eventName = 'MultiStageName' AS is_recipe,
         CASE WHEN eventName = 'ErrorCode' THEN {_value('eventValue', 'ErrorCode')} END AS new_text,
         CASE WHEN eventName = 'ErrorCode' THEN {_value('eventOriValue', 'ErrorCode')} END AS old_text,
         CASE WHEN eventName IN ('StOvMode', 'LStOvMode', 'RStOvMode')
              THEN {_value('eventValue', 'StOvMode')} END AS mode,
         CASE WHEN eventName <> 'ErrorCode' THEN {_value('eventValue', 'MultiStageName')} END AS recipe
  FROM device_log
  WHERE eventName IN ('ErrorCode', 'StOvMode', 'LStOvMode', 'RStOvMode', 'MultiStageName')
),
codes AS (
  SELECT productKey, iotId, deviceName, ts_ltz, is_error, is_recipe,
         strict_long(new_text) AS new_code, strict_long(old_text) AS old_code,
         CASE WHEN is_recipe THEN CASE WHEN recipe <> '' THEN recipe END
              WHEN mode <> '0' AND (recipe = '' OR recipe IS NULL) THEN mode END AS id
  FROM payloads
),
masks AS (
  SELECT productKey, iotId, deviceName, ts_ltz, is_error, is_recipe, id,
         raised_mask(new_code, old_code) AS mask
  FROM codes
),
positions AS (
  SELECT *, explode(CASE WHEN is_error THEN sequence(0, length(bin(mask)) - 1)
                         WHEN id IS NOT NULL THEN array(0) END) AS position
  FROM masks
),
operations AS (
  SELECT productKey, iotId, deviceName, ts_ltz, is_recipe, id,
         CASE WHEN id IS NULL THEN concat('E', position + 1) END AS fault
  FROM positions
  WHERE id IS NOT NULL OR getbit(coalesce(mask, 0L), position) = 1
)
SELECT date_format(ts_ltz, 'yyyy-MM-dd') AS ds, productKey, iotId, deviceName,
       CASE WHEN id IS NULL THEN 'ErrorCode' WHEN is_recipe THEN 'MultiStageName'
            ELSE 'StOvMode' END AS eventName,
       coalesce(id, fault_code) AS optId,
       CASE WHEN id IS NULL THEN fault_name WHEN is_recipe THEN id END AS optName,
       count(*) AS cnt
FROM operations
LEFT JOIN (SELECT * FROM fault_dictionary WHERE fault_type_code IS NOT NULL)
  ON fault_code = fault AND smart_product_code = productKey
WHERE id IS NOT NULL OR fault_code IS NOT NULL
GROUP BY ALL
"""
