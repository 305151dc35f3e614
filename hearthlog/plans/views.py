"""The three kinds of operation, each as a view over the device log.

All functions take a log that has ``ts_ltz`` and work on batch and streaming input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.functions.payload import payload_value
from hearthlog.operators.fault_lookup import Normalizer, lookup_faults
from hearthlog.operators.newly_raised import newly_raised_faults
from hearthlog.schemas import ERROR_CODE, MODE, MODE_EVENTS, OPERATION_EVENT, RECIPE

_DEVICE = ["productKey", "iotId", "deviceName", "ts_ltz"]


def _only(rows: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet a condition on parsed columns.

    The others are dropped by exploding NULL: a filter would be moved below the parsing,
    which would then run twice per event.
    """
    return rows.select("*", F.explode(F.when(condition, F.array(F.lit(0)))).alias("_row"))


def error_codes(log: DataFrame) -> DataFrame:
    """New and previous fault code of every ErrorCode event."""
    return log.where(F.col("eventName") == ERROR_CODE).select(
        *_DEVICE,
        payload_value(F.col("eventValue"), ERROR_CODE).alias("new_code"),
        payload_value(F.col("eventOriValue"), ERROR_CODE).alias("old_code"),
    )


def fault_events(
    log: DataFrame,
    dictionary: DataFrame,
    broadcast: bool | None = None,
    normalize: Normalizer | None = None,
) -> DataFrame:
    """Newly raised faults that the dictionary can name."""
    raised = newly_raised_faults(error_codes(log), "new_code", "old_code")
    named = lookup_faults(raised, dictionary, broadcast=broadcast, normalize=normalize)
    return named.select(
        *_DEVICE,
        F.lit(ERROR_CODE).alias("eventName"),
        F.col("fault_code").alias("optId"),
        F.col("fault_name").alias("optName"),
    )


def working_mode_events(log: DataFrame) -> DataFrame:
    """Working modes switched on by hand.

    The payload must hold ``StOvMode``, whichever of the three events carries it: an
    event with only a left or right mode has nothing to compare with '0' and drops
    out. Modes that come with a recipe are left out too. All are reported under the
    same event name.
    """
    recipe = F.col("_recipe")
    parsed = log.where(F.col("eventName").isin(MODE_EVENTS)).select(
        *_DEVICE,
        payload_value(F.col("eventValue"), MODE).alias("optId"),
        payload_value(F.col("eventValue"), RECIPE).alias("_recipe"),
    )
    by_hand = (F.col("optId") != "0") & ((recipe == "") | recipe.isNull())
    return (
        _only(parsed, by_hand)
        .select(
            *_DEVICE,
            F.lit(MODE).alias("eventName"),
            "optId",
            F.lit(None).cast("string").alias("optName"),
        )
    )


def recipe_events(log: DataFrame) -> DataFrame:
    """Recipes started: the recipe's name serves as its id too."""
    parsed = log.where(F.col("eventName") == RECIPE).select(
        *_DEVICE, payload_value(F.col("eventValue"), RECIPE).alias("optId")
    )
    return (
        _only(parsed, F.col("optId") != "")
        .select(
            *_DEVICE,
            F.lit(RECIPE).alias("eventName"),
            "optId",
            F.col("optId").alias("optName"),
        )
    )


def operation_events(
    log: DataFrame, dictionary: DataFrame, broadcast: bool | None = None
) -> DataFrame:
    """All operations, as the union of the views. It reads the log once per view."""
    return (
        fault_events(log, dictionary, broadcast)
        .unionByName(working_mode_events(log))
        .unionByName(recipe_events(log))
        .select(*OPERATION_EVENT.names)
    )
