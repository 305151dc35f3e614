"""All operations in one pass over the device log.

A union of the three views reads the log three times. Here every event is parsed
once, according to its name, and a single ``explode`` gives it as many rows as it has
operations. Two things keep the pass in one whole-stage span that parses each text
once: the steps are separate projections, and events without an operation are dropped
by exploding NULL instead of by a filter, since the optimizer would copy the parsing
into a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hearthlog.functions.fault_codes import (
    fault_number,
    has_bit,
    mask_positions,
    raised_mask,
    strict_long,
)
from hearthlog.functions.payload import payload_value
from hearthlog.operators.fault_lookup import (
    Normalizer,
    collapse_copies,
    fault_code,
    match_faults,
)
from hearthlog.schemas import ERROR_CODE, MODE, MODE_EVENTS, OPERATION_KEY, RECIPE

_DEVICE = ["productKey", "iotId", "deviceName", "ts_ltz", "eventName"]


def raw_operations(log: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    """Operations before the dictionary lookup.

    A fault has its code in ``_fault``, anything else has its id in ``_id``. With an
    ``observation``, ErrorCode events skipped because a code is not a number are
    counted there as ``bad_error_codes``.
    """
    name, value = F.col("eventName"), F.col("eventValue")
    is_error, is_mode, is_recipe = name == ERROR_CODE, name.isin(MODE_EVENTS), name == RECIPE
    parsed = (
        log.where(name.isin([ERROR_CODE, *MODE_EVENTS, RECIPE]))
        .select(
            *_DEVICE,
            F.when(is_error, payload_value(value, ERROR_CODE)).alias("_new"),
            F.when(is_error, payload_value(F.col("eventOriValue"), ERROR_CODE)).alias("_old"),
            F.when(is_mode, payload_value(value, MODE)).alias("_mode"),
            F.when(is_mode | is_recipe, payload_value(value, RECIPE)).alias("_recipe"),
        )
        .select(
            *_DEVICE,
            strict_long(F.col("_new")).alias("_new"),
            strict_long(F.col("_old")).alias("_old"),
            _operation_id(is_mode, is_recipe).alias("_id"),
        )
    )
    if observation is not None:
        unreadable = F.col("_new").isNull() | F.col("_old").isNull()
        parsed = parsed.observe(
            observation, F.count_if(is_error & unreadable).alias("bad_error_codes")
        )
    positions = F.when(is_error, mask_positions(F.col("_raised"))).when(
        F.col("_id").isNotNull(), F.array(F.lit(0))
    )
    fault = fault_code(fault_number(F.col("_position")))
    return (
        parsed.select(*_DEVICE, "_id", raised_mask(F.col("_new"), F.col("_old")).alias("_raised"))
        .select("*", F.explode(positions).alias("_position"))
        .where(F.col("_id").isNotNull() | has_bit(F.col("_raised"), F.col("_position")))
        .select(
            "productKey",
            "iotId",
            "deviceName",
            "ts_ltz",
            F.when(is_mode, F.lit(MODE)).otherwise(name).alias("eventName"),
            "_id",
            F.when(F.col("_id").isNull(), fault).alias("_fault"),
        )
    )


def _operation_id(is_mode: Column, is_recipe: Column) -> Column:
    mode, recipe = F.col("_mode"), F.col("_recipe")
    by_hand = (recipe == "") | recipe.isNull()
    return F.when(is_mode & (mode != "0") & by_hand, mode).when(
        is_recipe & (recipe != ""), recipe
    )


def name_operations(
    raw: DataFrame,
    known: DataFrame,
    broadcast: bool,
    normalize: Normalizer | None = None,
) -> DataFrame:
    """Look faults up and give every operation its ``optId`` and ``optName``.

    The copies of an entry that is to be shuffled are collapsed, so a fault has one row per
    distinct name; ``_copies`` tells how often a row counts. Operations that are no faults have no
    ``_fault`` and pass the left join unmatched.
    """
    if broadcast:
        # Copies repeat an event's row inside the generated span, just before it is counted.
        known = known.withColumn("_copies", F.lit(1).cast("bigint"))
    else:
        known = collapse_copies(known)
    joined = match_faults(raw, known, "left", broadcast, normalize)
    is_fault = F.col("_id").isNull()
    name = F.when(F.col("eventName") == RECIPE, F.col("_id")).otherwise(F.col("_name"))
    consumed = {"_id", "_fault"}
    return joined.where(~is_fault | F.col("_copies").isNotNull()).select(
        *[c for c in raw.columns if c not in consumed],
        F.coalesce("_id", "_code").alias("optId"),
        name.alias("optName"),
        F.coalesce("_copies", F.lit(1)).alias("_copies"),
    )


#: What raw operations are counted by before a dictionary that must be shuffled.
RAW_KEY = [c for c in OPERATION_KEY if c not in ("optId", "optName")] + ["_id", "_fault"]
