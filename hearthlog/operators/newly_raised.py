"""From a pair of fault codes to one row per newly raised fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.functions.fault_codes import (
    fault_number,
    has_bit,
    mask_positions,
    raised_mask,
    strict_long,
)


def newly_raised_faults(
    events: DataFrame, new_code: str, old_code: str, fault: str = "fault_number"
) -> DataFrame:
    """One row per fault in ``new_code`` that is not in ``old_code``, as its number.

    Events that raise nothing, or whose codes are not both numbers, yield no row. The
    steps are separate projections so that each text is parsed once per event.
    """
    codes = {"_new": strict_long(F.col(new_code)), "_old": strict_long(F.col(old_code))}
    return (
        events.withColumns(codes)
        .withColumn("_raised", raised_mask(F.col("_new"), F.col("_old")))
        .withColumn("_position", F.explode(mask_positions(F.col("_raised"))))
        .where(has_bit(F.col("_raised"), F.col("_position")))
        .withColumn(fault, fault_number(F.col("_position")))
        .drop("_new", "_old", "_raised", "_position")
    )


def is_bad_code(new_code: str, old_code: str) -> Column:
    """True for an event that yields no fault because a code is not a number."""
    return strict_long(F.col(new_code)).isNull() | strict_long(F.col(old_code)).isNull()
