"""Fault bitmasks: strict number parsing and the faults raised between two codes."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

#: Decimal digits of other scripts (full-width ones, for instance) and their values. A
#: strict long may be written in any of them.
OTHER_DIGITS = "".join(
    c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) == "Nd"
)
OTHER_DIGIT_VALUES = "".join(str(unicodedata.decimal(c)) for c in OTHER_DIGITS)

#: Codes above 2^62 report one fault more than they have bits (number 64).
_TOP_BIT = 1 << 62
_FAULT_64 = -(1 << 63)


def strict_long(text: Column) -> Column:
    """An optionally signed run of digits that fits a bigint, else NULL.

    A plain ``try_cast`` is too lenient: it also takes surrounding blanks. Digits of
    other scripts are translated only where the ASCII pattern has failed.
    """
    other = F.translate(text, OTHER_DIGITS, OTHER_DIGIT_VALUES)
    return F.when(F.rlike(text, F.lit(r"\A[+-]?[0-9]+\z")), text.try_cast("bigint")).when(
        F.rlike(text, F.lit(r"\A[+-]?\p{Nd}+\z")), other.try_cast("bigint")
    )


def fault_mask(code: Column) -> Column:
    """Bit ``n`` set means fault ``n + 1``; a code of zero or less has no faults."""
    return (
        F.when(code > F.lit(_TOP_BIT), code.bitwiseOR(F.lit(_FAULT_64)))
        .when(code > 0, code)
        .when(code.isNotNull(), F.lit(0).cast("bigint"))
    )


def raised_mask(new: Column, old: Column) -> Column:
    """Faults in the code ``new`` and not in ``old``; NULL if either code is NULL."""
    return fault_mask(new).bitwiseAND(F.bitwise_not(fault_mask(old)))


def mask_positions(mask: Column) -> Column:
    """Bit positions from 0 to the highest one set, to explode and test with ``has_bit``.

    ``explode`` over a plain sequence stays in whole-stage code; filtering the array
    with a lambda would leave it and run interpreted.
    """
    return F.sequence(F.lit(0), F.length(F.bin(mask)) - 1)


def has_bit(mask: Column, position: Column) -> Column:
    """Whether the bit is set; never NULL.

    The coalesce keeps the optimizer from deriving ``mask IS NOT NULL`` and pushing
    it below the parsing, which would then run twice per event.
    """
    return F.getbit(F.coalesce(mask, F.lit(0)), position) == 1


def fault_number(position: Column) -> Column:
    return (position + 1).cast("string")
