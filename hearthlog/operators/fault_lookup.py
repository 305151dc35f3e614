"""Naming faults through the product fault dictionary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.config import MAX_BROADCAST_BYTES, STREAM_SALTS
from hearthlog.sources.fault_dictionary import with_validity

Normalizer = Callable[[Column], Column]


def fault_code(number: Column) -> Column:
    """The dictionary's spelling of a fault number."""
    return F.concat(F.lit("E"), number)


def known_faults(dictionary: DataFrame, normalize: Normalizer | None = None) -> DataFrame:
    """Dictionary rows that can name a fault: those without a type never do."""
    product = F.col("smart_product_code")
    return dictionary.where(F.col("fault_type_code").isNotNull()).select(
        (normalize(product) if normalize else product).alias("_product"),
        F.col("fault_code").alias("_code"),
        F.col("fault_name").alias("_name"),
        *[name for name in ("_from", "_to") if name in dictionary.columns],
    )


def collapse_copies(known: DataFrame) -> DataFrame:
    """Equal dictionary rows as one row with ``_copies``.

    Each copy counts an event once more. Counting can multiply by the number of
    copies, and need not repeat its rows however often an entry is duplicated.
    """
    return known.groupBy("_product", "_code", "_name").agg(F.count("*").alias("_copies"))


def fits_broadcast(known: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure the dictionary (one small job) rather than assume that it is small."""
    row_overhead = 64
    length = sum(
        (F.coalesce(F.octet_length(c), F.lit(0)) for c in ("_product", "_code", "_name")),
        F.lit(row_overhead).cast("bigint"),
    )
    return (known.agg(F.sum(length)).first()[0] or 0) <= limit


def match_faults(
    rows: DataFrame,
    known: DataFrame,
    how: str,
    broadcast: bool,
    normalize: Normalizer | None = None,
) -> DataFrame:
    """Join ``rows`` (``productKey``, ``_fault``) to ``known_faults`` of the same ``normalize``.

    A dictionary too big to broadcast is merged. One (product, fault) pair may hold a
    large part of all rows: in a batch adaptive execution splits it. A stream has no
    adaptive execution, so its rows are spread over salts and the dictionary is repeated
    per salt; the salt is the number of the row's partition, which is the same when a
    lost task runs again. Rows without a fault match nothing and are spread by their
    device instead of meeting under one NULL.
    """
    same = normalize or (lambda c: c)
    on = (same(F.col("productKey")) == F.col("_product")) & (
        same(F.col("_fault")) == same(F.col("_code"))
    )
    if broadcast:
        return rows.join(F.broadcast(known), on, how)
    if how == "left":
        nothing = F.concat(F.lit("no fault "), F.xxhash64("iotId", "_id").cast("string"))
        rows = rows.withColumn("_sought", F.coalesce("_fault", nothing))
    else:
        rows = rows.withColumn("_sought", F.col("_fault"))
    on = (same(F.col("productKey")) == F.col("_product")) & (
        same(F.col("_sought")) == same(F.col("_code"))
    )
    if not rows.isStreaming:
        return rows.join(known.hint("merge"), on, how).drop("_sought")
    salted = rows.withColumn("_salt", F.spark_partition_id() % STREAM_SALTS)
    salts = F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))
    repeated = known.withColumn("_known_salt", F.explode(salts)).hint("merge")
    return salted.join(repeated, on & (F.col("_salt") == F.col("_known_salt")), how).drop("_sought")


def lookup_faults(
    faults: DataFrame,
    dictionary: DataFrame,
    number: str = "fault_number",
    broadcast: bool | None = None,
    normalize: Normalizer | None = None,
) -> DataFrame:
    """Keep the faults that the dictionary knows for their product and name them.

    Adds ``fault_code`` and ``fault_name``. A fault without an entry, or whose entry
    has no type, is dropped; one with several entries is repeated. ``broadcast=None`` and
    ``True`` measure the dictionary first: one that is too big is never broadcast. Matching is exact unless ``normalize`` (for
    instance ``F.upper``) is given; the names returned are always the dictionary's.
    """
    known = known_faults(dictionary, normalize)
    if broadcast is not False:
        broadcast = fits_broadcast(known)
    rows = faults.withColumn("_fault", fault_code(F.col(number)))
    return match_faults(rows, known, "inner", broadcast, normalize).select(
        *faults.columns,
        F.col("_code").alias("fault_code"),
        F.col("_name").alias("fault_name"),
    )


def lookup_faults_as_of(
    faults: DataFrame,
    versions: DataFrame,
    at: str = "ts_ltz",
    number: str = "fault_number",
    broadcast: bool | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``lookup_faults`` in the dictionary as it was at each fault's own time ``at``.

    For logs that are counted after the fact: whatever the dictionary says today, a fault
    gets the name that held when it came in. A fault without a time finds nothing.
    """
    held = with_validity(versions)
    known = known_faults(held)
    if broadcast is not False:
        broadcast = fits_broadcast(known, max_broadcast_bytes)
    time = F.unix_micros(at)
    rows = faults.withColumn("_fault", fault_code(F.col(number)))
    matched = match_faults(rows, known, "inner", broadcast)
    return matched.where(
        (time >= F.col("_from")) & (F.col("_to").isNull() | (time < F.col("_to")))
    ).select(*faults.columns, F.col("_code").alias("fault_code"), F.col("_name").alias("fault_name"))
