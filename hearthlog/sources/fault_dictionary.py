"""The fault dictionary, from a database table or files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hearthlog.schemas import FAULT_DICTIONARY, VERSIONED_DICTIONARY


def read_jdbc_dictionary(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    versioned: bool = False,
    partitions: int = 1,
) -> DataFrame:
    """Dictionary in a database; ``options`` carry user, password and driver.

    A stream reads it again for every micro-batch, so a changed entry applies from
    the next batch on. With ``partitions`` that many connections read the products between
    them, by ranges of the product code that the table itself is asked for.
    """
    names = VERSIONED_DICTIONARY.names if versioned else FAULT_DICTIONARY.names
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if partitions == 1:
        return reader.option("dbtable", table).load().select(*names)
    ranges = (
        f"(SELECT MIN(c) AS c, n FROM (SELECT smart_product_code AS c, "
        f"NTILE({partitions}) OVER (ORDER BY smart_product_code) AS n FROM {table}) t "
        "GROUP BY n) AS ranges"
    )
    found = reader.option("dbtable", ranges).load().orderBy("n").collect()
    return spark.read.jdbc(
        url,
        table,
        predicates=range_predicates("smart_product_code", [r.c for r in found if r.c is not None]),
        properties=dict(options or {}),
    ).select(*names)


def range_predicates(column: str, starts: Sequence[str]) -> list[str]:
    """Conditions that split a table at ``starts``: every row, NULL too, meets exactly one.

    ``starts`` come in the database's own order, which need not be Python's.
    """

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    cuts = list(dict.fromkeys(starts))[1:]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {text(cuts[0])} OR {column} IS NULL"
    inner = [f"{column} >= {text(a)} AND {column} < {text(b)}" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= {text(cuts[-1])}"]


def read_dictionary_files(
    spark: SparkSession, path: str, file_format: str = "parquet", versioned: bool = False
) -> DataFrame:
    """Dictionary in files. A stream keeps the files it found when it was started."""
    schema = VERSIONED_DICTIONARY if versioned else FAULT_DICTIONARY
    return spark.read.schema(schema).format(file_format).load(path)


def dictionary_at(versions: DataFrame, at: float) -> DataFrame:
    """The entries of a versioned dictionary that hold ``at`` seconds since 1970."""
    micros = F.lit(round(at * 1_000_000))
    held = with_validity(versions)
    now = (F.col("_from") <= micros) & (F.col("_to").isNull() | (F.col("_to") > micros))
    return held.where(now).select(*FAULT_DICTIONARY.names)


def with_validity(versions: DataFrame) -> DataFrame:
    """``versions`` with ``_from`` and ``_to``, in microseconds since 1970.

    An entry (a code of a product) holds until its next version begins, the newest for
    good, and one without ``valid_from`` from the beginning. Versions of one time hold
    together. One without a type ends what held before and names nothing itself.
    """
    since = F.coalesce(F.unix_micros("valid_from"), F.lit(-(1 << 62)))
    entry = Window.partitionBy("smart_product_code", "fault_code").orderBy("_from")
    later = F.min("_from").over(entry.rangeBetween(1, Window.unboundedFollowing))
    return versions.withColumn("_from", since).withColumn("_to", later)
