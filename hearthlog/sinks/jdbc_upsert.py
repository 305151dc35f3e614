"""Upserts into a database table: staged by the executors, merged by one statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthlog.schemas import SETTLE_ORDER, STORED, UPSERT_KEY

#: The staging table's column that tells which write a row is of.
RUN = "staged_by"

#: Runs one SQL statement in the target database.
Execute = Callable[[str], None]


def merge_statement(
    dialect: str,
    table: str,
    staging: str,
    columns: Sequence[str] = tuple(STORED.names),
    keys: Sequence[str] = tuple(UPSERT_KEY),
    order: Sequence[str] = tuple(SETTLE_ORDER),
    run: str | None = None,
) -> str:
    """The statement that upserts the staged rows, of one ``run`` or all.

    A staged row replaces a stored one unless that is the later of the two by ``order``:
    the result is the same whatever the batches. A task that ran twice may have staged
    its rows twice, hence DISTINCT.
    """
    names = ", ".join(columns)
    # Columns that decide come last: MySQL assigns in turn, and reads what it assigned.
    rest = [c for c in columns if c not in keys and c not in order]
    rest += [c for c in reversed(order) if c in columns]
    staged = f"SELECT DISTINCT {names} FROM {staging}" + (f" WHERE {_of(run)}" if run else "")
    decide = [c for c in order if c in columns]
    if dialect == "mysql":
        later = _not_before("VALUES({})", "{}", decide)
        updates = ", ".join(f"{c} = IF({later}, VALUES({c}), {c})" if later else f"{c} = VALUES({c})" for c in rest)
        return f"INSERT INTO {table} ({names}) {staged} ON DUPLICATE KEY UPDATE {updates}"
    if dialect == "postgresql":
        later = _not_before("EXCLUDED.{}", table + ".{}", decide)
        updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in rest)
        return (
            f"INSERT INTO {table} ({names}) {staged} "
            f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
            + (f" WHERE {later}" if later else "")
        )
    if dialect == "ansi":
        later = _not_before("s.{}", "t.{}", decide)
        on = " AND ".join(f"t.{c} = s.{c}" for c in keys)
        updates = ", ".join(f"{c} = s.{c}" for c in rest)
        values = ", ".join(f"s.{c}" for c in columns)
        return (
            f"MERGE INTO {table} t USING ({staged}) s ON {on} "
            f"WHEN MATCHED{f' AND ({later})' if later else ''} THEN UPDATE SET {updates} "
            f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
        )
    raise ValueError(f"unknown dialect {dialect!r}: use mysql, postgresql or ansi")


def _of(run: str) -> str:
    return f"{RUN} = '{run}'"


def _not_before(new: str, old: str, order: Sequence[str]) -> str:
    """Whether the new row is at or after the old one; NULL comes before anything."""
    condition = ""
    for name in reversed(order):
        a, b = new.format(name), old.format(name)
        equal = f"({a} = {b} OR ({a} IS NULL AND {b} IS NULL))"
        after = f"{a} > {b} OR ({b} IS NULL AND {a} IS NOT NULL)"
        condition = f"{after} OR ({equal} AND ({condition}))" if condition else f"{after} OR {equal}"
    return condition


def driver_execute(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Execute:
    """Run statements over a JDBC connection of the Spark driver.

    The connection comes from Spark's own factory for the URL's dialect, so drivers given
    by ``--jars`` are found as they are when Spark reads and writes.
    """

    def execute(statement: str) -> None:
        jvm = spark.sparkContext._jvm
        options = jvm.java.util.HashMap()
        for name, value in {**properties, "url": url, "dbtable": "unused"}.items():
            options.put(name, value)
        given = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(
            jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(options)
        )
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        connection = dialect.createConnectionFactory(given).apply(-1)
        try:
            connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()

    return execute


@dataclass(frozen=True)
class JdbcUpsert:
    """Counts in a database table with primary key ``UPSERT_KEY``.

    The table holds the columns of ``STORED``: ``last_ts`` lets the merge keep the group
    with the newest event whatever the order of batches. The executors append a batch to
    the ``staging`` table, over at most ``connections`` connections; only the merge
    statement runs from the driver. Every write stages under a name of its own, merges its
    own rows and removes them, so another job that stages at the same time, or one thought
    dead that goes on, mixes nothing in. What a failed write has staged stays there, unused.
    Counts are absolute, so replaying a batch changes nothing. ``properties`` hold user,
    password and driver and come from the caller.
    """

    keyed: ClassVar[bool] = True
    settles: ClassVar[bool] = False

    url: str
    table: str
    staging: str
    dialect: str = "mysql"
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    connections: int = 16
    execute: Execute | None = None

    def write(self, counts: DataFrame, batch_id: int) -> None:
        run = f"{batch_id}-{uuid.uuid4().hex}"
        rows = counts.select(*STORED.names, F.lit(run).alias(RUN))
        # A shuffle, not a coalesce: the counting before it keeps its own parallelism.
        self._stage(rows.repartition(self.connections))
        execute = self.execute or driver_execute(
            counts.sparkSession, self.url, self.properties
        )
        execute(merge_statement(self.dialect, self.table, self.staging, run=run))
        execute(f"DELETE FROM {self.staging} WHERE {_of(run)}")

    def _stage(self, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, self.staging, mode="append", properties=dict(self.properties))
