"""Append-only copy of the counts for an analytic table without days."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame

# The analytic table's column names.
_COLUMNS = {
    "productKey": "productkey",
    "iotId": "iotid",
    "deviceName": "devicename",
    "eventName": "event_name",
    "optId": "opt_id",
    "optName": "opt_name",
    "cnt": "cnt",
}


def analytic_rows(counts: DataFrame) -> DataFrame:
    """The counts without their day, under the analytic table's names."""
    return counts.select([counts[name].alias(alias) for name, alias in _COLUMNS.items()])


@dataclass(frozen=True)
class AnalyticTable:
    """Appends every batch. The table has no key, so changed counts are added as new rows,
    and a replayed batch is added again.

    ``options`` are those of the ``writer`` format (``jdbc``, ``parquet``, ...).
    """

    keyed: ClassVar[bool] = False
    settles: ClassVar[bool] = False

    writer: str
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, counts: DataFrame, batch_id: int) -> None:
        rows = analytic_rows(counts)
        rows.write.format(self.writer).options(**self.options).mode("append").save()
