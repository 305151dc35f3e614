"""Small helpers for code that runs over Arrow batches on Python workers.

Operators name columns of their own with two leading underscores, which are reserved.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.config import shared_dir

# Python workers get the code below with the plan and need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    name = "_hearthlog_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def park(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: computed once, no lineage."""
    path = shared_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = part.column("text").to_pylist()
        zipped = [None if t is None else zlib.compress(t.encode(), 1) for t in texts]
        yield part.drop_columns(["text"]).append_column("__zipped", pa.array(zipped, pa.binary()))


def zipped_texts(docs: DataFrame) -> DataFrame:
    """``docs`` for a shuffle: ``__zipped`` instead of ``text``, and ``__hash`` of the text.

    Zipped one by one, texts take two thirds of what Spark's own compression makes of them.
    """
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    fields = [f for f in hashed.schema if f.name != "text"]
    return hashed.mapInArrow(_zip, T.StructType([*fields, T.StructField("__zipped", T.BinaryType())]))


def unzipped(column: pa.Array) -> list[bytes]:
    """The UTF-8 texts of a zipped column; NULL is an empty one."""
    return [b"" if z is None else zlib.decompress(z) for z in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20):
    """Cut batches into slices with about ``max_bytes`` in a text or binary column.

    One longer value makes a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        sizes = np.nan_to_num(
            np.asarray(pc.binary_length(values).to_numpy(zero_copy_only=False), float)
        )
        part = np.cumsum(sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(part)) + 1
        starts = [0, *cuts.tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str, min_rows: int = 20_000
) -> Iterator[pa.Table]:
    """Tables of whole groups, from a partition that is sorted by ``key``.

    Memory is that of about ``min_rows`` rows and the largest group.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).combine_chunks()
        same = pc.equal(keys, keys[-1]).to_numpy(zero_copy_only=False)
        cut = rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
            held = table.slice(cut).combine_chunks().to_batches()
            rows -= cut
        else:
            # One group so far: ask again when it has doubled.
            min_rows = max(min_rows, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Positions at which a new key begins, in sorted keys, and the end."""
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], change, [len(keys)]])
