"""Which windows of a bucket occur more than once: rows of window hashes meet by bucket.

A row holds the hashes of consecutive windows of one document that share a bucket. What
sends the rows has marked windows that it met more than once itself.

A bucket is looked at by one task, which holds it. Buckets with more than about
``HOT_ROWS`` rows are found first, from a sample of the rows; their windows are counted by
Spark one by one, in partial sums, wherever they lie.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from hearthlog.llm.sequences import mix, unpacked
from hearthlog.llm.worker import park, whole_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ``place`` is a window's position in its document times 256, plus the number of windows;
#: bit i of ``twice`` marks window i as repeated already. Rows without hashes are repeated
#: throughout and only pass.
COLUMNS = "bucket bigint, doc_id {key}, text_hash bigint, place bigint, twice bigint, hashes binary"
_WINDOWS = "bucket bigint, doc_id {key}, text_hash bigint, start bigint, path bigint, times bigint"
FOUND = "doc_id {key}, text_hash bigint, start bigint, n bigint, path bigint"

#: A bucket of more rows than these is spread by its windows.
HOT_ROWS = 20_000
#: One row of so many is counted to find such buckets.
SAMPLE = 8


def places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return starts.astype(np.int64) * 256 + counts


def binary_rows(data: np.ndarray, sizes: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """An Arrow column of consecutive parts of ``data``, NULL where not ``valid``."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    bitmap = None if valid is None else pa.array(valid).buffers()[1]
    buffers = [bitmap, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "bucket"):
        place = table.column("place").to_numpy()
        passing = table.column("hashes").is_null().to_numpy()
        which = [np.flatnonzero(passing)]
        starts, counts = [place[passing] // 256], [place[passing] % 256]
        paths = [np.full(len(which[0]), -1, np.int64)]
        if not passing.all():
            rows = np.flatnonzero(~passing)
            row, start, n, path = _repeated(table.take(pa.array(rows)), place[rows])
            which.append(rows[row])
            starts.append(start)
            counts.append(n)
            paths.append(path)
        picked = table.select(["doc_id", "text_hash"]).take(pa.array(np.concatenate(which)))
        out = picked.append_column("start", pa.array(np.concatenate(starts), pa.int64()))
        out = out.append_column("n", pa.array(np.concatenate(counts), pa.int64()))
        out = out.append_column("path", pa.array(np.concatenate(paths), pa.int64()))
        yield from out.combine_chunks().to_batches()


def _expanded(table: pa.Table, place: np.ndarray):
    """Every window of the rows: its row, its number there, its hash and its bit of ``twice``."""
    counts = place % 256
    column = table.column("hashes").combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    hashes = unpacked(data)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, within, hashes, table.column("twice").to_numpy()[row] >> within & 1


def _repeated(table: pa.Table, place: np.ndarray):
    """Paths of repeated windows: (row, start, number of windows, first window's hash).

    A window is an edge of the graph of windows. A path ends where the row or the
    repetition does, and after an edge that is followed by different edges.
    """
    row, within, hashes, twice = _expanded(table, place)
    bucket = table.column("bucket").to_numpy().astype(np.uint64)[row]
    edge, inverse = np.unique(mix(bucket) + hashes, return_inverse=True)
    times = np.bincount(inverse, weights=1 + twice, minlength=len(edge))[inverse]
    repeated = times >= 2
    # Successors in the row, as numbers of edges; the last edge of a row tells nothing.
    inner = np.append(row[1:] == row[:-1], False)
    following = np.append(inverse[1:], 0)
    least = np.full(len(edge), len(edge))
    most = np.full(len(edge), -1)
    np.minimum.at(least, inverse[inner], following[inner])
    np.maximum.at(most, inverse[inner], following[inner])
    branches = (most > least)[inverse]
    begins = repeated.copy()
    begins[1:] &= ~(repeated[:-1] & inner[:-1] & ~branches[:-1])
    first = np.flatnonzero(begins)
    ends = repeated.copy()
    ends[:-1] &= ~(repeated[1:] & inner[:-1] & ~branches[:-1])
    last = np.flatnonzero(ends)
    start = (place // 256)[row[first]] + within[first]
    return row[first], start, last - first + 1, hashes[first].astype(np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        place = table.column("place").to_numpy()
        row, within, hashes, twice = _expanded(table, place)
        out = table.select(["bucket", "doc_id", "text_hash"]).take(pa.array(row))
        out = out.append_column("start", pa.array((place // 256)[row] + within, pa.int64()))
        out = out.append_column("path", pa.array(hashes.astype(np.int64)))
        out = out.append_column("times", pa.array(1 + twice, pa.int64()))
        yield from out.combine_chunks().to_batches()


def _hot_buckets(rows: DataFrame) -> DataFrame:
    sampled = F.pmod(F.xxhash64("doc_id", "text_hash", "place"), F.lit(SAMPLE)) == 0
    return park(
        rows.where(F.col("hashes").isNotNull() & sampled)
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") * SAMPLE > HOT_ROWS)
        .select("bucket"),
        "hot-buckets",
    )


def _hot_windows(rows: DataFrame, key: str) -> DataFrame:
    """Segments of one repeated window each."""
    windows = rows.where("hashes is not null").mapInArrow(_windows, _WINDOWS.format(key=key))
    times = windows.groupBy("bucket", "path").agg(F.sum("times").alias("times"))
    repeated = times.where("times >= 2").select("bucket", "path")
    return windows.join(repeated, ["bucket", "path"], "left_semi").select(
        "doc_id", "text_hash", "start", F.lit(1).cast("bigint").alias("n"), "path"
    )


def repeated_windows(rows: DataFrame) -> DataFrame:
    """Segments of repeated windows: ``doc_id``, ``text_hash``, ``start``, ``n``, ``path``."""
    key = rows.schema["doc_id"].dataType.simpleString()
    hot = _hot_buckets(rows)
    if hot.isEmpty():
        return _by_bucket(rows, key)
    # What sends the rows runs once for each part. Should it cut its chunks otherwise, a row
    # that passes in one run may have a bucket in the other: such rows are taken from both.
    cold = rows.join(hot, "bucket", "left_anti").select(*rows.columns)
    flagged = rows.join(hot.withColumn("__hot", F.lit(True)), "bucket", "left")
    parked = park(
        flagged.where(F.col("__hot") | F.col("hashes").isNull()).select(*rows.columns), "hot-rows"
    )
    passing = parked.where("hashes is null").select(
        "doc_id",
        "text_hash",
        F.expr("place div 256").alias("start"),
        (F.col("place") % 256).alias("n"),
        F.lit(-1).cast("bigint").alias("path"),
    )
    return _by_bucket(cold, key).unionByName(_hot_windows(parked, key)).unionByName(passing)


def _by_bucket(rows: DataFrame, key: str) -> DataFrame:
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_segments, FOUND.format(key=key))
