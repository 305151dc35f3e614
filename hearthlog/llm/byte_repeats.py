"""Repeated byte strings, grouped in passes that look ever deeper, down to the threshold.

Every run of 200 bytes is to meet its equals. Suffixes are not put in order: as in a radix
sort, passes by a digit send on only what shares its digit, but a digit is no prefix. It is
the run of 96, then 160 bytes in a string that has the least hash, so neighbouring strings
stand in one row, and strings whose digit nothing shares are left out unseen. What
remains is grouped by all 200 bytes, and the groups of two or more are the repeated strings.

A pass also settles whole rows: where two rows are equal from their first to their last
byte, all their strings are repeated. After the first pass only rows that share a digit
with a different row are open, few even among many copies. Texts without open rows are
finished then; the others wait with their text for the second pass.

Rows that a task meets in many equal copies are sent once per chunk; a digit that stands
in several different rows of a chunk is known to be shared, so its rows are dealt out by
their content and only a probe goes to the digit's bucket. The rows of a digit that very
many rows have are all dealt out by their content.

Defined cases: a null text is an empty one; texts shorter than 200 bytes keep all; rows
are told apart by ``doc_id`` and their text's hash, and repeated rows repeat each other; an
empty table gives an empty result; columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.llm import window_counts
from hearthlog.llm.sequences import HASH_BYTES, Runs, chunks, covered, mix, packed, run_hashes
from hearthlog.llm.window_counts import binary_rows, places
from hearthlog.llm.worker import park, slices, unzipped, whole_groups, zipped_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 200
#: Depth of the digits of the two passes before the last.
DIGITS = (96, 160)
#: Bytes hashed together: some twenty numbers of eight bytes are held for each.
CHUNK_BYTES = 1 << 19
RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
_FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("kept", T.BinaryType()),
]
_SETTLED, _SHARED, _PROBE, _PASSING = 1, 2, 4, 8
#: A digit of more rows than these is judged by its rows' contents; one text in so many is
#: looked at to find such digits.
HOT_ROWS, SAMPLE = 20_000, 16
_ROWS = (
    "bucket bigint, whole bigint, doc_id {key}, text_hash bigint, place bigint, flags int"
)
_VERDICTS = "doc_id {key}, text_hash bigint, place bigint, settled boolean, open boolean"


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    for i, text in enumerate(column.to_pylist()):
        if text:
            yield i, 0, np.frombuffer(text.encode(), np.uint8)


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        for chunk in chunks(_texts(part.column("text")), WINDOW, CHUNK_BYTES):
            yield _chunk_rows(part, chunk)


def _chunk_rows(part: pa.RecordBatch, chunk) -> pa.RecordBatch:
    runs = Runs(chunk, WINDOW, DIGITS[0])
    whole = run_hashes(runs.sums, runs.first, runs.first + runs.counts - 1 + WINDOW)
    _, first, inverse, copies = np.unique(
        whole, return_index=True, return_inverse=True, return_counts=True
    )
    again = np.ones(len(whole), bool)
    again[first] = False
    # Different rows of one digit: known to be shared, to be dealt out by their content.
    digit, kinds = np.unique(runs.bucket[first], return_counts=True)
    shared = (kinds >= 2)[np.searchsorted(digit, runs.bucket)]
    flags = np.where(copies[inverse] >= 2, _SETTLED, 0) | np.where(shared, _SHARED, 0)
    flags = np.where(again, _PASSING, flags)
    # Rows that only pass are dealt out evenly, however many equal ones there are.
    anywhere = mix(whole + np.arange(len(whole), dtype=np.uint64))
    bucket = np.where(again, anywhere, runs.bucket)
    owner, start = chunk.whose(runs.first)
    place = places(start, runs.counts)
    probes = digit[kinds >= 2]
    n, owners = len(probes), np.concatenate([owner, np.zeros(len(probes), np.int64)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([bucket, probes]).view(np.int64)),
            pa.array(np.concatenate([whole, np.zeros(n, np.uint64)]).view(np.int64)),
            part.column("doc_id").take(pa.array(owners)),
            part.column("text_hash").take(pa.array(owners)),
            pa.array(np.concatenate([place, np.zeros(n, np.int64)])),
            pa.array(np.concatenate([flags, np.full(n, _PROBE)]).astype(np.int32)),
        ],
        ["bucket", "whole", "doc_id", "text_hash", "place", "flags"],
    )


def _dealt(rows: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """``rows`` with the buckets in which they meet: their digits, or their contents.

    A row whose digit is known to be shared is settled by its content alone, and open
    anyhow. That holds for digits that a chunk has met in different rows, and for those
    that too many rows have for one task, found from one text in ``SAMPLE``.
    """
    sample = texts.sample(fraction=1 / SAMPLE, seed=0)
    seen = sample.mapInArrow(_first_rows, _ROWS.format(key=key))
    hot = park(
        seen.where(F.col("flags").bitwiseAND(_PASSING | _SHARED) == 0)
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") * SAMPLE > HOT_ROWS)
        .select("bucket"),
        "hot-digits",
    )
    flags = F.col("flags")
    if not hot.isEmpty():
        passing = flags.bitwiseAND(_PASSING) != 0
        rows = (
            rows.join(hot.withColumn("__hot", ~F.isnull("bucket")), "bucket", "left")
            .withColumn("__hot", F.coalesce("__hot", F.lit(False)) & ~passing)
            .where(~F.col("__hot") | (flags != _PROBE))
            .withColumn("flags", F.when(F.col("__hot"), flags.bitwiseOR(_SHARED)).otherwise(flags))
            .select("bucket", "whole", "doc_id", "text_hash", "place", "flags")
        )
    known = flags.bitwiseAND(_SHARED | _PASSING) == _SHARED
    by_content = F.when(known, F.xxhash64("bucket", "whole")).otherwise(F.col("bucket"))
    return rows.withColumn("bucket", by_content)


def _judge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are settled, and rows that are open: one of each content in a shared digit."""
    for table in whole_groups(batches, "bucket"):
        bucket = table.column("bucket").to_numpy().view(np.uint64)
        whole = table.column("whole").to_numpy().view(np.uint64)
        flags = table.column("flags").to_numpy()
        passing, probe = (flags & _PASSING) > 0, (flags & _PROBE) > 0
        plain = ~passing & ~probe
        content, first, inverse = np.unique(
            mix(bucket) ^ whole, return_index=True, return_inverse=True
        )
        weight = np.where(plain, 1 + (flags & _SETTLED), 0)
        settled = plain & (np.bincount(inverse, weight, len(content))[inverse] >= 2)
        group = np.unique(bucket, return_inverse=True)[1]
        leads = np.zeros(len(bucket), bool)
        leads[first] = True
        # Contents and probes of each digit: several of them make it a shared one.
        kinds = np.bincount(group, (leads & plain) | probe)[group]
        lonely = (kinds < 2) & ((flags & _SHARED) == 0)
        opened = plain & leads & ~lonely
        out = table.select(["doc_id", "text_hash", "place"])
        out = out.append_column("settled", pa.array(settled | passing))
        out = out.append_column("open", pa.array(opened))
        yield from out.filter(pa.array(settled | passing | opened)).combine_chunks().to_batches()


def _finish(data: bytes, starts: np.ndarray, counts: np.ndarray, keep: bool) -> tuple:
    """The result columns of a text whose repeated strings are known."""
    array = np.frombuffer(data, np.uint8)
    if not len(starts):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data if keep else None
    gone = covered(len(data), starts, starts + counts + WINDOW - 1)
    kept = array[~gone].tobytes()
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    sha = hashlib.sha256(kept).hexdigest()
    return len(data), int(gone.sum()), spans, sha, kept if keep else None


def _with_results(part: pa.RecordBatch, rows: list[tuple | None]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    for i, (name, kind) in enumerate(zip(RESULT, kinds)):
        values = [None if row is None else row[i] for row in rows]
        part = part.append_column(name, pa.array(values, kind))
    return part


def _settler(keep: bool):
    """Finish texts without open rows; let the others wait with theirs."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__zipped", 2 << 20):
            rows, waiting, opened = [], [], []
            verdicts = part.column("__verdicts").to_pylist()
            texts = unzipped(part.column("__zipped"))
            for text, own in zip(texts, verdicts):
                own = own or []
                done = np.array([v["place"] for v in own if v["settled"]], np.int64)
                asks = [2 * v["place"] + v["settled"] for v in own if v["open"]]
                waiting.append(bool(asks))
                opened.append(asks)
                rows.append(None if asks else _finish(text, done // 256, done % 256, keep))
            settled = [
                [v["place"] for v in own or [] if v["settled"]] if wait else None
                for own, wait in zip(verdicts, waiting)
            ]
            zipped = part.column("__zipped").to_pylist()
            plain = [
                t if keep and not wait and z is not None else None
                for t, z, wait in zip(texts, zipped, waiting)
            ]
            later = [z if wait else None for z, wait in zip(zipped, waiting)]
            out = part.drop_columns(["__verdicts", "__zipped"])
            out = out.append_column("text", pa.array(plain, pa.binary()).cast(pa.string()))
            out = _with_results(out, rows).append_column("__zipped", pa.array(later, pa.binary()))
            out = out.append_column("__waiting", pa.array(waiting, pa.bool_()))
            out = out.append_column("__settled", pa.array(settled, pa.list_(pa.int64())))
            yield out.append_column("__open", pa.array(opened, pa.list_(pa.int64())))

    return settle


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of open rows, by the deeper digit, with their hashes."""
    for part in slices(batches, "__zipped", 2 << 20):
        open_rows: list[tuple[int, int]] = []
        pieces = []
        columns = unzipped(part.column("__zipped")), part.column("__open").to_pylist()
        for i, (text, asks) in enumerate(zip(*columns)):
            data = np.frombuffer(text, np.uint8)
            for ask in asks:
                start, count = divmod(ask // 2, 256)
                pieces.append((len(open_rows), start, data[start : start + count - 1 + WINDOW]))
                open_rows.append((i, ask & 1))
        owner_of = np.array([i for i, _ in open_rows], np.int64)
        settled_of = np.array([s for _, s in open_rows], np.int64)
        for chunk in chunks(pieces, WINDOW, CHUNK_BYTES):
            runs = Runs(chunk, WINDOW, DIGITS[1])
            hashes = run_hashes(runs.sums, runs.windows, runs.windows + WINDOW)
            row, start = chunk.whose(runs.first)
            owner = owner_of[row]
            twice = np.where(settled_of[row] > 0, (np.int64(1) << runs.counts) - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.bucket.view(np.int64)),
                    part.column("doc_id").take(pa.array(owner)),
                    part.column("__hash").take(pa.array(owner)),
                    pa.array(places(start, runs.counts)),
                    pa.array(twice),
                    binary_rows(packed(hashes), runs.counts * HASH_BYTES),
                ],
                ["bucket", "doc_id", "text_hash", "place", "twice", "hashes"],
            )


def _finisher(keep: bool):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__zipped", 2 << 20):
            rows = []
            texts = unzipped(part.column("__zipped"))
            lists = [part.column(name).to_pylist() for name in ("__settled", "__segments")]
            for text, done, more in zip(texts, *lists):
                done = np.array(done or [], np.int64)
                more = more or []
                starts = np.concatenate([done // 256, np.array([s["start"] for s in more], np.int64)])
                counts = np.concatenate([done % 256, np.array([s["n"] for s in more], np.int64)])
                rows.append(_finish(text, starts, counts, keep))
            plain = pa.array([t if keep else None for t in texts], pa.binary()).cast(pa.string())
            out = part.drop_columns(["__settled", "__segments", "__zipped"])
            yield _with_results(out.append_column("text", plain), rows)

    return finish


def _gathered(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    # A set: what equal rows are told is the same, however many rows there are.
    return rows.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__own")).agg(
        F.collect_set(F.struct(*columns)).alias(name)
    )


def without_repeats(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``.

    Without ``keep_bytes`` the columns ``kept`` and ``text`` are NULL: finished texts are
    not parked.
    """
    docs = docs.drop(*RESULT)
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    first = rows.mapInArrow(_first_rows, _ROWS.format(key=key))
    verdicts = (
        _dealt(first, rows, key)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_judge_rows, _VERDICTS.format(key=key))
    )
    own = _gathered(verdicts, "__verdicts", "place", "settled", "open")
    texts = zipped_texts(docs)
    same = texts["doc_id"].eqNullSafe(own["__id"]) & (texts["__hash"] == own["__own"])
    rest = [name for name in docs.columns if name != "text"]
    judged = texts.join(own.hint("shuffle_hash"), same, "left").select(
        *rest, "__hash", "__zipped", "__verdicts"
    )
    base = [docs.schema[name] for name in rest]
    text = T.StructField("text", docs.schema["text"].dataType)
    hashed = T.StructField("__hash", T.LongType())
    waits = [
        T.StructField("__zipped", T.BinaryType()),
        T.StructField("__waiting", T.BooleanType()),
        T.StructField("__settled", T.ArrayType(T.LongType())),
        T.StructField("__open", T.ArrayType(T.LongType())),
    ]
    settled = judged.mapInArrow(
        _settler(keep_bytes), T.StructType([*base, hashed, text, *_FIELDS, *waits])
    )
    parked = park(settled, "byte-repeats")
    done = parked.where(~F.col("__waiting")).select(*docs.columns, *RESULT)
    waiting = parked.where("__waiting").select(*rest, "__hash", "__zipped", "__settled", "__open")
    open_rows = waiting.select("doc_id", "__hash", "__zipped", "__open")
    segments = window_counts.repeated_windows(
        open_rows.mapInArrow(_open_windows, window_counts.COLUMNS.format(key=key))
    )
    more = _gathered(segments, "__segments", "start", "n")
    same = waiting["doc_id"].eqNullSafe(more["__id"]) & (waiting["__hash"] == more["__own"])
    last = waiting.join(more.hint("shuffle_hash"), same, "left").select(
        *rest, "__zipped", "__settled", "__segments"
    )
    finished = last.mapInArrow(_finisher(keep_bytes), T.StructType([*base, text, *_FIELDS]))
    return done.unionByName(finished.select(*docs.columns, *RESULT))
