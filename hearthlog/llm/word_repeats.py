"""Substring dedup of words: a de Bruijn graph of 35-word edges, compacted to paths.

Every run of 35 consecutive words is an edge. Edges meet in buckets by the least hash
among their runs of 16 words, so that neighbours travel together in one row of hashes. An
edge that meets its like is repeated; repeated edges that follow each other without a
branch are compacted to paths, first in the bucket, then by a join of the paths with
their documents, where their coordinates are checked against the source's words and
adjoining paths become spans. All words of a span are removed.

An edge that a task meets many times is sent once per chunk of text, so a passage that a
third of all documents share reaches its bucket once per chunk.

Defined cases: a null or empty text has no words; texts shorter than 35 words keep all;
repeated rows repeat each other; rows are told apart by ``doc_id`` and 64 bits of their text's hash;
an empty table gives an empty result; columns named like a result column are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.llm import window_counts
from hearthlog.llm.sequences import (
    HASH_BYTES,
    Runs,
    chunks,
    covered,
    mix,
    packed,
    run_hashes,
    window_hashes,
    word_hashes,
)
from hearthlog.llm.window_counts import binary_rows, places
from hearthlog.llm.worker import slices, unzipped, zipped_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
ANCHOR = 16
#: Words hashed together: some twenty numbers of eight bytes are held for each.
CHUNK_WORDS = 1 << 18
RESULT = ["n_words", "n_removed", "kept_text"]
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_text", T.StringType()),
]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = part.column("text").to_pylist()
        found = ((i, 0, word_hashes(t.encode())) for i, t in enumerate(texts) if t)
        for chunk in chunks(found, WINDOW, CHUNK_WORDS):
            yield _chunk_edges(part, chunk)


def _chunk_edges(part: pa.RecordBatch, chunk) -> pa.RecordBatch:
    runs = Runs(chunk, WINDOW, ANCHOR)
    hashes = run_hashes(runs.sums, runs.windows, runs.windows + WINDOW)
    _, first, inverse, counts = np.unique(
        hashes, return_index=True, return_inverse=True, return_counts=True
    )
    again = np.ones(len(hashes), bool)
    again[first] = False
    within = np.arange(len(hashes)) - np.repeat(runs.starts, runs.counts)
    twice = (counts[inverse] >= 2).astype(np.int64) << within
    # A run of edges that the chunk has sent before is known to be repeated.
    known = np.logical_and.reduceat(again, runs.starts)
    sent = np.repeat(~known, runs.counts)
    owner, start = chunk.whose(runs.first)
    edges = binary_rows(
        packed(hashes[sent]), np.where(known, 0, runs.counts * HASH_BYTES), ~known
    )
    # Rows that only pass are dealt out evenly, however many equal ones there are.
    anywhere = mix(hashes[runs.starts] + np.arange(len(known), dtype=np.uint64))
    bucket = np.where(known, anywhere, runs.bucket).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket),
            part.column("doc_id").take(pa.array(owner)),
            part.column("text_hash").take(pa.array(owner)),
            pa.array(places(start, runs.counts)),
            pa.array(np.add.reduceat(twice, runs.starts)),
            edges,
        ],
        ["bucket", "doc_id", "text_hash", "place", "twice", "hashes"],
    )


def repeated_paths(docs: DataFrame) -> DataFrame:
    """Paths of repeated edges: ``doc_id``, ``text_hash``, ``start``, ``n`` and ``path``.

    ``start`` is the first edge's first word and ``n`` the number of edges. ``path`` is the
    first edge's hash, cut to the bytes that travelled, or -1 where it was not looked at.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return window_counts.repeated_windows(
        rows.mapInArrow(_edges, window_counts.COLUMNS.format(key=key))
    )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = np.uint64((1 << (8 * HASH_BYTES)) - 1)
    for part in slices(batches, "__zipped", 2 << 20):
        rows = []
        texts = unzipped(part.column("__zipped"))
        for text, own in zip(texts, part.column("__paths").to_pylist()):
            words = text.split()
            if not own:
                rows.append((len(words), 0, b" ".join(words).decode()))
                continue
            start = np.array([p["start"] for p in own], np.int64)
            path = np.array([p["path"] for p in own], np.int64)
            here = window_hashes(word_hashes(text) + np.uint64(1), WINDOW)[start] & low
            if ((path >= 0) & (here != path.astype(np.uint64))).any():
                raise ValueError("a path does not begin with the words at its coordinates")
            ends = start + np.array([p["n"] for p in own], np.int64) + WINDOW - 1
            gone = covered(len(words), start, ends)
            kept = b" ".join(words[i] for i in np.flatnonzero(~gone))
            rows.append((len(words), int(gone.sum()), kept.decode()))
        nulls = part.column("__zipped").is_null().to_pylist()
        plain = pa.array([None if null else t for t, null in zip(texts, nulls)], pa.binary())
        out = part.drop_columns(["__paths", "__zipped"])
        out = out.append_column("text", plain.cast(pa.string()))
        for name, kind, column in zip(RESULT, (pa.int64(), pa.int64(), pa.string()), zip(*rows)):
            out = out.append_column(name, pa.array(column, kind))
        yield out


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``."""
    docs = docs.drop(*RESULT)
    own = (
        repeated_paths(docs)
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__own"))
        # A set: the paths of equal rows are the same ones, however many rows there are.
        .agg(F.collect_set(F.struct("start", "n", "path")).alias("__paths"))
    )
    texts = zipped_texts(docs)
    same = texts["doc_id"].eqNullSafe(own["__id"]) & (texts["__hash"] == own["__own"])
    rest = [name for name in docs.columns if name != "text"]
    joined = texts.join(own.hint("shuffle_hash"), same, "left").select(*rest, "__zipped", "__paths")
    fields = [docs.schema[name] for name in [*rest, "text"]]
    removed = joined.mapInArrow(_remove, T.StructType([*fields, *_FIELDS]))
    return removed.select(*docs.columns, *RESULT)
