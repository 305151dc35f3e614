"""Token counts of whole texts through a two-tier table of pre-token lengths.

Tokens never span white space, so a text has as many as its pre-tokens (runs without
ASCII white space) have together. Frequent pre-tokens are found by mergeable summaries of
bounded size, one per task over all texts; their lengths are encoded once and broadcast as
a compact table. Everything else is encoded by the worker that meets it and kept in a
bounded cache there. No pre-token is shuffled: the one small exchange merges summaries.

Defined cases: a null or empty text has no tokens; a text that holds one of the
tokenizer's special strings is encoded whole, as the library does; every row is counted
for itself; further columns pass through unless named like a result column.
"""

from __future__ import annotations

import os
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.llm.worker import slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOKENS = 2048
#: Entries of the broadcast table and of a task's summary, and the longest pre-token in
#: them: together they bound what is broadcast to about 2 MB.
TABLE_ENTRIES = 16_384
SUMMARY_ENTRIES = 4_096
MAX_ENTRY_BYTES = 64
#: Pre-tokens a worker remembers; the cache is emptied when it has more.
CACHE_ENTRIES = 500_000


def vocabulary_file(path: str) -> str:
    """Where a vocabulary file lies on this machine.

    A name without a folder is one of the public tokenizers', which each machine finds for
    itself.
    """
    if "/" in path:
        return path
    import public_tokenizers

    return str(public_tokenizers.path(path))


def load_tokenizer(path: str):
    """The library's tokenizer of a vocabulary file, once per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    cache = worker_cache()
    if ("tokenizer", path) not in cache:
        from tokenizers import Tokenizer

        cache["tokenizer", path] = Tokenizer.from_file(vocabulary_file(path))
    return cache["tokenizer", path]


def special_strings(tokenizer) -> list[str]:
    return [token.content for token in tokenizer.get_added_tokens_decoder().values()]


def _summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The heavy hitters of a task: counts, cut back to the largest when they are too many.

    What is cut away lowers every count that stays (Misra and Gries), so an entry's count
    is never too high, and every pre-token above 1 / SUMMARY_ENTRIES of the task's is kept.
    """
    counts: Counter[bytes] = Counter()
    for part in slices(batches, "text"):
        for text in part.column("text").to_pylist():
            counts.update((text or "").encode().split())
        if len(counts) > 16 * SUMMARY_ENTRIES:
            counts = _cut(counts)
    counts = _cut(counts)
    kept = [(w.decode(), n) for w, n in counts.items() if len(w) <= MAX_ENTRY_BYTES]
    yield pa.RecordBatch.from_pydict(
        {
            "word": pa.array([w for w, _ in kept], pa.string()),
            "n": pa.array([n for _, n in kept], pa.int64()),
        }
    )


def _cut(counts: Counter[bytes]) -> Counter[bytes]:
    if len(counts) <= SUMMARY_ENTRIES:
        return counts
    largest = counts.most_common(SUMMARY_ENTRIES + 1)
    least = largest.pop()[1]
    return Counter({w: n - least for w, n in largest if n > least})


def frequent_lengths(docs: DataFrame, path: str) -> dict[bytes, int]:
    """Token counts of the most frequent pre-tokens of all texts."""
    summaries = docs.select("text").mapInArrow(_summarize, "word string, n bigint")
    largest = (
        summaries.groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(TABLE_ENTRIES)
    )
    words = [row.word for row in largest.select("word").collect()]
    tokenizer = load_tokenizer(path)
    special = special_strings(tokenizer)
    words = [w for w in words if not any(s in w for s in special)]
    encoded = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return {w.encode(): len(e.ids) for w, e in zip(words, encoded)}


def _counter(path: str, limit: int, table):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        special = special_strings(tokenizer)
        frequent = table.value
        cache = worker_cache().setdefault(("lengths", path), {})
        for part in slices(batches, "text"):
            texts = [text or "" for text in part.column("text").to_pylist()]
            data = [text.encode() for text in texts]
            whole = [any(s in text for s in special) for text in texts]
            split = [[] if w else d.split() for d, w in zip(data, whole)]
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            if not cache:
                cache.update(frequent)
            missing = list(set(chain.from_iterable(split)).difference(cache))
            encoded = tokenizer.encode_batch_fast(
                [w.decode() for w in missing], add_special_tokens=False
            )
            cache.update(zip(missing, map(len, encoded)))
            counts = [
                len(tokenizer.encode(text, add_special_tokens=False).ids)
                if w
                else sum(map(cache.__getitem__, words))
                for text, w, words in zip(texts, whole, split)
            ]
            part = part.append_column("n_bytes", pa.array(map(len, data), pa.int64()))
            part = part.append_column("n_tokens", pa.array(counts, pa.int64()))
            yield part.append_column("over_limit", pa.array([n > limit for n in counts], pa.bool_()))

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = MAX_TOKENS) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``path`` is a vocabulary file of the tokenizers library that every worker can open, or
    the name of one of the public tokenizers.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.mapInArrow(_counter(path, limit, table), schema)
