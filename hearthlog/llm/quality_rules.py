"""Quality rules whose cutoffs follow each language and source.

Every document is measured once. A mergeable quantile sketch (counts on a fixed grid of
values) per language, source and measure is a partial aggregate in Spark. A document is
rejected when it breaks a base rule or a measure lies beyond its group's fence: as far
again from the quantile up to which documents are ordinary, REACH times, as that is from
the median.

There is no least size of a group. Every sketch is merged with a prior worth PRIOR
documents, which is the sketch above it cut down to its quantiles: that of all documents
for a language, and that of the language for a source. A small group's fences so are nearly
its language's, a big one's its own, and one document more changes either hardly.

Defined cases: a null or empty text has no words and fails the base rules; null languages
and sources are groups of their own; repeated rows count and are judged each; an empty
table gives an empty result; further columns pass through unless named like a result
column, which they then lose.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from hearthlog.llm.worker import park, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Grid cells 0 to 1000 of a sketch; greater values count as 1000.
MAX_CELL = 1000
#: A prior is so many equally likely values, each worth two documents.
PRIOR_VALUES = 25
PRIOR = 2 * PRIOR_VALUES
#: Fences lie so many times beyond the ordinary quantile as that lies beyond the median.
REACH = 4
#: Percent of documents up to which a measure is ordinary. Repetition is rare, and many
#: good documents have none at all, so that their ninth decile says nothing.
UPPER = {"symbols": 90, "dup_lines": 99, "repeats": 99, "upper": 90, "word_len": 90}
#: Percent of documents below which a measure is too low.
LOWER = {"word_len": 10}

_LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
_WHITE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Above so many words, windows are counted as numbers instead of tuples, to bound memory.
_LONG_TEXT = 200_000


def repeated_window_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    if len(words) > _LONG_TEXT:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        window = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True)[1]
        hit = np.flatnonzero(np.bincount(window)[window] > 1)
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[hit + shift] = True
        return int(covered.sum())
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measures(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``_LONGS``."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - len(data) + len(data.translate(None, _WHITE)),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        columns = zip(*map(measures, part.column("text").to_pylist()))
        for name, column in zip(_LONGS, columns):
            part = part.append_column(name, pa.array(column, pa.int64()))
        yield part


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with its measures."""
    docs = docs.drop(*_LONGS, "base_failed", "kept")
    fields = [T.StructField(name, T.LongType()) for name in _LONGS]
    return docs.mapInArrow(_measure, T.StructType([*docs.schema.fields, *fields])).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _cells() -> dict[str, Column]:
    """Grid cells of a document that passes the base rules: parts per thousand, and tenths."""

    def part(count: str, whole: str, scale: int = 1000) -> Column:
        share = F.expr(f"{scale} * {count} div {whole}")
        return F.least(share, F.lit(MAX_CELL)).cast("int")

    return {
        "symbols": part("n_symbols", "word_chars"),
        "dup_lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
        "upper": part("n_upper", "word_chars"),
        "word_len": part("word_chars", "n_words", 10),
    }


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, measure, cell, n`` of the documents that pass the base rules."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), c.alias("cell")) for m, c in _cells().items()])
    return (
        rows.where(~F.col("base_failed"))
        .select("lang", "source", F.inline(cells))
        .groupBy("lang", "source", "measure", "cell")
        .agg(F.count("*").alias("n"))
    )


def _merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))


def _ranked(sketch: DataFrame, *keys: str) -> DataFrame:
    """A sketch with ``upto``, how many values are no greater, and ``total``."""
    by = Window.partitionBy(*keys, "measure")
    upto = by.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    return sketch.withColumns({"total": F.sum("n").over(by), "upto": F.sum("n").over(upto)})


def _prior(sketch: DataFrame, *keys: str) -> DataFrame:
    """A sketch cut down to PRIOR_VALUES values, the middles of as many equal parts."""
    parts = f"(2 * {PRIOR_VALUES} * {{}} div total + 1) div 2"
    values = F.expr(f"{parts.format('upto')} - {parts.format('(upto - n)')}")
    return (
        _ranked(sketch, *keys)
        .select(*keys, "measure", "cell", (2 * values).alias("n"))
        .where(F.col("n") > 0)
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per language and source: the fences its documents are held against.

    ``sketch`` is read several times and should be parked. The prior of all documents is
    at most PRIOR_VALUES values per measure, whatever the input.
    """
    values = ("measure", "cell", "n")
    overall = [
        F.struct(*[F.lit(row[name]).alias(name) for name in values])
        for row in _prior(_merged(sketch)).collect()
    ]
    if not overall:
        nothing = sketch.select("lang", "source").where(F.lit(False))
        return nothing.select("*", *[F.lit(None).cast("int").alias(n) for n in _fence_names()])
    language = sketch.select("lang", *values).unionByName(
        sketch.select("lang").distinct().select("lang", F.inline(F.array(*overall)))
    )
    priors = (
        _prior(_merged(language, "lang"), "lang")
        .groupBy(F.col("lang").alias("_lang"))
        .agg(F.collect_list(F.struct(*values)).alias("prior"))
    )
    groups = sketch.select("lang", "source").distinct()
    inherited = groups.join(priors, groups["lang"].eqNullSafe(priors["_lang"])).select(
        "lang", "source", F.inline("prior")
    )
    ranked = _ranked(
        _merged(sketch.unionByName(inherited), "lang", "source"), "lang", "source"
    )

    def quantile(measure: str, percent: int) -> Column:
        reached = (F.col("measure") == measure) & (100 * F.col("upto") >= percent * F.col("total"))
        return F.min(F.when(reached, F.col("cell")))

    def fence(measure: str, percent: int, name: str) -> Column:
        ordinary = quantile(measure, percent)
        return (ordinary + REACH * (ordinary - quantile(measure, 50))).cast("int").alias(name)

    return ranked.groupBy("lang", "source").agg(
        *[fence(m, percent, f"__max_{m}") for m, percent in UPPER.items()],
        *[fence(m, percent, f"__min_{m}") for m, percent in LOWER.items()],
    )


def _fence_names() -> list[str]:
    return [f"__max_{m}" for m in UPPER] + [f"__min_{m}" for m in LOWER]


def _within() -> Column:
    cells = _cells()
    rules = [cells[m] <= F.coalesce(F.col(f"__max_{m}"), F.lit(MAX_CELL)) for m in UPPER]
    rules += [cells[m] >= F.coalesce(F.col(f"__min_{m}"), F.lit(0)) for m in LOWER]
    return reduce(lambda a, b: a & b, rules)


def judge(docs: DataFrame, keep_texts: bool = False) -> DataFrame:
    """Every document with its measures, ``base_failed`` and ``kept``.

    Without texts the measures are parked between the two passes. With ``keep_texts``
    they are taken twice instead, so that no text is written or shuffled; the fences are
    a small parked table that Spark broadcasts if its measured size allows.
    """
    if keep_texts:
        rows = measured(docs)
        sketch = sketches(measured(docs.select("text", "lang", "source")).drop("text"))
    else:
        rows = park(measured(docs).drop("text"), "quality-measures")
        sketch = sketches(rows)
    limits = park(fences(park(sketch, "quality-sketches")), "quality-fences")
    names = _fence_names()
    limits = limits.select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"), *names
    )
    same = rows["lang"].eqNullSafe(limits["__lang"]) & rows["source"].eqNullSafe(limits["__source"])
    passed = F.when(F.col("base_failed"), F.lit(False)).otherwise(_within())
    return (
        rows.join(limits, same, "left")
        .withColumn("kept", passed)
        .drop("__lang", "__source", *names)
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    return judge(docs, keep_texts=True).where("kept").select(*docs.columns)
