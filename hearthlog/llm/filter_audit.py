"""What each of five filters removes, and what it costs, in every order they can be applied.

A document is reduced to the set of filters that it fails, its *mask*. In an order of the
filters a document goes at the first step whose filter is in its mask. Orders are numbered
by their Lehmer rank (lexicographic), so the orders that begin with the same letters are an
interval of ranks. For each mask, the orders in which a document goes at step ``s`` are
such intervals, one per beginning of ``s`` letters of which only the last is in the mask:
its counts are added where the interval begins and taken off where it ends, and a running
sum over the 120 ranks gives all totals. The work on orders depends on the number of
parts, never on the number of documents.

Filters: A fewer than 50 words; B distinct words below 65 % of the words; C more than 5 %
of the code points are A to Z; D holds one of ``#$%&*|``; E the same text stands under a
smaller id anywhere in the table.

Defined cases: a null text is an empty one, which fails A, and E under any but the smallest
id; a null part is the empty one; a row without an id fails E never, is nobody's smaller
id and has no label; repeated rows count each (equal ids are not smaller); several labels
of one id count as good or toxic if one of them says so; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from hearthlog.llm.worker import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5

_MARKS = b"#$%&*|"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_ORDERS = ["".join(order) for order in permutations(FILTERS)]


def text_mask(text: str | None) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    text = text or ""
    data = text.encode()
    words = data.split()
    upper = len(data) - len(data.translate(None, _UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * len(text)) << 2
        | (len(data) != len(data.translate(None, _MARKS))) << 3
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = part.column("text").to_pylist()
        digests = [hashlib.sha256((t or "").encode()).digest() for t in texts]
        yield (
            part.drop_columns(["text"])
            .append_column("mask", pa.array(map(text_mask, texts), pa.int32()))
            .append_column("digest", pa.array(digests, pa.binary()))
        )


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Documents by part, mask, ``good`` and ``toxic``.

    No text is shuffled. Copies of a text, however many, are counted where they are read
    before their counts meet, so a hot text is one row per task; ids without a value are
    joined by their text and so spread.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), "text")
    fields = [f for f in rows.schema if f.name != "text"]
    fields += [T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())]
    judged = (
        rows.mapInArrow(_judge, T.StructType(fields))
        .groupBy("doc_id", "part", "mask", "digest")
        .agg(F.count("*").alias("n"))
    )
    marked = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.struct("doc_id", F.lit(None).cast("binary").alias("digest")).alias("__id"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("__good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("__toxic"),
        )
    )
    no_id = F.when(F.col("doc_id").isNull(), F.col("digest")).alias("digest")
    named = judged.withColumn("__id", F.struct("doc_id", no_id)).join(marked, "__id", "left")
    # Per text: how many rows have its smallest id in this part, and how many have none.
    by_text = (
        named.groupBy(
            "digest",
            "mask",
            "part",
            F.coalesce("__good", F.lit(0)).alias("good"),
            F.coalesce("__toxic", F.lit(0)).alias("toxic"),
            "doc_id",
        )
        .agg(F.sum("n").alias("n"))
        .groupBy("digest", "mask", "part", "good", "toxic")
        .agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
            F.sum("n").alias("n"),
        )
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    first_here = F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n"))
    spared = F.coalesce(first_here, F.lit(0)) + F.col("nameless")
    repeated = 1 << FILTERS.index("E")
    split = F.inline(
        F.array(
            F.struct(F.col("mask").alias("mask"), F.col("spared").alias("n")),
            F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
        )
    )
    return (
        by_text.withColumn("smallest", smallest)
        .withColumn("spared", spared)
        .select("part", "good", "toxic", split)
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """``(mask, step, first rank, end rank)`` of the orders in which a mask goes at a step.

    A beginning of ``step`` letters fixes the ranks from that of its smallest completion
    on, for as many orders as the letters left can make.
    """
    found = []
    size = len(filters)
    for step in range(1, size + 1):
        span = factorial(size - step)
        for number, beginning in enumerate(permutations(range(size), step)):
            before = sum(1 << i for i in beginning[:-1])
            for mask in range(1, 1 << size):
                if not mask & before and mask >> beginning[-1] & 1:
                    found.append((mask, step, number * span, (number + 1) * span))
    return found


def audit(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from ``mask_counts``.

    840 intervals of masks meet the counts; both sides are small, one by construction and
    the other by the number of parts.
    """
    totals = {
        "removed": F.col("n"),
        "good_lost": F.when(F.col("good") == 1, F.col("n")).otherwise(0),
        "toxic_lost": F.when(F.col("toxic") == 1, F.col("n")).otherwise(0),
    }
    by_mask = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(m) for m, c in totals.items()])
    spans = spark.createDataFrame(intervals(), "mask int, step int, lo int, hi int")
    ends = F.inline(
        F.array(
            F.struct(F.col("lo").alias("rank"), *totals),
            F.struct(F.col("hi").alias("rank"), *[(-F.col(m)).alias(m) for m in totals]),
        )
    )
    ranks, steps = F.sequence(F.lit(0), F.lit(len(_ORDERS) - 1)), F.sequence(F.lit(1), F.lit(5))
    zero = F.lit(0).cast("bigint")
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    grid = (
        parts.select("part", F.explode(steps).alias("step"))
        .select("part", "step", F.explode(ranks).alias("rank"))
        .select("*", *[zero.alias(m) for m in totals])
    )
    changes = (
        by_mask.join(F.broadcast(spans), "mask")
        .select("part", "step", ends)
        .where(F.col("rank") < len(_ORDERS))
        .unionByName(grid)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(m).alias(m) for m in totals])
    )
    along = Window.partitionBy("part", "step").orderBy("rank")
    running = changes.select("part", "step", "rank", *[F.sum(m).over(along).alias(m) for m in totals])

    orders = F.array(*[F.lit(order) for order in _ORDERS])
    bits = F.array(*[F.struct(F.lit(f).alias("letter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(FILTERS)])
    failing = (
        by_mask.select("part", "mask", "removed", F.inline(bits))
        .groupBy("part", "letter")
        .agg(
            F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("removed")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("mask") == F.col("bit"), F.col("removed")).otherwise(0)).alias("unique_fails"),
        )
    )
    in_order = Window.partitionBy("part", "rank").orderBy("step")
    return (
        running.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("gone", F.sum("removed").over(in_order))
        .withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
        .join(parts, "part")
        .join(failing, ["part", "letter"])
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("n") - F.col("gone")).alias("kept"),
            "removed",
            (F.col("fails") - F.col("removed")).alias("redundant"),
            "unique_fails",
            "good_lost",
            "toxic_lost",
            "shapley",
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of ``docs``: 600 rows per part."""
    return audit(docs.sparkSession, mask_counts(docs, labels, part))
