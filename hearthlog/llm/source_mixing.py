"""Mixing sources to target weights: weighted fair queueing, in DataFrame operations.

A source's documents queue in a shuffled order, twice over. A document's virtual finish
time is the number of the source's words up to its end, divided by the source's weight:
served in the order of these times, all sources progress by their weights, and one that
has been taken twice leaves its share to the others. The virtual time at which the total
budget is spent follows from the sources' sizes and weights: a source has then been served
its target. What is served by then is taken, the document that a source has in service is
cut after its words, and the mix is sorted by virtual finish time over the whole cluster.
So every source meets its target to the word, where cutting the sorted queue between
documents would miss it by up to a document each.

Defined cases: a null or empty text has no words and is never taken; null is a source,
the last one; repeated rows queue one after the other; the shuffle is the MD5 of a seed,
the document's id (null: empty) and its text's MD5, so reruns agree and rows that share an
id, or have none, spread; an empty table gives an empty result; further columns play no
part in the queue and pass through the mix.

A source may hold most rows: running sums are taken within 4,096 slices of its queue, and
only the slices' sums are added up per source. Ids and sizes queue, texts do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthlog.llm.worker import park

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
PASSES = 2
WORD = r"[^\x20\x09-\x0D]+"

#: Hexadecimal digits of a slice's number: 4,096 slices of a source's queue. They are what
#: one task adds up per source; a slice of it holds ids and sizes, and is sorted with spills.
SLICE_DIGITS = 3


def _targets(sizes: DataFrame, weights: tuple[int, ...], percent: int) -> DataFrame:
    """Weight and target per source, from one row per source (``__source``, ``source_size``).

    The queues are served up to the virtual time at which the budget is spent. Sources
    are filled up in the order in which they run out; the first that need not run out
    tells the time.
    """
    position = F.row_number().over(Window.orderBy(F.asc_nulls_last("__source")))
    picked = F.array(*map(F.lit, weights))
    weighed = sizes.withColumn("__rank", position).withColumn(
        "__weight", F.element_at(picked, (F.col("__rank") - 1) % len(weights) + 1)
    )
    cap = PASSES * F.col("source_size")
    out = weighed.withColumn("__cap", cap).withColumn("__ends", cap / F.col("__weight"))
    by_end = Window.orderBy("__ends", "__rank")
    before = by_end.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_end.rowsBetween(0, Window.unboundedFollowing)
    whole = by_end.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * percent / 100
    level = (budget - F.coalesce(F.sum("__cap").over(before), F.lit(0))) / F.sum("__weight").over(onward)
    levels = out.withColumn("__level", level)
    first = F.min(F.when(F.col("__level") <= F.col("__ends"), F.struct("__ends", "__rank", "__level"))).over(whole)
    time = first["__level"]
    return levels.select(
        "__source",
        "source_size",
        "__weight",
        F.least(F.col("__cap").cast("double"), F.col("__weight") * time).alias("target"),
    )


def _named(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with ``__order``, a row's place in the shuffle: alike for equal rows only."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.md5(F.coalesce("text", F.lit("")))
    return docs.withColumn("__order", F.md5(F.concat_ws(":", F.lit(seed), name, text)))


def _sizes(docs: DataFrame, seed: int) -> DataFrame:
    """``doc_id, source, size`` and ``__order``: all that is queued. Texts are read once."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = _named(docs, seed).select("doc_id", "source", words.alias("size"), "__order")
    return park(rows, "mixing-sizes")


def queue(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    seed: int = 0,
) -> DataFrame:
    """Every document twice (``copy`` 1 and 2), with its virtual finish time.

    ``words`` is what the mix takes of a copy, ``taken`` what it takes of both. Of the
    documents' own columns ``doc_id`` and ``source`` are left.
    """
    return _queued(_sizes(docs, seed), weights, budget_percent).drop("__order")


def _queued(sizes: DataFrame, weights: tuple[int, ...], budget_percent: int) -> DataFrame:
    rows = sizes.withColumn("__slice", F.substring("__order", 1, SLICE_DIGITS))
    slices = (
        rows.groupBy(F.col("source").alias("__source"), F.col("__slice").alias("__part"))
        .agg(F.sum("size").alias("__words"))
    )
    along = Window.partitionBy("__source").orderBy("__part")
    earlier = F.sum("__words").over(along.rowsBetween(Window.unboundedPreceding, -1))
    offsets = slices.withColumn("__earlier", F.coalesce(earlier, F.lit(0)))
    of_sources = slices.groupBy("__source").agg(F.sum("__words").alias("source_size"))
    targets = _targets(of_sources, weights, budget_percent).withColumnRenamed("__source", "__of")
    offsets = offsets.join(targets, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of", "__words")
    within = (
        Window.partitionBy("source", "__slice")
        .orderBy("__order", "size", "doc_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    timed = rows.withColumn("__upto", F.sum("size").over(within)).join(
        offsets,
        F.col("source").eqNullSafe(F.col("__source")) & (F.col("__slice") == F.col("__part")),
    )
    upto = F.col("__upto") + F.col("__earlier")
    served = F.floor("target")

    def words(copy: int) -> Column:
        start = upto - F.col("size") + (copy - 1) * F.col("source_size")
        return F.greatest(F.lit(0), F.least(F.col("size"), served - start))

    def entry(copy: int) -> Column:
        return F.struct(
            F.lit(copy).alias("copy"),
            ((upto + (copy - 1) * F.col("source_size")) / F.col("__weight")).alias("virtual_finish"),
            words(copy).alias("words"),
        )

    copies = range(1, PASSES + 1)
    return timed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        sum((words(c) for c in copies), F.lit(0)).cast("bigint").alias("taken"),
        "__order",
        F.inline(F.array(*map(entry, copies))),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    seed: int = 0,
) -> DataFrame:
    """The mixed documents with their own columns, whole or cut after the words taken.

    They are sorted by virtual finish time over the whole cluster. Only what is taken
    meets its text again, once. ``n_chars``, if there is one, follows the text; rows that
    are equal in id and text bring the further columns of one of them.
    """
    sizes = _sizes(docs, seed)
    taken = _queued(sizes, weights, budget_percent).where(F.col("words") > 0)
    taken = taken.select("__order", "virtual_finish", F.col("size").alias("__size"), "words")
    texts = _named(docs, seed)
    again = park(
        sizes.groupBy("__order").agg(F.count("*").alias("n")).where("n > 1").select("__order"),
        "mixing-again",
    )
    if not again.isEmpty():
        marked = texts.join(again.withColumn("__again", F.lit(True)), "__order", "left")
        once = marked.where("__again").dropDuplicates(["__order"])
        texts = marked.where("__again is null").unionByName(once).drop("__again")
    # Names of the queue's columns may be names of the documents', too.
    names = ("virtual_finish", "words")
    taken = taken.select("__order", "__size", *[F.col(c).alias(f"__{c}") for c in names])
    words = F.col("__words").cast("int")
    first_words = F.array_join(
        F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, words), " "
    )
    whole = F.col("__words") >= F.col("__size")
    mixed = texts.join(taken, "__order").withColumn(
        "text", F.when(whole, F.col("text")).otherwise(first_words)
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        mixed = mixed.withColumn("n_chars", F.length("text").cast(kind))
    by = ["__virtual_finish", "source", "__order", "__size"]
    sort = mixed.repartitionByRange(*by).sortWithinPartitions(*by)
    return sort.select(*docs.columns)
