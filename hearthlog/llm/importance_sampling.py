"""Draw documents that look like a target text collection: importance resampling by n-grams.

A document's features are its runs of one to three words, hashed into a fixed number of
buckets. Over raw documents and target texts the buckets are counted; a bucket's gain is
the logarithm of how much more frequent it is in the target, and a document's weight the
sum of its features' gains. Adding Gumbel noise, which follows from the document's id,
and taking the highest scores draws without replacement in proportion to the weights.

Texts are handled as UTF-8 bytes: one 256-byte table lower-cases A to Z and blanks
separators, ``split`` yields the words, and the CRC-32 of a run is extended from that of
the run without its last word, so that no run is ever put together as a string. Counters
add the buckets up per task, Spark adds up the tasks.

Defined cases: null and empty texts have no words, weight 0, and are not drawn; an id that
is null draws the noise of the empty id; equal rows share their score and take ranks one
after the other, their order among themselves has no effect; fewer documents than a draw
needs give a draw of none; empty tables give an empty result, or, as a target, gains from
the raw counts alone; further columns are ignored.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthlog.llm.worker import park, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 5
SEED = 42
#: Words handled at once, so that a very long text takes bounded memory.
_CHUNK = 1 << 18

#: Lower-cases A to Z and turns every other ASCII character but letters and digits to a blank.
WORD_BYTES = bytes(
    c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    else c if c >= 128 or chr(c).isdigit() or chr(c).islower()
    else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def feature_buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of all runs of one to three words, in chunks."""
    for start in range(0, len(words), _CHUNK):
        part = words[start : start + _CHUNK + 2]
        own = min(len(part), _CHUNK)
        spaced = [b" " + word for word in part]
        single = list(map(crc32, part))
        pairs = list(map(crc32, spaced[1:], single))
        threes = list(map(crc32, spaced[2:], pairs))
        yield np.array(single[:own] + pairs[:own] + threes[:own], np.int64) % BUCKETS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[int] = Counter()
    for part in slices(batches, "text"):
        for text in part.column("text").to_pylist():
            for buckets in feature_buckets(words_of(text)):
                counts.update(buckets.tolist())
    yield pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())], ["bucket", "n"]
    )


def bucket_counts(docs: DataFrame) -> DataFrame:
    """``bucket, n`` of all texts: at most one row per bucket and task meets in the shuffle."""
    return (
        docs.select("text")
        .mapInArrow(_count, "bucket int, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )


def gains(raw: DataFrame, target: DataFrame) -> DataFrame:
    """The gain of every bucket, in thousandths of a nat."""
    spark = raw.sparkSession
    counts = (
        spark.range(BUCKETS)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(bucket_counts(raw).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target).withColumnRenamed("n", "t"), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    # Rows are buckets, whose number is fixed: the totals may meet in one task.
    everything = Window.partitionBy()
    counts = counts.withColumns(
        {"all_s": F.sum("s").over(everything), "all_t": F.sum("t").over(everything)}
    )
    ratio = F.expr(
        f"(t + 1d) * (all_s + {BUCKETS}d) / ((s + 1d) * (all_t + {BUCKETS}d))"
    )
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).cast("bigint").alias("gain"))


def _weigher(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sizes, features, weights = [], [], []
            for text in part.column("text").to_pylist():
                words = words_of(text)
                n = weight = 0
                for buckets in feature_buckets(words):
                    n += len(buckets)
                    weight += int(gain[buckets].sum())
                sizes.append(len(words))
                features.append(n)
                weights.append(weight)
            part = part.drop_columns(["text"])
            for name, values in (("n_words", sizes), ("n_features", features), ("weight", weights)):
                part = part.append_column(name, pa.array(values, pa.int64()))
            yield part

    return weigh


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row of ``docs``."""
    found = gains(docs, target).collect()  # BUCKETS rows, whatever the input
    gain = np.zeros(BUCKETS, np.int64)
    gain[[row.bucket for row in found]] = [row.gain for row in found]
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    weighed = rows.mapInArrow(
        _weigher(gain), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    )
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their place by score and id, no two in one place.

    Range-partitioned over the cluster and written; then places within a partition are
    added to the number of rows in the partitions before. Rows that tie in both columns
    are told apart by their number, or many of them would be one task's.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "__number"]
    numbered = rows.withColumn("__number", F.monotonically_increasing_id())
    sort = numbered.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    sort = park(sort, "ranking")
    sizes = sort.groupBy("__part").agg(F.count("*").alias("n"))
    # One row per partition of the sort, whose number the session fixes.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(*order)
    return (
        sort.withColumn("__place", F.row_number().over(within))
        .join(F.broadcast(offsets), "__part")
        .withColumn("__place", F.col("__before") + F.col("__place"))
        .drop("__part", "__number", "__before")
    )


def draw(weighed: DataFrame, percent: int = DRAW_PERCENT) -> DataFrame:
    """``weighed`` (``weights``) with ``rank``: 1, 2, 3... for the drawn rows, else null.

    Only rows that a mergeable quantile sketch leaves near or above the cut are sorted:
    its error is a hundredth of the margin, and with ties more rows are sorted, not fewer.
    """
    rows = park(weighed, "weights")
    able = F.col("n_words") >= MIN_WORDS
    n, least = rows.where(able).agg(
        F.count("*"), F.percentile_approx("score", 1 - (percent + 1) / 100, 10_000)
    ).first()
    high = able & (F.col("score") >= least) if n else F.lit(False)
    ranked = _ranked(rows.where(high))
    place = F.col("__place")
    rank = F.when(place <= percent * n // 100, place).cast("bigint").alias("rank")
    low = rows.where(~high).withColumn("rank", F.lit(None).cast("bigint"))
    return low.unionByName(ranked.select(*rows.columns, rank))


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``."""
    return draw(weights(docs, target))
