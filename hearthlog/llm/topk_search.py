"""Exact top-k inner products: vectors by descending length, rotated, with residual bounds.

Components are integers, floor(1024 * x). All vectors are rotated to the axes of their
second-moment matrix (its SVD), so that the first axes carry most of a product. Blocks of
candidates hold vectors of similar length, longest first. Within a block, a query's
product with a candidate is at most the partial sum over the first axes plus the product
of the residuals' lengths (Cauchy and Schwarz); what cannot reach the query's k-th best
score so far is passed over, and a whole rest is when length alone rules it out. All that
remain are scored exactly, in integers.

The query set is dealt to blocks too, so a task holds one block of queries and one of
candidates, whatever the sizes of both. A first round against the longest candidates
gives every query a score to beat. For the second the queries are dealt by the length
that a candidate needs to reach that score, so that most blocks of queries ask only the
first blocks of candidates, and a block that none asks is not shuffled at all.

Defined cases: a vector that is null, empty or holds a null or non-finite component takes
no part; vectors of different dimensions are not compared; ``vec_id`` names a row, so a
query is compared with no row of its own id, and repeated rows of one id and vector are
one; ties go to the smaller id; an empty table gives an empty result. A product beyond 64
bits is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthlog.llm.worker import group_starts, park, whole_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
#: Rows of a block of candidates and of queries: a task holds one of each.
CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 1_024
#: Candidates bounded together.
STEP = 2_048
#: Share of the axes in the partial sums.
LEADING = 0.5
#: Products below this are exact in double precision.
_EXACT = 2.0**52

_FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows (``vec_id``, ``dim``, ``ints``, ``norm``) of the vectors that take part."""
    x = F.col(column)
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))
    )
    ints = F.transform(x, lambda v: F.floor(SCALE * v.cast("double")).cast("double"))
    squares = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v * v)
    return (
        vectors.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite)
        .select("vec_id", F.size(x).alias("dim"), ints.alias("ints"))
        .withColumn("norm", F.sqrt(squares))
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of products of components: one row per dimension and axis."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            rows = _matrix(batch.column("ints").filter(pa.array(dims == dim)))
            sums[int(dim)] = sums.get(int(dim), 0) + rows.T @ rows
    for dim, total in sums.items():
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array([dim] * dim, pa.int32()),
                "axis": pa.array(range(dim), pa.int32()),
                "sums": pa.array(list(total), pa.list_(pa.float64())),
            }
        )


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """An orthogonal matrix per dimension: axes by descending second moment.

    One dimension squared numbers come to the driver. Any rotation gives the same result;
    this one lets the bounds prune early.
    """
    rows = vectors.mapInArrow(_moments, "dim int, axis int, sums array<double>")
    cells = (
        rows.select("dim", "axis", F.posexplode("sums").alias("other", "product"))
        .groupBy("dim", "axis", "other")
        .agg(F.sum("product").alias("product"))
        .groupBy("dim", "axis")
        .agg(F.sort_array(F.collect_list(F.struct("other", "product"))).alias("row"))
    )
    moments: dict[int, np.ndarray] = {}
    for row in cells.collect():
        moments.setdefault(row.dim, np.zeros((row.dim, row.dim)))[row.axis] = [
            cell.product for cell in row.row
        ]
    return {dim: np.linalg.svd(m / max(np.abs(m).max(), 1.0))[0] for dim, m in moments.items()}


class Best:
    """The k best candidates of each query of a block so far."""

    def __init__(self, ids: np.ndarray, k: int, beat: np.ndarray) -> None:
        self.ids, self.k, self.beat = ids, k, beat.copy()
        self.scores: list[list[tuple[int, int]]] = [[] for _ in ids]

    def offer(self, query: int, found: list[tuple[int, int]]) -> None:
        """Take (-score, id) pairs, smallest first."""
        best = sorted(self.scores[query] + found)[: self.k]
        self.scores[query] = best
        if len(best) == self.k:
            self.beat[query] = max(self.beat[query], -best[-1][0])


def search_block(
    queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, best: Best, axes: np.ndarray
) -> None:
    """Offer every candidate that may be among a query's best. Candidates: longest first."""
    lead = max(1, int(np.ceil(LEADING * queries.shape[1])))
    turned_q, turned_c = queries @ axes, candidates @ axes
    rest_q = np.linalg.norm(turned_q[:, lead:], axis=1)
    rest_c = np.linalg.norm(turned_c[:, lead:], axis=1)
    length_q, length_c = np.linalg.norm(queries, axis=1), np.linalg.norm(candidates, axis=1)
    for start in range(0, len(candidates), STEP):
        part = slice(start, start + STEP)
        # Rounding of sums in double precision, generously.
        slack = 1.0 + 1e-9 * length_q * length_c[start]
        alive = np.flatnonzero(length_q * length_c[start] + slack >= best.beat)
        if not len(alive):
            return
        bound = turned_q[alive, :lead] @ turned_c[part, :lead].T
        bound += np.outer(rest_q[alive], rest_c[part])
        may = bound >= (best.beat - slack)[alive, None]
        for row, query in enumerate(alive):
            picked = np.flatnonzero(may[row]) + start
            picked = picked[ids[picked] != best.ids[query]]
            if len(picked):
                best.offer(query, _top(queries[query], candidates, ids, picked, best, query))


def _top(query, candidates, ids, picked, best: Best, row: int) -> list[tuple[int, int]]:
    """Exact scores of picked candidates: the k best as (-score, id)."""
    rows = candidates[picked]
    if float((np.abs(rows) @ np.abs(query)).max()) < _EXACT:
        scores = np.rint(rows @ query).astype(np.int64)
        order = np.lexsort((ids[picked], -scores))[: best.k]
        return [(-int(scores[i]), int(ids[picked[i]])) for i in order]
    whole = [int(v) for v in query]
    scored = [(-sum(int(a) * b for a, b in zip(r, whole)), int(ids[p])) for r, p in zip(rows, picked)]
    return sorted(scored)[: best.k]


def _searcher(k: int, axes):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = axes.value
        for table in whole_groups(batches, "cell", min_rows=1):
            cells = table.column("cell").to_numpy()
            edges = group_starts(cells).tolist()
            for first, end in zip(edges, edges[1:]):
                cell = table.slice(first, end - first)
                is_query = cell.column("is_query").combine_chunks()
                asked = cell.filter(is_query)
                offered = cell.filter(pc.invert(is_query))
                if not asked.num_rows or not offered.num_rows:
                    continue
                query_ids, queries, beat = _distinct(asked)
                ids, candidates, _ = _distinct(offered)
                best = Best(query_ids, k, beat)
                search_block(queries, candidates, ids, best, turn[queries.shape[1]])
                found = [
                    (int(query_ids[i]), id_, -minus)
                    for i, own in enumerate(best.scores)
                    for minus, id_ in own
                ]
                columns = zip(*found) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return search


def _distinct(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and scores to beat, longest first, repeated rows once."""
    keys = [("norm", "descending"), ("vec_id", "ascending")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys))
    ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("ints"))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
    return ids[new], vectors[new], rows.column("beat").to_numpy()[new]


def _search(queries: DataFrame, candidates: DataFrame, axes, k: int) -> DataFrame:
    """Search blocks of queries against blocks of candidates.

    ``asks`` numbers a block of queries and ``block`` one of candidates; both sides come
    once for each pair of blocks that are to meet.
    """
    common = ["dim", "vec_id", "ints", "norm"]

    def sent(rows: DataFrame, is_query: bool, beat: Column) -> DataFrame:
        return rows.select(
            F.xxhash64("dim", "asks", "block").alias("cell"),
            *common,
            F.lit(is_query).alias("is_query"),
            beat.alias("beat"),
        )

    rows = sent(queries, True, F.col("beat")).unionByName(sent(candidates, False, F.lit(0.0)))
    dealt = rows.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_searcher(k, axes), _FOUND)


def _cells(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pairs (``dim``, ``asks``, ``block``) in which a query may better its score.

    Length decides: of a block of queries the least ``reach`` counts, of a block of
    candidates the longest vector. Both tables have one small row per block.
    """
    least = queries.groupBy("dim", "asks").agg(F.min("reach").alias("least"))
    longest = blocks.groupBy("dim", "block").agg(F.max("norm").alias("longest"))
    return least.join(longest, "dim").where(F.col("longest") >= F.col("least")).select(
        "dim", "asks", "block"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; every task cuts its own rows back to k before they meet."""
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k best.

    ``is_query`` is a condition on ``vec_id``. The number of blocks follows the number of
    rows; vectors of one length are told apart by their ids, so no block outgrows its size.
    """
    spark = vectors.sparkSession
    ints = park(integer_vectors(vectors, column), "search-vectors")
    total = ints.count()
    ranged = ints.repartitionByRange(
        max(1, -(-total // CANDIDATE_BLOCK)), "dim", F.desc("norm"), "vec_id"
    )
    rows = park(ranged.withColumn("block", F.spark_partition_id()), "search-blocks")
    axes = spark.sparkContext.broadcast(rotations(ints))
    queries = ints.where(is_query)
    ask_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asks = F.pmod(F.xxhash64("vec_id"), F.lit(ask_blocks)).cast("int")
    # First round: the block with the longest vectors of each dimension.
    heads = rows.groupBy("dim").agg(F.min("block").alias("head"))
    headed = rows.join(heads, "dim")
    anywhere = F.lit(float("-inf"))
    every = F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1)))
    first = park(
        _search(
            queries.withColumns({"beat": anywhere, "block": F.lit(0), "asks": asks}),
            headed.where("block = head").withColumn("block", F.lit(0)).withColumn("asks", every),
            axes,
            k,
        ),
        "search-first",
    )
    beat = _ranked(first, k).where(F.col("rank") == k)
    beat = beat.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("beat"))
    beaten = queries.join(beat, "vec_id", "left").withColumn("beat", F.coalesce("beat", anywhere))
    # The length that a candidate needs, with room for rounding; a vector of length 0 scores 0.
    needed = (F.col("beat") - 1) / (F.col("norm") * (1 + 1e-9))
    never = F.when(F.col("beat") > 1, F.lit(float("inf"))).otherwise(anywhere)
    reach = F.when(F.col("norm") > 0, needed).otherwise(never)
    dealt = beaten.withColumn("reach", reach).repartitionByRange(ask_blocks, "dim", "reach", "vec_id")
    again = park(dealt.withColumn("asks", F.spark_partition_id()), "search-queries")
    others = headed.where("block > head").drop("head")
    cells = park(_cells(again, others), "search-cells")
    rest = _search(
        again.join(cells, ["dim", "asks"]), others.join(cells, ["dim", "block"]), axes, k
    )
    return _ranked(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
