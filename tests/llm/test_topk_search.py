from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hearthlog.llm import topk_search
from hearthlog.llm.queries import op1_topk_search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, is_query, k=10):
    vectors = {
        (i, tuple(math.floor(1024 * x) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = set()
    for query, a in vectors:
        if is_query(query):
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), i)
                for i, b in vectors
                if i != query and len(a) == len(b)
            )
            out |= {(query, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def search(frame, every, k=10):
    found = topk_search.top_k(frame, F.col("vec_id") % every == 0, k)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark, small_tables):
    rows = spark.read.parquet(f"{small_tables}/embeddings.parquet").collect()
    found = {tuple(r) for r in op1_topk_search(spark, small_tables).collect()}
    assert found == brute([(r.vec_id, r.embedding) for r in rows], lambda i: i % 100 == 0)


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (20, 3)])
def test_lengths_ties_and_bad_vectors(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", blocks[0])
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(topk_search, "STEP", 7)
    draw = random.Random(3)
    rows = []
    for i in range(140):
        scale = draw.choice([0.01, 1, 30])
        rows.append((i, [draw.choice([-1.0, 0.0, 1.0, draw.gauss(0, 1)]) * scale for _ in range(6)]))
    rows += [(200 + i, [0.5] * 6) for i in range(30)]
    rows += [(300, None), (305, []), (310, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (315, [float("nan")] * 6),
             (320, [float("inf")] * 6), (325, [0.0] * 6), (None, [1.0] * 6), (330, [1.0, 2.0]),
             (331, [3.0, -2.0]), (335, [4.0]), rows[5], rows[5], rows[6]]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    frame = frame.withColumns({"norm": F.lit("x"), "block": F.lit(1)}).repartition(4)
    exact = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert search(frame, 5) == brute(exact, lambda i: i % 5 == 0)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [2.0**18 + i, -(2.0**18), i * 3.0], 0) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert search(frame, 4, 3) == brute([(r[0], r[1]) for r in rows], lambda i: i % 4 == 0, 3)


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert search(frame, 5) == set()
    assert search(spark.createDataFrame([(5, [1.0], 0)], SCHEMA), 5) == set()


def test_candidates_go_only_where_a_query_asks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 25)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 4)
    sent, plain = [], topk_search._search

    def search_blocks(queries, candidates, axes, k):
        sent.append((queries.count(), candidates.count()))
        return plain(queries, candidates, axes, k)

    monkeypatch.setattr(topk_search, "_search", search_blocks)
    draw = random.Random(7)
    rows = [(i, [draw.gauss(0, 1) + 5 for _ in range(4)]) for i in range(40)]
    rows += [(100 + i, [draw.gauss(0, 1) * 0.01 for _ in range(4)]) for i in range(400)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = topk_search.top_k(frame.where("vec_id < 100 or vec_id % 3 = 0"), F.col("vec_id") % 10 == 0, 3)
    exact = [(r.vec_id, r.embedding) for r in frame.collect() if r.vec_id < 100 or r.vec_id % 3 == 0]
    assert {tuple(r) for r in found.collect()} == brute(exact, lambda i: i % 10 == 0, 3)
    # Queries with long vectors beat every block of short ones, and only the others ask.
    assert sent[1][0] < 20 * sent[0][0] and sent[1][1] < 8 * 25 * sent[0][0] / 4

    sent.clear()
    topk_search.top_k(frame, F.col("vec_id").isin(0, 10, 20), 3).collect()
    assert sent[1][1] <= 25
