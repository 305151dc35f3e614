"""Features and draws against sums over joined strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from hearthlog.llm import importance_sampling
from hearthlog.llm.importance_sampling import feature_buckets, words_of


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(run.encode()) % 10_000 for run in runs]


def by_hand(docs, target):
    found = [(i, *features(text)) for i, text in docs]
    raw, aim = Counter(), Counter()
    for *_, buckets in found:
        raw.update(buckets)
    for text in target:
        aim.update(features(text)[1])
    s, t = sum(raw.values()), sum(aim.values())
    rows = []
    for doc_id, n, buckets in found:
        gains = [
            math.floor(1000 * math.log((aim[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000))))
            for b in buckets
        ]
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = sum(gains) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc_id, n, len(buckets), sum(gains), score))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[: 5 * len(able) // 100]
    ranks = [(*r, i) for i, r in enumerate(drawn, 1)]
    rest = Counter(rows) - Counter(drawn)
    return Counter(ranks) + Counter({(*r, None): n for r, n in rest.items()})


def resampled(spark, docs, target):
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    return Counter(tuple(r) for r in importance_sampling.resample(rows, aim).collect())


TARGET = ["The quick brown fox", "w1 w2 w3 w4", None, "", "Ünïcödé w7!"]


def mixed(n):
    return [(i, " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(5 + i % 60))) for i in range(n)]


def test_against_strings(spark):
    docs = mixed(700) + [
        (1000, None),
        (1001, ""),
        (1002, "--- ... \x7f"),
        (1003, "A-Z`a_z{0}9 ÄÖ x " * 9),
        (1004, "long " * 300_000),
        (None, "w1 w2 w3 " * 10),
        (1, "w1 w2 w3 " * 10),
    ]
    assert resampled(spark, docs, TARGET) == by_hand(docs, TARGET)


def test_equal_rows(spark):
    docs = [(5, "w1 w2 w3 w4 " * 6)] * 300 + mixed(100)
    assert resampled(spark, docs, TARGET) == by_hand(docs, TARGET)


def test_ties_go_to_the_smaller_id(spark):
    aim = spark.createDataFrame([("x",)], "text string")
    weighed = importance_sampling.weights(spark.createDataFrame(mixed(400), "doc_id bigint, text string"), aim)
    from pyspark.sql import functions as F

    able = [i for i, text in mixed(400) if len(text.split()) >= 20]
    drawn = importance_sampling.draw(weighed.withColumn("score", F.lit(7))).where("rank IS NOT NULL")
    n = 5 * len(able) // 100
    assert sorted((r["rank"], r.doc_id) for r in drawn.collect()) == list(enumerate(sorted(able)[:n], 1))


def test_empty_tables(spark):
    assert not resampled(spark, [], TARGET)
    docs = mixed(50)
    assert resampled(spark, docs, []) == by_hand(docs, [])


def test_further_columns_are_ignored(spark):
    docs = spark.createDataFrame(
        [("a", "w1 w2", 1, 2, 3)], "doc_id string, text string, weight int, rank int, score int"
    )
    rows = importance_sampling.resample(docs, docs).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in rows] == [("a", 3, None)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7])
def test_chunks(monkeypatch, n):
    monkeypatch.setattr(importance_sampling, "_CHUNK", 2)
    words = words_of(" ".join(f"w{i}" for i in range(n)))
    found = [b for chunk in feature_buckets(words) for b in chunk.tolist()]
    assert sorted(found) == sorted(features(" ".join(f"w{i}" for i in range(n)))[1])
