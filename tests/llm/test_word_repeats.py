from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlog.llm import sequences, window_counts, word_repeats
from hearthlog.llm.queries import op2_word_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, size=35):
    split = [WORD.findall(t or "") for t in texts]
    windows = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - size + 1):
            if windows[tuple(words[i : i + size])] > 1:
                gone |= set(range(i, i + size))
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def passages(seed, unit="w"):
    draw = random.Random(seed)
    shared = [[f"{unit}{draw.randrange(900)}" for _ in range(draw.choice([30, 35, 36, 60, 150]))] for _ in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(draw.randrange(0, 6)):
            if draw.random() < 0.5:
                part = draw.choice(shared)
                cut = draw.randrange(0, 12)
                words += part[cut : len(part) - draw.randrange(0, 12)]
            else:
                words += [f"{unit}{draw.randrange(900)}" for _ in range(draw.randrange(1, 50))]
        rows.append((i, draw.choice([" ", "  ", "\n"]).join(words)))
    rows += [(100, "again " * 34), (101, "again " * 35), (102, "again " * 36), (103, "a b " * 60), (104, "é " * 300)]
    return rows


@pytest.mark.parametrize("limit", [sequences.CHUNK_VALUES, 97])
def test_removal_equals_brute_force(docs_of, edge_docs, monkeypatch, limit):
    plain = sequences.chunks
    monkeypatch.setattr(word_repeats, "chunks", lambda found, size, most: plain(found, size, limit))
    if limit < 1000:
        whole = word_repeats.slices
        monkeypatch.setattr(word_repeats, "slices", lambda b, column, most=0: whole(b, column, 300))
    rows = passages(limit)
    docs = docs_of(*rows, rows[7], rows[7]).unionByName(edge_docs)
    docs = docs.withColumns({"n_words": F.lit("x"), "bucket": F.lit(1), "start": F.lit(2)})
    found = word_repeats.without_repeats(docs).collect()
    assert len(found) == docs.count()
    want = brute([r.text for r in found])
    assert [(r.n_words, r.n_removed, r.kept_text) for r in found] == want
    assert sum(w[1] for w in want) > 500


@pytest.mark.parametrize("most", [0, 20])
def test_hot_buckets_are_spread_by_their_windows(docs_of, monkeypatch, most):
    monkeypatch.setattr(window_counts, "HOT_ROWS", most)
    monkeypatch.setattr(window_counts, "SAMPLE", 1)
    plain, largest = window_counts._by_bucket, []

    def by_bucket(rows, key):
        sizes = rows.where("hashes is not null").groupBy("bucket").count()
        largest.append(sizes.agg(F.max("count")).first()[0] or 0)
        return plain(rows, key)

    monkeypatch.setattr(window_counts, "_by_bucket", by_bucket)
    phrase = " ".join(f"p{i}" for i in range(30))
    around = [(200 + i, " ".join([f"a{i}x{j}" for j in range(20)] + [phrase] + [f"b{i}x{j}" for j in range(20)]))
              for i in range(150)]
    copies = [(400, around[3][1] + " more"), (401, around[5][1])]
    docs = docs_of(*around, *copies, *passages(3))
    found = word_repeats.without_repeats(docs).collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in found] == brute([r.text for r in found])
    assert max(largest) <= most


def test_query_equals_brute_force(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").collect()
    rows = {r.doc_id: r for r in op2_word_repeats(spark, small_tables).collect()}
    assert len(rows) == len(docs)
    for doc, (n_words, n_removed, kept) in zip(docs, brute([d.text for d in docs])):
        row = rows[doc.doc_id]
        assert (row.n_words, row.n_removed) == (n_words, n_removed)
        assert row.kept_sha256 == sha256(kept.encode()).hexdigest()


def test_paths_end_at_branches(docs_of):
    words = [f"p{i}" for i in range(80)]
    docs = docs_of(
        (1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words[:60] + [f"q{i}" for i in range(20)]))
    )
    paths = word_repeats.repeated_paths(docs).where("path >= 0").collect()
    assert {p.doc_id for p in paths} <= {1, 2, 3}
    # Edge 25 is the last that all three have: no path goes on beyond it.
    assert all(p.start + p.n <= 26 or p.start > 25 for p in paths)
    assert word_repeats.without_repeats(docs.where("false")).collect() == []


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    text = "eins zwei  drei\tünf\n" * 50 + "x" * 300 + " end"
    whole = sequences.word_hashes(text.encode())
    assert len(whole) == len(WORD.findall(text))
    for size in (1, 7, 64, 301):
        monkeypatch.setattr(sequences, "_CHUNK", size)
        assert np.array_equal(sequences.word_hashes(text.encode()), whole)


def test_many_equal_rows(docs_of):
    """What a row is told does not grow with the rows that equal it, whatever their id."""
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(7, text)] * 3000 + [(None, text)] * 500 + [(8, "w3 " + text), (9, "w1 w2")]
    found = word_repeats.without_repeats(docs_of(*rows)).collect()
    counts = {}
    for r in found:
        counts[r.doc_id, r.n_removed] = counts.get((r.doc_id, r.n_removed), 0) + 1
    assert counts == {(7, 200): 3000, (None, 200): 500, (8, 200): 1, (9, 0): 1}


def test_many_texts_without_an_id(docs_of):
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(3000)]
    rows += [(None, rows[5][1] + " more")]
    found = word_repeats.without_repeats(docs_of(*rows)).collect()
    assert sorted(r.n_removed for r in found if r.n_removed) == [40, 40]
