from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlog.llm import byte_repeats, sequences, window_counts
from hearthlog.llm.queries import op4_byte_repeats


def brute(texts, size=200):
    data = [(t or "").encode() for t in texts]
    strings = Counter(hash(d[i : i + size]) for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - size + 1):
            if strings[hash(d[i : i + size])] > 1:
                gone[i : i + size] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, sha256(kept).hexdigest(), kept))
    return out


def passages(seed):
    draw = random.Random(seed)

    def text(n):
        return "".join(draw.choice("abcdé \n") for _ in range(n))

    shared = [text(draw.choice([120, 180, 195, 200, 205, 400, 900])) for _ in range(9)]
    rows = []
    for i in range(50):
        parts = []
        for _ in range(draw.randrange(0, 6)):
            part = draw.choice(shared) if draw.random() < 0.6 else text(draw.randrange(1, 250))
            parts.append(part[draw.randrange(0, 9) :])
        rows.append((i, "".join(parts)))
    rows += [(100, "a" * 199), (101, "a" * 200), (102, "a" * 201), (103, "ab" * 150), (104, "xyz" * 100)]
    rows += [(110, "é" * 100), (111, "é" * 101), (112, shared[6] + "!"), (113, "?" + shared[6])]
    return rows


@pytest.mark.parametrize("limit", [sequences.CHUNK_VALUES, 523])
def test_removal_equals_brute_force(docs_of, edge_docs, monkeypatch, limit):
    plain = sequences.chunks
    monkeypatch.setattr(byte_repeats, "chunks", lambda found, size, most: plain(found, size, limit))
    if limit < 1000:
        whole = byte_repeats.slices
        monkeypatch.setattr(byte_repeats, "slices", lambda b, column, most=0: whole(b, column, 300))
    rows = passages(limit)
    docs = docs_of(*rows, rows[7], rows[7]).unionByName(edge_docs.where("doc_id < 10"))
    docs = docs.withColumns({"n_bytes": F.lit("x"), "bucket": F.lit(1), "start": F.lit(2)})
    found = byte_repeats.without_repeats(docs).collect()
    assert len(found) == docs.count()
    want = brute([r.text for r in found])
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in found]
    assert got == want
    assert sum(w[1] for w in want) > 5000


@pytest.mark.parametrize("most", [0, 8])
def test_hot_buckets_equal_brute_force(docs_of, monkeypatch, most):
    monkeypatch.setattr(window_counts, "HOT_ROWS", most)
    monkeypatch.setattr(window_counts, "SAMPLE", 1)
    spread, plain = [], window_counts._hot_windows
    monkeypatch.setattr(window_counts, "_hot_windows", lambda *a: spread.append(1) or plain(*a))
    draw = random.Random(4)
    phrase = "".join(draw.choice("abcdefgh") for _ in range(185))
    around = [(200 + i, f"{i:04}" * 20 + phrase + f"{i:05}" * 20) for i in range(120)]
    docs = docs_of(*around, (400, around[3][1] + "!"), *passages(3))
    found = byte_repeats.without_repeats(docs).collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in found]
    assert got == brute([r.text for r in found])
    assert spread


def test_query_equals_brute_force(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").collect()
    rows = {r.doc_id: r for r in op4_byte_repeats(spark, small_tables).collect()}
    assert len(rows) == len(docs)
    for doc, want in zip(docs, brute([d.text for d in docs])):
        row = rows[doc.doc_id]
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == want[:4]


def test_long_texts_and_empty_tables(docs_of):
    draw = random.Random(2)
    long = "".join(draw.choice("abcdefgh") for _ in range(2_500_000))
    docs = docs_of((1, long), (2, long[1_048_000:1_049_500]), (3, None))
    rows = {r.doc_id: r for r in byte_repeats.without_repeats(docs, keep_bytes=False).collect()}
    assert [(rows[i].n_removed, rows[i].n_spans, rows[i].kept) for i in (1, 2, 3)] == [
        (1500, 1, None), (1500, 1, None), (0, 0, None)
    ]
    assert byte_repeats.without_repeats(docs.where("false")).collect() == []


@pytest.mark.parametrize("most", [0, 4, 60])
def test_hot_digits_equal_brute_force(docs_of, monkeypatch, most):
    """A phrase shorter than a window in most texts, and rows that are equal."""
    monkeypatch.setattr(byte_repeats, "HOT_ROWS", most)
    monkeypatch.setattr(byte_repeats, "SAMPLE", 1)
    monkeypatch.setattr(byte_repeats, "CHUNK_BYTES", 2000)
    draw = random.Random(most)
    phrase = "".join(draw.choice("abcdefgh ") for _ in range(150))

    def around(i):
        return f"{i} before {i * 7919} " * 6 + phrase + f" {i} after {i * 104729}" * 6

    rows = [(i, around(i)) for i in range(60)] + [(200 + i, around(3)) for i in range(20)]
    rows += [(None, around(i)) for i in range(0, 60, 9)] + passages(most)[:25]
    docs = docs_of(*rows)
    found = byte_repeats.without_repeats(docs).collect()
    want = brute([t for _, t in rows])
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept or b"") for r in found)
    assert got == sorted(want)


def test_many_equal_rows(docs_of):
    """What a row is told does not grow with the rows that equal it."""
    text = " ".join(f"w{i}" for i in range(120))
    docs = docs_of(*[(7, text)] * 3000, (8, text[:400]), (9, "short"))
    found = byte_repeats.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_removed) for r in found) == {(7, len(text)): 3000, (8, 400): 1, (9, 0): 1}
