from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from hearthlog.llm import jaccard_join
from hearthlog.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(text or "")
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """Class and number of links by id; ids are unique or their rows equal."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = {i: 0 for i, _ in rows}
    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets):
            if x != y and a and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                one, other = sorted((root(i), root(j)))
                parent[other] = one
    counts = {i: links[i] // sum(1 for k, _ in rows if k == i) for i in links}
    return {i: (root(i), counts[i]) for i in parent}


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return words


def family(draw):
    rows, number = [], 0
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([6, 40, 120]))]
        for _ in range(draw.randrange(1, 9)):
            rows.append((number, " ".join(edited(draw, base, draw.randrange(0, 4)))))
            number += draw.randrange(1, 3)
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_links_and_classes_equal_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = family(random.Random(block))
    rows += [(5000, "a b c"), (5001, "a  b\nc"), (5002, "a b"), (5003, None), (5004, ""), (5005, " \n")]
    rows += [(6000, "same " * 30), (6001, "same " * 31), rows[3], rows[3]]
    docs = docs_of(*rows).withColumns({"class_id": F.lit("x"), "id": F.lit(1)})
    found = jaccard_join.similar_documents(docs).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in found}
    want = brute(rows)
    copies = sum(1 for r in rows if r == rows[3])
    assert got.pop(rows[3][0])[0] == want.pop(rows[3][0])[0] and copies == 3
    assert got == want


def test_given_documents(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = jaccard_join.similar_documents(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(rows)


def test_one_of_each_class_stays(spark, docs_of, edge_docs):
    rows = family(random.Random(9))
    docs = docs_of(*rows, rows[0], (None, "lone"), (None, "lone"))
    kept = jaccard_join.one_of_each_class(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for c, _ in brute(rows).values()})
    assert ids.count(None) == 2
    jaccard_join.one_of_each_class(edge_docs).collect()
    empty = docs.where("false")
    assert jaccard_join.similar_documents(empty).collect() == []
    assert jaccard_join.one_of_each_class(empty).collect() == []


def test_prefixes_shorten_to_the_recall():
    used = jaccard_join.depths()
    assert used[0] == jaccard_join.DEPTH
    assert jaccard_join.recall(used[-1]) >= jaccard_join.TARGET_RECALL
    assert all(jaccard_join.recall(d) < jaccard_join.TARGET_RECALL for d in used[:-1])


def test_components(spark):
    draw = random.Random(4)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a != b:
            one, other = sorted((root(a), root(b)))
            parent[other] = one
    found = [(r.node, r.component) for r in components(frame).collect()]
    assert len(found) == len(dict(found))
    assert dict(found) == {i: root(i) for i in list(parent)}
    assert components(frame.where("false")).collect() == []


def test_texts_that_share_an_id_are_judged_apart(docs_of):
    one, two, three = (" ".join(f"{u}{i}" for i in range(200)) for u in "abc")
    docs = docs_of((7, one), (7, two), (3, two + " more"), (8, three), (8, three.replace(" ", "  ")),
                   (9, three + " end"), (None, one), (5, None), (5, " "))
    kept = jaccard_join.one_of_each_class(docs).collect()
    found = sorted((r.doc_id or 0, " ".join((r.text or "").split())) for r in kept)
    assert found == sorted([(7, one), (3, two + " more"), (8, three), (0, one), (5, "")])


def test_ids_of_another_type(spark):
    one, two = (" ".join(f"{u}{i}" for i in range(60)) for u in "ab")
    rows = [("y", one), ("x", one + " more"), ("z", two), ("x", two), (None, one), ("w", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = sorted((r.doc_id or "", r.class_id or "", r.n_links) for r in jaccard_join.similar_documents(docs).collect())
    assert found == [("", "", 0), ("w", "w", 0), ("x", "x", 1), ("x", "x", 1), ("y", "x", 1), ("z", "x", 1)]
    kept = sorted((r.doc_id or "", r.text or "") for r in jaccard_join.one_of_each_class(docs).collect())
    assert kept == [("", one), ("w", ""), ("x", one + " more"), ("x", two)]


def test_blocks_are_cut_by_bytes(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 2000)
    rows = family(random.Random(11))
    found = jaccard_join.similar_documents(docs_of(*rows)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(rows)
