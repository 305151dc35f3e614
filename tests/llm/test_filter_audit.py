"""The audit against filters applied one after the other, in every order."""

from __future__ import annotations

from itertools import permutations

import pytest

from hearthlog.llm import filter_audit
from hearthlog.llm.filter_audit import FILTERS, intervals

WORDS = " ".join(f"w{i}" for i in range(60))


def by_hand(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    texts = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            texts[text or ""] = min(doc_id, texts.get(text or "", doc_id))

    def fails(doc_id, text):
        text = text or ""
        words = text.split(" ") if text.strip() else []
        words = [w for w in " ".join(text.split("\n")).replace("\t", " ").split(" ") if w]
        return {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and texts[text] < doc_id,
        }

    good = {i for i, quality, _ in labels if quality == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    rows = {}
    for part in {source or "" for *_, source in docs}:
        here = [(i, fails(i, text)) for i, text, source in docs if (source or "") == part]
        removed_by = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = here
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                removed_by[letter] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f[letter] for _, f in here) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in here),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for order in permutations(FILTERS):
            for step, letter in enumerate(order, 1):
                rows[part, "".join(order), step].append(removed_by[letter])
    return rows


def audited(spark, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = filter_audit.filter_audit(docs.repartition(3), labels).collect()
    keys = [(r.part, r.filter_order, r.step) for r in found]
    assert len(set(keys)) == len(keys)
    return {key: list(r[3:]) for key, r in zip(keys, found)}


def test_every_kind_of_document(spark):
    docs = [
        (1, WORDS, "a"),
        (2, WORDS, "b"),
        (2, WORDS, "b"),
        (3, WORDS, None),
        (4, WORDS, ""),
        (5, None, "a"),
        (6, "", "a"),
        (7, " \n\t ", "a"),
        (None, WORDS, "a"),
        (None, None, "b"),
        (8, "a b " * 40, "a"),
        (9, WORDS.upper(), "a"),
        (10, WORDS + " #", "b"),
        (11, "A# " * 10, "b"),
        (12, "A# " * 10, "a"),
        (12, "other", "a"),
        (13, "Ünïcödé | 🙂 " * 30, "a"),
        (14, "x\x0by\x1fz w " * 30, "c"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (6, 1, None), (6, 0, 1), (12, 1, 0), (None, 1, 1), (99, 1, 1)]
    want = by_hand(docs[:-1], labels)
    found = audited(spark, docs, labels)
    assert {k: v for k, v in found.items() if k[0] != "c"} == want
    # Only space and the controls from tab to carriage return part words: 60 of them, 3 different.
    assert found["c", "ABCDE", 2] == [0, 1, 0, 1, 0, 0, 120]


def test_hot_copies(spark):
    docs = [(i, WORDS, "a" if i % 3 else "b") for i in range(3000)]
    assert audited(spark, docs, [])["a", "EABCD", 1][:2] == [0, 2000]
    assert audited(spark, docs, [])["b", "EABCD", 1][:2] == [1, 999]


def test_equal_rows_of_one_id(spark):
    assert audited(spark, [(7, WORDS, "a")] * 500, [(7, 1, 0)])["a", "EDCBA", 1][:2] == [500, 0]


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [(1, "x", "a")], [])["a", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_text_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [("b", WORDS, "s", 1, 2, 3), ("a", WORDS, "s", 1, 2, 3), (None, WORDS, "s", 1, 2, 3)],
        "doc_id string, text string, source string, n int, mask int, part int",
    )
    labels = spark.createDataFrame([("b", 1, 0, 5)], "doc_id string, quality int, toxic int, good int")
    first = filter_audit.filter_audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r.kept, r.removed, r.good_lost) for r in first] == [(2, 1, 1)]


@pytest.mark.parametrize("mask", [1, 6, 21, 31])
def test_intervals_cover_every_order_once(mask):
    covered = [rank for m, _, low, high in intervals() if m == mask for rank in range(low, high)]
    assert sorted(covered) == list(range(120))
