"""Phrase and near matches against a search that tries every place."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from hearthlog.llm import decontamination
from hearthlog.llm.decontamination import Words, split_words


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def search(text, items, window, slack):
    """n_words, n_hit, n_near and the items found, by trying every window everywhere."""
    words, hit, near, found = words_of(text), set(), set(), set()
    for item_id, item in items:
        item = words_of(item)
        n = min(window, len(item))
        for s in range(len(item) - n + 1) if n else ():
            wanted = item[s : s + n]
            for x in range(len(words)):
                if words[x : x + n] == wanted:
                    hit.update(range(x, x + n))
                    found.add(item_id)
                if words[x] != wanted[0]:
                    continue
                at = x
                for word in wanted[1:]:
                    rest = words[at + 1 : x + n + slack]
                    if word not in rest:
                        break
                    at += 1 + rest.index(word)
                else:
                    near.update(range(x, at + 1))
    return len(words), len(hit), len(near), sorted(map(str, found - {None}))


def check(spark, docs, items, window=10, slack=2):
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(rows, tests, window, slack).collect()
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_near, sorted(map(str, r.items))) for r in found
    )
    want = sorted((str(i), *search(text, items, window, slack)) for i, text in docs)
    assert got == want
    for r in found:
        assert sum(s.end - s.start for s in r.phrase_spans) == r.n_hit
    return got


PASSAGE = [f"p{i}" for i in range(40)]


@pytest.mark.parametrize("window, slack, alphabet", [(10, 2, 40), (3, 0, 6), (3, 2, 5), (1, 0, 30), (2, 3, 8)])
def test_random_texts(spark, window, slack, alphabet):
    random.seed(window * 100 + slack)

    def text(n):
        return " ".join(random.choice(["{}", "W{}", "{}."]).format(random.randrange(alphabet)) for _ in range(n))

    items = [(i, text(random.randrange(0, 30))) for i in range(12)]
    docs = [(i, text(random.randrange(0, 120))) for i in range(60)]
    for i in range(60, 90):  # parts of items, some with words put in
        part = random.choice(items)[1].split()
        for _ in range(random.randrange(3)):
            part.insert(random.randrange(len(part) + 1), "between")
        docs.append((i, text(20) + " " + " ".join(part) + " " + text(20)))
    check(spark, docs, items, window, slack)


def test_edges(spark):
    whole = " ".join(PASSAGE)
    items = [
        (1, whole),
        (2, whole.upper()),
        (2, whole),
        (None, " ".join(PASSAGE[:15])),
        (3, None),
        (4, "-- !"),
        (5, "one two"),
        (6, "solo"),
        (7, "never seen anywhere in the documents of this test at all"),
        (8, "again and " * 20),
        (9, "Ünï cödé 🙂 " * 4),
    ]
    docs = [
        (1, None),
        (2, ""),
        (3, "."),
        (4, "x " + whole.replace(" ", "--") + "."),
        (4, "x " + whole.replace(" ", "--") + "."),
        (4, "another text of this id, one: two!"),
        (None, "SOLO"),
        (None, whole),
        (5, " ".join(PASSAGE[:9])),
        (6, " ".join(PASSAGE[3:13])),
        (7, " ".join([*PASSAGE[:7], "and", "also", *PASSAGE[7:20]])),
        (8, "and again " * 30),
        (9, "ünï cödé 🙂 ünï cödé 🙂 ünï cödé 🙂 ünï"),
        (10, ("filler " * 9 + whole + " ") * 200),
        (11, "p39 " + whole + whole),
        (12, "soloist two one"),
    ]
    check(spark, docs, items)


def test_a_passage_in_every_document(spark):
    docs = [(i, f"d{i} " + " ".join(PASSAGE) + f" e{i}") for i in range(400)]
    docs += [(1000, " ".join(PASSAGE))] * 400
    assert {r[2] for r in check(spark, docs, [(1, " ".join(PASSAGE)), (2, " ".join(PASSAGE[:20]))])} == {40}


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a b")]) == []
    assert check(spark, [(1, "a b")], []) == [("1", 2, 0, 0, [])]


def test_clashing_columns_and_text_ids(spark):
    docs = spark.createDataFrame(
        [("a", "one two three", 1, 2, 3, 4)],
        "doc_id string, text string, items int, n_hit int, item int, word int",
    )
    items = spark.createDataFrame([("x", "two three", 1)], "item_id string, text string, phrase int")
    row = decontamination.contamination(docs, items).first()
    assert (row.doc_id, row["items"], row.n_hit, row.item, row.word) == ("a", ["x"], 2, 3, 4)


def test_words_of_a_column():
    texts = ["", None, "a", " lead", "Trail ", "x--y", "Ünï", "..", "z" * 100, "a b  c"]
    words = Words(pa.array(texts))
    every = words.taken(pa.array(range(len(words.ends) - 1))).to_pylist()
    for i, text in enumerate(texts):
        own = every[words.first[i] : words.first[i + 1]]
        assert [w.encode() for w in own] == split_words(text)
    assert (words.slots() < 2**decontamination.BITS).all()
    assert len(Words(pa.array([], pa.string())).slots()) == 0
