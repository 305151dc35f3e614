from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return build


WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture
def edge_docs(docs_of):
    """Nulls, empty and long texts, blanks, ties and repeated rows."""
    return docs_of(
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "eins zwei drei   vier  \n fünf"),
        (6, "x " * 3000),
        (7, " ".join(WORDS)),
        (8, " ".join(WORDS)),
        (8, " ".join(WORDS)),
        (None, "no id here"),
        (9, "a b c d e " * 9, None, None),
        (10, "word" * 40_000, "de", "b"),
        (11, " ".join(f"v{i}" for i in range(60_000)), "de", None),
        (12, "Ünïcödé 🙂 " * 30, None, "b"),
    )


@pytest.fixture
def small_tables(spark):
    return "/root/testdata/sf0.001"
