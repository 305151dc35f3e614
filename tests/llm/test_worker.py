from __future__ import annotations

import pickletools
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle

from hearthlog.llm import (
    byte_repeats,
    decontamination,
    filter_audit,
    html_extraction,
    importance_sampling,
    jaccard_join,
    packing,
    quality_rules,
    secret_scan,
    token_counts,
    topk_search,
    window_counts,
    word_repeats,
)
from hearthlog.llm.worker import park, slices, unzipped, whole_groups, zipped_texts


def batches_of(keys, cuts):
    edges = sorted({0, len(keys), *[c % (len(keys) + 1) for c in cuts]})
    for a, b in zip(edges, edges[1:]):
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys[a:b], pa.int64()), "row": list(range(a, b))})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60).map(sorted), st.lists(st.integers(0, 60)), st.integers(1, 30))
def test_groups_are_never_cut(keys, cuts, min_rows):
    tables = list(whole_groups(batches_of(keys, cuts), "key", min_rows))
    assert [r for t in tables for r in t.column("row").to_pylist()] == list(range(len(keys)))
    seen = [set(t.column("key").to_pylist()) for t in tables]
    assert sum(map(len, seen)) == len(set(keys))


@pytest.mark.parametrize("most", [1, 50, 10_000])
def test_slices_are_bounded_and_complete(most):
    draw = random.Random(most)
    texts = [None if draw.random() < 0.2 else "é" * draw.randrange(0, 60) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    parts = list(slices([batch, batch.slice(0, 0)], "text", most))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    for part in parts:
        sizes = [len((t or "").encode()) for t in part.column("text").to_pylist()]
        assert sum(sizes) <= most + max(sizes)


def test_zipped_texts_come_back(docs_of, spark):
    texts = [None, "", "a", "Ünï 🙂 " * 500]
    docs = docs_of(*enumerate(texts))
    zipped = park(zipped_texts(docs), "zipped")
    assert "text" not in zipped.columns
    rows = sorted(zipped.collect(), key=lambda r: r.doc_id)
    column = pa.array([None if r["__zipped"] is None else bytes(r["__zipped"]) for r in rows], pa.binary())
    assert [t.decode() for t in unzipped(column)] == [t or "" for t in texts]
    assert rows[0]["__zipped"] is None and rows[1]["__zipped"] is not None


def by_reference(function):
    """Names of this package that a worker would have to import."""
    names, found = [], set()
    for op, value, _ in pickletools.genops(cloudpickle.dumps(function)):
        if isinstance(value, str):
            names.append(value)
        if op.name == "STACK_GLOBAL" and names[-1] != names[-2]:
            found.add(tuple(names[-2:]))
    return {pair for pair in found if any(n.startswith("hearthlog") for n in pair)}


@pytest.mark.parametrize(
    "function",
    [
        byte_repeats._first_rows, byte_repeats._judge_rows, byte_repeats._settler(True),
        byte_repeats._open_windows, byte_repeats._finisher(True), word_repeats._edges,
        word_repeats._remove, window_counts._segments, window_counts._windows, packing._cutter("x", 3),
        packing._packer(3), token_counts._summarize, token_counts._counter("x", 3, None),
        decontamination._counter(b""), decontamination._indexer(b""), decontamination._itemize,
        decontamination._verifier(3, 1), decontamination._texts_of(b""), decontamination._word_slots,
        filter_audit._judge, importance_sampling._count, importance_sampling._weigher(None),
        quality_rules._measure, topk_search._moments, topk_search._searcher(3, None),
        jaccard_join._sign, jaccard_join._verify, html_extraction._extract, secret_scan._scan,
    ],
)
def test_code_travels_with_the_plan(function):
    assert by_reference(function) == set()
