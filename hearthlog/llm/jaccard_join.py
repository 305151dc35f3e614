"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact sets verify them.

A document's set is that of its five-word shingles (all its words, if fewer). Every tree
of the forest holds each distinct text under a path of MinHash values, the deepest prefix
first: texts that share a whole path meet, one of them goes on to meet at a shorter
prefix, and prefixes are shortened until texts at the threshold meet with the target
recall. What met is a candidate component; in it all pairs of texts are verified by their
sets, block by block, so no pair of a large group is ever a row: tasks give the number of
links of each text and links that span what they connect.

Exact copies (texts with the same words) are one text from the start, and every link of a
text counts for each of its copies. Texts are numbered, so ids may be of any type that
has an order.

Defined cases: a text without words (or null) has no links and is a class of its own;
repeated rows are copies; rows without ``doc_id`` take no part and have no class; different
texts under one ``doc_id`` are told apart; an empty table gives an empty result; further
columns play no part.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from hearthlog.llm.components import components
from hearthlog.llm.sequences import mix, shingles
from hearthlog.llm.worker import group_starts, park, slices, whole_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
#: Similarity of a link: at least 4 / 5.
NUMERATOR, DENOMINATOR = 4, 5
TREES = 24
DEPTH = 5
#: Bits of a path's step; a path of ``DEPTH`` steps fits a long.
STEP_BITS = 12
TARGET_RECALL = 0.99999
#: Texts of a block when a component is verified in pairs of blocks, and their bytes (a
#: longer text is more).
BLOCK = 512
BLOCK_BYTES = 16 << 20
#: Up to so many texts pairs are compared set by set.
_FEW = 12
_COLUMNS = 4096


def recall(depth: int, similarity: float = NUMERATOR / DENOMINATOR, trees: int = TREES) -> float:
    """Chance that two texts of this similarity share a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def depths(target: float = TARGET_RECALL) -> list[int]:
    """From the whole path down to the longest prefix with the target recall."""
    used = []
    for depth in range(DEPTH, 0, -1):
        used.append(depth)
        if recall(depth) >= target:
            break
    return used


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def paths(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash paths of non-empty sets: one row per set, one number per tree."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.concatenate(sets)
    out = np.zeros((len(sets), TREES), np.int64)
    factors, terms = _functions()
    for number, (factor, term) in enumerate(zip(factors, terms)):
        least = np.minimum.reduceat(values * factor + term, starts)
        step = (mix(least) >> np.uint64(64 - STEP_BITS)).astype(np.int64)
        out[:, number // DEPTH] = (out[:, number // DEPTH] << STEP_BITS) | step
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", 2 << 20):
        words = [(text or "").encode().split() for text in part.column("text").to_pylist()]
        texts = [b" ".join(own) for own in words]
        full = [i for i, text in enumerate(texts) if text]
        keys = [hashlib.md5(text).digest() if text else None for text in texts]
        own_paths: list = [None] * len(texts)
        if full:
            for i, row in zip(full, paths([shingles(texts[i], WORDS) for i in full])):
                own_paths[i] = row
        yield (
            part.drop_columns(["text"])
            .append_column("n_bytes", pa.array(map(len, texts), pa.int64()))
            .append_column("text_key", pa.array(keys, pa.binary()))
            .append_column("paths", pa.array(own_paths, pa.list_(pa.int64())))
        )


def _candidates(texts: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) of texts that meet in a tree, each to the least of its node."""
    entries = texts.select("id", F.posexplode("paths").alias("tree", "path"))
    found = []
    for depth in depths():
        prefix = F.shiftright("path", STEP_BITS * (DEPTH - depth)).alias("prefix")
        here = entries.select("id", "tree", "path", prefix)
        nodes = here.groupBy("tree", "prefix").agg(
            F.min("id").alias("hub"), F.min_by("path", "id").alias("path"), F.count("*").alias("n")
        )
        shared = nodes.where("n > 1").select("tree", "prefix", "hub")
        met = here.join(shared, ["tree", "prefix"]).where("id <> hub")
        found.append(met.select(F.col("id").alias("a"), F.col("hub").alias("b")))
        entries = nodes.select(F.col("hub").alias("id"), "tree", "path")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def _linked(sets: list[np.ndarray], sides: np.ndarray | None) -> np.ndarray:
    """Matrix of links among sets; with ``sides`` only between the two sides."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    shared = np.zeros((n, n), np.int64)
    if n <= _FEW:
        as_sets = [set(s.tolist()) for s in sets]
        for i in range(n):
            for j in range(i):
                shared[i, j] = shared[j, i] = len(as_sets[i] & as_sets[j])
    else:
        owner = np.repeat(np.arange(n), sizes)
        values, column, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        common = np.cumsum(counts > 1) - 1
        keep = counts[column] > 1
        owner, column = owner[keep], common[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            here = slice(*np.searchsorted(column, [first, first + _COLUMNS]))
            dense = np.zeros((n, _COLUMNS), np.float32)
            dense[owner[here], column[here] - first] = 1
            shared += np.rint(dense @ dense.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = DENOMINATOR * shared >= NUMERATOR * union
    np.fill_diagonal(linked, False)
    if sides is not None:
        linked &= sides[:, None] != sides[None, :]
    return linked


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what ``linked`` connects: one fewer than nodes, per component."""
    seen = np.zeros(len(linked), bool)
    tree = []
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            node = front.pop()
            for other in np.flatnonzero(linked[node] & ~seen):
                seen[other] = True
                tree.append((node, int(other)))
                front.append(int(other))
    return tree


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "cell", min_rows=500):
        cells = table.column("cell").to_numpy()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        side, crossed = table.column("side").to_numpy(), table.column("crossed").to_numpy(False)
        edges = group_starts(cells).tolist()
        rows: list[tuple[int, int, int]] = []
        texts = table.column("text").combine_chunks()
        for first, end in zip(edges, edges[1:]):
            # Repeated rows bring a text again.
            own, at = np.unique(ids[first:end], return_index=True)
            at += first
            sets = [shingles(texts[int(i)].as_py().encode(), WORDS) for i in at]
            linked = _linked(sets, side[at] if crossed[first] else None)
            counts = linked @ copies[at]
            rows += [(int(own[i]), int(own[i]), int(counts[i])) for i in np.flatnonzero(counts)]
            rows += [(int(own[i]), int(own[j]), 0) for i, j in _spanning(linked)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))],
            ["a", "b", "links"],
        )


def _cells(members: DataFrame) -> DataFrame:
    """Deal the texts of every component to the pairs of blocks they are compared in."""
    sizes = members.groupBy("component").agg(
        F.count("*").alias("size"), F.sum("n_bytes").alias("bytes")
    )
    blocks = F.greatest(
        F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)
    ).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = members.join(sizes, "component").withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).select(
        "id",
        "copies",
        "least",
        F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        F.col("own").alias("side"),
        (F.col("own") != F.col("other")).alias("crossed"),
    )


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row with its text's key, and every text with its class and links.

    A text is found again by ``least``: the least id it stands under, and 64 bits of the
    hash of what stands there.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = park(
        docs.select("doc_id", _text_hash(), "text").mapInArrow(
            _sign,
            f"doc_id {kind}, text_hash bigint, n_bytes bigint, text_key binary, paths array<bigint>",
        ),
        "jaccard-paths",
    )
    own = F.struct("doc_id", "text_hash")
    texts = park(
        signed.where("doc_id is not null and text_key is not null")
        .groupBy("text_key")
        .agg(
            F.min(own).alias("least"),
            F.count("*").alias("copies"),
            F.first("paths").alias("paths"),
            F.first("n_bytes").alias("n_bytes"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "jaccard-texts",
    )
    met = components(_candidates(texts)).withColumnRenamed("node", "id")
    members = met.join(texts.select("id", "least", "copies", "n_bytes"), "id")
    cells = park(_cells(members), "jaccard-cells")
    rows = docs.select(_own().alias("least"), "text")
    # The texts are shuffled once, with the same plan whatever the number of candidates.
    compared = (
        rows.join(cells.hint("shuffle_hash"), "least")
        .select("cell", "id", "copies", "side", "crossed", "text")
        .repartition("cell")
        .sortWithinPartitions("cell", "id")
    )
    verified = park(compared.mapInArrow(_verify, "a bigint, b bigint, links bigint"), "jaccard-links")
    classes = components(verified.where("a <> b")).withColumnRenamed("node", "id")
    counts = verified.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    first = (
        classes.join(texts.select("id", "least"), "id")
        .groupBy("component")
        .agg(F.min("least").alias("first"))
    )
    known = (
        texts.select("text_key", "id", "least", "copies")
        .join(classes.join(first, "component").select("id", "first"), "id", "left")
        .join(counts, "id", "left")
        .select(
            "text_key",
            F.coalesce("first", "least").alias("first"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return signed.drop("paths", "n_bytes"), known


def _text_hash() -> Column:
    """Alike for a null, an empty and a blank text."""
    blanks = F.lit(" \t\n\x0b\f\r")
    return F.xxhash64(F.btrim(F.coalesce("text", F.lit("")), blanks)).alias("text_hash")


def _own() -> Column:
    return F.struct("doc_id", _text_hash())


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links`` of every row.

    ``class_id`` is the least id among the documents that links connect. ``n_links`` is the
    number of other documents, copies included, with a similarity of at least 0.8.
    """
    signed, known = _joined(docs)
    named = F.col("doc_id").isNotNull()
    return (
        signed.select("doc_id", "text_key")
        .join(known, "text_key", "left")
        .select(
            "doc_id",
            F.when(named, F.coalesce("first.doc_id", "doc_id")).alias("class_id"),
            F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        )
    )


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of every class the row with the least ``doc_id`` stays.

    Of several texts under that id the one with the least hash stays, of equal rows one;
    rows without an id stay all. Texts are shuffled only where they meet what is lost.
    """
    signed, known = _joined(docs)
    own = F.struct("doc_id", "text_hash")
    named = signed.where("doc_id is not null")
    lost = park(
        named.join(known, "text_key").where(own != F.col("first")).select(own.alias("__own")).distinct(),
        "jaccard-lost",
    )
    again = park(
        named.groupBy(own.alias("__own")).agg(F.count("*").alias("n")).where("n > 1").select("__own"),
        "jaccard-again",
    )
    marked = docs.withColumn("__own", _own())
    kept = marked.join(lost.hint("shuffle_hash"), "__own", "left_anti")
    if not again.isEmpty():
        # Equal rows, which classes cannot tell apart: one of them stays.
        twice = again.withColumn("__again", F.lit(True))
        kept = kept.join(twice, "__own", "left")
        once = kept.where("__again is null")
        kept = once.unionByName(kept.where("__again").dropDuplicates(["__own"]))
    return kept.select(*docs.columns)
