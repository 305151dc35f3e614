"""Find benchmark passages in documents through a distributed positional inverted index.

Test items are cut into windows of consecutive words. The documents are counted once to
learn how frequent the test terms are; of each window only the two rarest terms become
*anchors*. A second pass stores the postings (term, document, positions) of the anchors.
Joined by term, a posting at position ``p`` and an anchor at position ``q`` of an item
speak for the item lying at ``p - q``: these offset-adjusted lists are intersected by
grouping, and what both anchors agree on is compared word by word with the document.

Matches are exact phrases, and *near* ones: all words of a window in order with at most
``slack`` other words among them.

Test terms and anchors reach the tasks as bit tables of a fixed size, whatever the size
of the benchmark: a table only lets some needless words through, which then find no
partner in the join. Words travel as they are; nothing is decided by a hash but the
identity of equal texts (128 bits). Copies of a text are one text to the index.

Words are runs of ASCII letters, lower-cased, digits and non-ASCII characters.

Defined cases: null and empty texts have no words and match nothing; an item without words
is none, one of fewer words than a window is one window; an item without an id marks
documents but is not listed; equal items are compared once and listed each, an id once;
repeated rows and repeated or null ids of documents are judged each by their own text;
empty tables give no matches; further columns of documents pass through unless named like
a result column, which they then lose.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.llm.worker import park, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
SLACK = 2
#: Anchors per window. Two must agree on where an item lies.
ANCHORS = 2
#: A bit table has 2 ** BITS bits: half a megabyte.
BITS = 22

#: Ways in which the copies of a text with matches are spread.
SALTS = 16

RESULTS = ["n_words", "n_hit", "n_near", "items", "phrase_spans", "near_spans"]

#: Lower-cases A to Z and turns every other ASCII character but letters and digits to a blank.
_WORD_BYTES = bytes(
    c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    else c if c >= 128 or chr(c).isdigit() or chr(c).islower()
    else 32
    for c in range(256)
)
_SPAN = "struct<start: int, end: int>"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


def text_key(text: str | None) -> bytes:
    return blake2b((text or "").encode(), digest_size=16).digest()


class Words:
    """All words of a column of texts, without a Python object for each.

    ``data`` holds the words one after the other, each ending in a blank; word ``i`` lies
    between ``ends[i]`` and ``ends[i + 1]``, and text ``j`` has the words from ``first[j]``
    to ``first[j + 1]``.
    """

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_string())
        blank = pa.scalar(" ", pa.large_string())
        nothing = pa.scalar("", pa.large_string())
        # A blank after every text, so that no word goes on in the next one.
        padded = pc.binary_join_element_wise(
            texts, nothing, blank, null_handling="replace", null_replacement=""
        )
        offsets = np.frombuffer(padded.buffers()[1], np.int64)[: len(texts) + 1]
        raw = padded.buffers()[2].to_pybytes() if offsets[-1] else b""
        raw = np.frombuffer(raw[: offsets[-1]].translate(_WORD_BYTES), np.uint8)
        gap = raw == 32
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        word_ends = np.flatnonzero(keep & gap)
        if len(gap) and gap[0]:
            keep[0] = False
            word_ends = word_ends[word_ends > 0]
        self.data = raw[keep]
        self.ends = np.concatenate([[0], np.flatnonzero(self.data == 32) + 1])
        self.first = np.searchsorted(word_ends, offsets)

    def slots(self) -> np.ndarray:
        """A number below 2 ** BITS for every word, from its length, beginning and end."""
        start, last = self.ends[:-1], self.ends[1:] - 2
        mixed = (last - start).astype(np.uint64)
        for i in range(6):
            mixed = mixed * np.uint64(0x100000001B3) + self.data[np.minimum(start + i, last)]
        for i in range(4):
            mixed = mixed * np.uint64(0x100000001B3) + self.data[np.maximum(last - i, start)]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - BITS)).astype(np.int64)

    def taken(self, chosen: np.ndarray) -> pa.Array:
        """The chosen words as strings."""
        words = pa.Array.from_buffers(
            pa.large_binary(),
            len(self.ends) - 1,
            [None, pa.py_buffer(self.ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))],
        ).take(pa.array(chosen))
        return pc.binary_slice(words.cast(pa.binary()), 0, -1).cast(pa.string())


def _bits(table: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(table, np.uint8), bitorder="little").view(bool)


def bit_table(slots: DataFrame) -> bytes:
    """The ``slot`` column's values as a table of bits: at most 128 rows reach the driver."""
    bucket = F.shiftright("slot", 15).alias("bucket")
    bits = F.bitmap_construct_agg(F.col("slot").bitwiseAND(32767)).alias("bits")
    table = bytearray(1 << (BITS - 3))
    for row in slots.groupBy(bucket).agg(bits).collect():
        table[row.bucket * 4096 : (row.bucket + 1) * 4096] = row.bits
    return bytes(table)


def _word_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "word"):
        yield pa.RecordBatch.from_arrays([pa.array(Words(part.column(0)).slots())], ["slot"])


def _term_table(words: DataFrame) -> bytes:
    return bit_table(words.select("word").distinct().mapInArrow(_word_slots, "slot bigint"))


def _counter(table: bytes) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _bits(table)
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            chosen = np.flatnonzero(wanted[words.slots()])
            found = pc.value_counts(words.taken(chosen))
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

    return count


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``word, n``: how often the ``word`` values of ``terms`` stand in all texts, if at all."""
    return (
        docs.select("text")
        .mapInArrow(_counter(_term_table(terms)), "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def _itemize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        phrases = [b" ".join(split_words(t)).decode() for t in part.column("text").to_pylist()]
        yield (
            part.drop_columns(["text"])
            .append_column("item", pa.array(map(text_key, phrases), pa.binary()))
            .append_column("phrase", pa.array(phrases, pa.string()))
        )


def anchored(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """``item, n, q, word``: the rarest terms of each window that can occur at all.

    ``items`` holds ``item`` and ``phrase``; ``counts`` the terms that documents have.
    """
    words = items.select("item", F.split("phrase", " ").alias("words")).select(
        "item", F.size("words").alias("n"), F.posexplode("words").alias("q", "word")
    )
    length = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(
        F.greatest(F.col("q") - length + 1, F.lit(0)), F.least(F.col("q"), F.col("n") - length)
    )
    frequency = F.coalesce(F.col("count"), F.lit(0)).alias("count")
    counted = words.join(counts.withColumnRenamed("n", "count"), "word", "left")
    rarest = (
        counted.select("item", "n", "q", "word", frequency, F.explode(starts).alias("s"))
        .groupBy("item", "n", "s")
        .agg(F.array_sort(F.collect_list(F.struct("count", "word", "q"))).alias("terms"))
        .where(F.col("terms")[0]["count"] > 0)
        .select("item", "n", F.inline(F.slice("terms", 1, ANCHORS)))
    )
    return rarest.select("item", "n", "q", "word").distinct()


def _indexer(table: bytes) -> Callable:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _bits(table)
        for part in slices(batches, "text"):
            texts = part.column("text")
            words = Words(texts)
            chosen = np.flatnonzero(wanted[words.slots()])
            terms = words.taken(chosen).dictionary_encode()
            doc = np.searchsorted(words.first, chosen, side="right") - 1
            code = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((code, doc))  # stable: positions stay in order
            doc, code = doc[order], code[order]
            position = chosen[order] - words.first[doc]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
            begins = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(begins, len(doc)), pa.int32()), pa.array(position, pa.int32())
            )
            postings = pa.StructArray.from_arrays(
                [terms.dictionary.take(pa.array(code[begins])), lists], ["word", "positions"]
            )
            bounds = np.searchsorted(doc[begins], np.arange(len(texts) + 1))
            yield (
                part.drop_columns(["text"])
                .append_column("__key", pa.array(map(text_key, texts.to_pylist()), pa.binary()))
                .append_column("n_words", pa.array(np.diff(words.first), pa.int64()))
                .append_column("__postings", pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), postings))
            )

    return index


def indexed(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """``docs`` without texts, with the text's key, ``n_words`` and the anchors' postings."""
    fields = [f for f in docs.schema if f.name != "text"]
    extra = "__key binary, n_words bigint, __postings array<struct<word: string, positions: array<int>>>"
    schema = T.StructType([*fields, *T.StructType.fromDDL(extra).fields])
    return docs.mapInArrow(_indexer(_term_table(anchors)), schema)


def candidates(index: DataFrame, anchors: DataFrame, window: int, slack: int) -> DataFrame:
    """``__key, item, hits``: where two anchors of an item agree, up to ``slack`` words.

    A hit is an anchor's position in the item and the item's offset in the document.
    Every row is one (text, item, offset), so frequent items and long texts spread.
    """
    adjusted = (
        index.select("__key", F.inline("__postings"))
        .join(anchors, "word")
        .select("__key", "item", "n", "q", F.explode("positions").alias("p"))
        .select("__key", "item", "n", F.struct("q", (F.col("p") - F.col("q")).alias("d")).alias("hit"))
    )
    cell = F.floor(F.col("hit.d") / (slack + 1))
    cells = F.array(cell, cell + 1) if slack else F.array(cell)
    enough = F.least(F.lit(min(ANCHORS, window)), F.col("n"))
    agreed = (
        adjusted.withColumn("cell", F.explode(cells))
        .groupBy("__key", "item", "n", "cell")
        .agg(F.collect_set("hit").alias("hits"))
        .where(F.size(F.array_distinct(F.col("hits.q"))) >= enough)
    )
    return agreed.groupBy("__key", "item").agg(
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits")
    )


def phrase_runs(words: list, item: list, hits: list[tuple[int, int]], window: int) -> list:
    """Stretches of ``words`` that equal ``item`` at a hit and are as long as a window."""
    need = min(window, len(item))
    runs, diagonal, done = [], None, 0
    for d, q in sorted((d, q) for q, d in hits):
        if d != diagonal:
            diagonal, done = d, 0
        if q < done:
            continue
        low = high = q
        while low > 0 and low + d > 0 and item[low - 1] == words[low + d - 1]:
            low -= 1
        while high < len(item) and high + d < len(words) and item[high] == words[high + d]:
            high += 1
        done = high
        if high - low >= need:
            runs.append((low + d, high + d))
    return runs


def near_runs(words: list, item: list, hits: list[tuple[int, int]], window: int, slack: int) -> list:
    """Shortest stretches that hold a window's words in order and ``slack`` others at most."""
    length = min(window, len(item))
    tried = {
        (s, d + s - less)
        for q, d in hits
        for s in range(max(0, q - length + 1), min(q, len(item) - length) + 1)
        for less in range(slack + 1)
    }
    runs = []
    for s, x in tried:
        if not 0 <= x < len(words) or words[x] != item[s]:
            continue
        at, limit = x + 1, min(len(words), x + length + slack)
        for word in item[s + 1 : s + length]:
            while at < limit and words[at] != word:
                at += 1
            at += 1
            if at > limit:
                break
        else:
            runs.append((x, at))
    return runs


def united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches made one."""
    result: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def _verifier(window: int, slack: int) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            columns: list[list] = [[], [], []]
            for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
                words = split_words(text)
                items, exact, near = [], [], []
                for candidate in found:
                    item = candidate["phrase"].encode().split(b" ")
                    hits = [(hit["q"], hit["d"]) for hit in candidate["hits"]]
                    runs = phrase_runs(words, item, hits, window)
                    if runs:
                        items.append(candidate["item"])
                        exact += runs
                    near += near_runs(words, item, hits, window, slack)
                for column, value in zip(columns, (items, united(exact), united(near))):
                    column.append(value)
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            exact, near = ([[{"start": a, "end": b} for a, b in row] for row in c] for c in columns[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__key"),
                    pa.array(columns[0], pa.list_(pa.binary())),
                    pa.array(exact, spans),
                    pa.array(near, spans),
                ],
                ["__key", "keys", "phrase_spans", "near_spans"],
            )

    return verify


def _texts_of(table: bytes) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = _bits(table), set()
        for part in slices(batches, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                key = text_key(text)
                if wanted[int.from_bytes(key[:3]) >> (24 - BITS)] and key not in seen:
                    seen.add(key)
                    rows.append((key, text))
            keys, texts = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["__key", "text"]
            )

    return read


def verified(docs: DataFrame, found: DataFrame, window: int, slack: int) -> DataFrame:
    """``__key, keys, phrase_spans, near_spans`` of the texts in ``found``.

    Only texts with candidates are shuffled, each copy of one once per task.
    """
    first = F.conv(F.hex(F.substring("__key", 1, 3)), 16, 10).cast("bigint")
    table = bit_table(found.select(F.shiftright(first, 24 - BITS).alias("slot")))
    texts = docs.select("text").mapInArrow(_texts_of(table), "__key binary, text string")
    by_text = found.groupBy("__key").agg(
        F.collect_list(F.struct("item", "phrase", "hits")).alias("found")
    )
    single = texts.groupBy("__key").agg(F.first("text").alias("text"))
    spans = f"array<{_SPAN}>"
    return single.join(by_text, "__key").mapInArrow(
        _verifier(window, slack),
        f"__key binary, keys array<binary>, phrase_spans {spans}, near_spans {spans}",
    )


def _covered(spans: str) -> Column:
    length = F.transform(spans, lambda s: s["end"] - s["start"])
    total = F.aggregate(length, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.coalesce(total, F.lit(0).cast("bigint"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = SLACK
) -> DataFrame:
    """``docs`` without texts, with their matches against ``items`` (``item_id, text``).

    ``n_words``, ``n_hit`` (words inside a window of an item), ``n_near`` (words inside a
    near match, exact ones included), ``items`` (ids of items with an exact match), and
    the matches as word ranges ``phrase_spans`` and ``near_spans``.
    """
    docs = docs.drop(*RESULTS)
    phrased = items.select("item_id", "text")
    fields = [f for f in phrased.schema if f.name != "text"]
    extra = T.StructType.fromDDL("item binary, phrase string").fields
    itemized = park(phrased.mapInArrow(_itemize, T.StructType([*fields, *extra])), "items")
    itemized = itemized.where("phrase <> ''")
    different = itemized.groupBy("item").agg(F.first("phrase").alias("phrase"))
    terms = itemized.select(F.explode(F.split("phrase", " ")).alias("word"))
    anchors = park(anchored(different, term_counts(docs, terms), window), "anchors")
    index = park(indexed(docs, anchors), "postings")
    found = park(candidates(index, anchors, window, slack).join(different, "item"), "candidates")
    result = park(verified(docs, found, window, slack), "matches")
    listed = (
        result.select("__key", F.explode("keys").alias("item"))
        .join(itemized.select("item", "item_id"), "item")
        .groupBy("__key")
        .agg(F.collect_set("item_id").alias("items"))
    )
    kind = itemized.schema["item_id"].dataType.simpleString()
    spans = [F.coalesce(c, F.array().cast(f"array<{_SPAN}>")).alias(c) for c in ("phrase_spans", "near_spans")]
    # A text may have very many copies: the few texts with matches come once per salt.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    told = result.join(listed, "__key", "left").select("*", salts)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return (
        index.drop("__postings")
        .withColumn("__salt", salt)
        .join(told, ["__key", "__salt"], "left")
        .withColumns({"n_hit": _covered("phrase_spans"), "n_near": _covered("near_spans")})
        .withColumn("items", F.coalesce("items", F.array().cast(f"array<{kind}>")))
        .select(*[c for c in docs.columns if c != "text"], "n_words", "n_hit", "n_near", "items", *spans)
    )
