"""Packing tokenized documents into sequences with little padding: minimum bin slack.

A document's ids are cut into full windows and a rest. Only the pieces' lengths and
checksums travel. Pieces meet in groups of bounded size; in a group every window takes
the longest rest and then the multiset of other rests that comes closest to its capacity,
found by subset sums on a bitset of reachable fills and traced back to counts by length.

Defined cases: a null or empty text is one piece holding the end mark alone; a text of any
length is cut whole; repeated rows are documents of their own; an empty table gives no
piece. A group is at most about ``GROUP_PIECES`` pieces whatever the input's size.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from hearthlog.llm.token_counts import load_tokenizer, special_strings, vocabulary_file
from hearthlog.llm.worker import group_starts, park, slices, whole_groups, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 1024
END_ID = 0
GROUP_PIECES = 8192
#: Texts of other characters than these, or with rare kinds of white space, are left to
#: the tokenizers library: elsewhere two libraries' Unicode tables cannot disagree.
_RARE = re.compile("[^\x01-\x1b\x20-\x84\x86-\x9f\xa1-" + chr(0x24F) + "]")
#: So are texts with such a run of white space: the faster library's matcher gives up on
#: runs of about a million characters.
LONG_WHITE = 100_000
_LONG_WHITE = re.compile(r"(?<![\t-\r ])[\t-\r ]{%d}" % LONG_WHITE)

# Fixed value: the pattern by which byte-level BPE parts texts before merging.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_PIECES = (
    "doc_id {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
)


def _id_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit numbers, as the machines Spark runs on hold them."""
    return np.asarray(ids, np.uint32).tobytes()


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printable Latin characters stand for themselves; the other bytes, in order, for the
    characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _plain_encoder(path: str):
    """An encoder with the file's vocabulary and merges for texts of common characters.

    It has the ids of the tokenizers library but several times its speed. None if the
    file is no byte-level BPE whose merges come in the order of their ids.
    """
    cache = worker_cache()
    if ("plain", path) not in cache:
        with open(vocabulary_file(path), encoding="utf-8") as file:
            parts = json.load(file)
        model, before = parts["model"], parts.get("pre_tokenizer") or {}
        vocab, byte_of = model["vocab"], _byte_of()
        merged = [
            vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])
        ]
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex")
        plain = not (parts.get("normalizer") or before.get("add_prefix_space"))
        if byte_level and plain and merged and merged == sorted(merged):
            import tiktoken

            ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
            cache["plain", path] = tiktoken.Encoding(
                "plain", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}
            )
        else:
            cache["plain", path] = None
    return cache["plain", path]


def _left_to_library(text: str) -> bool:
    if _RARE.search(text):
        return True
    return len(text) >= LONG_WHITE and _LONG_WHITE.search(text) is not None


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit numbers."""
    tokenizer = load_tokenizer(path)
    special = special_strings(tokenizer)
    plain = _plain_encoder(path)
    found = []
    for text in texts:
        if plain is None or any(s in text for s in special) or _left_to_library(text):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = plain.encode_to_numpy(text, disallowed_special=())
        found.append(_id_bytes(ids))
    return found


def _cutter(path: str, window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keys, rows = [], []
            texts = [text or "" for text in part.column("text").to_pylist()]
            for i, ids in enumerate(token_ids(texts, path)):
                ids += _id_bytes([END_ID])
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    keys.append(i)
                    rows.append((start, len(piece) // 4, zlib.crc32(piece), total))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(keys)), *columns], names)

    return cut


def token_pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids, every id of every document in exactly one."""
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_cutter(path, window), _PIECES.format(key=key))


def fill(free: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length come closest to ``free`` without going beyond it.

    Bit ``s`` of ``reached`` says that some multiset adds up to ``s``. Lengths come in
    descending order, a count of c as parts 1, 2, 4, ... of it, and the search ends when
    ``free`` itself is reached.
    """
    mask = (1 << (free + 1)) - 1
    reached, steps = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= free), reverse=True):
        left, part = min(counts[length], free // length), 1
        while left:
            part = min(part, left)
            steps.append((length, part, reached))
            reached |= (reached << (length * part)) & mask
            left -= part
            part *= 2
        if reached >> free & 1:
            break
    at, taken = reached.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + part
            at -= length * part
    return taken


def bins(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Positions of ``lengths`` by bin, every bin at most ``window``, longest first."""
    shelves: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        shelves.setdefault(lengths[i], []).append(i)
    counts = {n: len(shelf) for n, shelf in shelves.items()}
    packed = []
    for longest in sorted(shelves, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            chosen = [shelves[longest].pop()]
            taken = fill(window - longest, counts) if longest < window else {}
            for length in sorted(taken, reverse=True):
                counts[length] -= taken[length]
                chosen += [shelves[length].pop() for _ in range(taken[length])]
            packed.append(chosen)
    return packed


def _packer(window: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pack_group"):
            groups = table.column("pack_group").to_numpy()
            lengths = table.column("length").to_pylist()
            edges = group_starts(groups).tolist()
            order, sequence, offset = [], [], []
            for first, end in zip(edges, edges[1:]):
                for number, chosen in enumerate(bins(lengths[first:end], window)):
                    at = 0
                    for i in chosen:
                        order.append(first + i)
                        sequence.append((int(groups[first]) << 32) + number)
                        offset.append(at)
                        at += lengths[first + i]
            out = table.drop_columns(["pack_group"]).take(pa.array(order))
            out = out.append_column("sequence_id", pa.array(sequence, pa.int64()))
            out = out.append_column("offset", pa.array(offset, pa.int64()))
            yield from out.combine_chunks().to_batches()

    return pack


def pack_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Give every piece a sequence and its offset there.

    ``pieces`` is read twice, to count and to pack, and should be stored: pieces are dealt
    to groups by their place in it, so that equal ones spread like others.
    """
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = pieces.withColumn("pack_group", F.pmod(place, F.lit(groups)))
    order = ["pack_group", "length", "doc_id", "start", "ids_crc32", "doc_tokens"]
    sorted_rows = dealt.repartition("pack_group").sortWithinPartitions(*order)
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return sorted_rows.mapInArrow(_packer(window), f"{names}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Tokenize, cut and pack: one row per piece."""
    return pack_pieces(park(token_pieces(docs, path, window), "token-pieces"), window)
