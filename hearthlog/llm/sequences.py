"""Hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from hearthlog.llm.worker import worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
#: Bytes hashed at a time. A longer run of bytes is cut between words.
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64, kept per worker."""
    cache = worker_cache()
    have = cache.get("powers")
    if have is None or len(have[0]) < count:
        size = max(count, _CHUNK + 1)
        have = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            have.append(np.multiply.accumulate(row))
        cache["powers"] = have
    return have[0][:count], have[1][:count]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[i] * base ** i`` before every position."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values))[0], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``values[start:end]``, whatever their place."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word (run without ASCII white space) of a UTF-8 text."""
    data = np.frombuffer(text, np.uint8)
    found = []
    at = 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        space = _SPACE[data[at:end]]
        if end < len(data) and not space[-1]:
            cut = len(space) - int(np.argmax(space[::-1])) if space.any() else 0
            if not cut:
                # One word longer than a chunk: it ends where the next white space is.
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) if len(rest) else len(data)
            else:
                end = at + cut
            space = _SPACE[data[at:end]]
        found.append(_chunk_words(data[at:end], space))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _chunk_words(data: np.ndarray, space: np.ndarray) -> np.ndarray:
    edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    return run_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1)), starts, ends)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` word hashes."""
    starts = np.arange(max(0, len(words) - size + 1))
    return run_hashes(prefix_sums(words), starts, starts + size)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Distinct hashes of a text's runs of ``size`` words; of all its words, if fewer."""
    words = word_hashes(text)
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


#: Positions a chunk may have: they share a number with the bits of a hash.
_POSITION_BITS = 20
CHUNK_VALUES = (1 << _POSITION_BITS) - (1 << 12)


class Chunk:
    """Pieces of sequences, one after the other. ``owner`` and ``base`` tell whose and where."""

    def __init__(self, pieces: list[np.ndarray], owner: list[int], base: list[int]) -> None:
        self.values = np.concatenate(pieces)
        self.bounds = np.cumsum([0, *map(len, pieces)])
        self.owner, self.base = np.array(owner, np.int64), np.array(base, np.int64)

    def whose(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owner and place in the owner's sequence of positions in the chunk."""
        piece = np.searchsorted(self.bounds, positions, "right") - 1
        return self.owner[piece], positions - self.bounds[piece] + self.base[piece]


def chunks(sequences, size: int, limit: int = CHUNK_VALUES):
    """Chunks of (owner, base, values) with every window of ``size`` values in one piece."""
    pieces, owner, base, total = [], [], [], 0
    for who, start, values in sequences:
        step = limit - size + 1
        for at in range(0, len(values) - size + 1, step):
            piece = values[at : at + limit]
            if total + len(piece) > limit and pieces:
                yield Chunk(pieces, owner, base)
                pieces, owner, base, total = [], [], [], 0
            pieces.append(piece)
            owner.append(who)
            base.append(start + at)
            total += len(piece)
    if pieces:
        yield Chunk(pieces, owner, base)


class Runs:
    """The windows of a chunk in runs that share their anchor.

    A window's anchor is the run of ``anchor_size`` values in it with the least hash, the
    leftmost of equals. It depends on the window's values alone, so equal windows have
    equal anchors: ``bucket`` is the anchor's hash. The windows of one run all differ.
    """

    def __init__(self, chunk: Chunk, size: int, anchor_size: int) -> None:
        self.sums = prefix_sums(chunk.values.astype(np.uint64) + np.uint64(1))
        places = np.arange(len(chunk.values) - anchor_size + 1)
        hashes = run_hashes(self.sums, places, places + anchor_size)
        low = np.uint64((1 << _POSITION_BITS) - 1)
        least = (hashes & ~low) | places.astype(np.uint64)
        width, reach = size - anchor_size + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            rest = width - reach
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        inside = np.zeros(len(anchor) + 1, np.int64)
        long_enough = np.diff(chunk.bounds) >= size
        np.add.at(inside, chunk.bounds[:-1][long_enough], 1)
        np.add.at(inside, chunk.bounds[1:][long_enough] - size + 1, -1)
        #: Positions of all windows, and where in them every run begins.
        self.windows = np.flatnonzero(np.cumsum(inside[:-1]))
        anchor = anchor[self.windows]
        new = (np.diff(self.windows) != 1) | (np.diff(anchor) != 0)
        self.starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        self.counts = np.diff(np.append(self.starts, len(self.windows)))
        self.first = self.windows[self.starts]
        self.bucket = hashes[anchor[self.starts]]


#: Bytes of a window's hash that travel. Its bucket's 64 bits come on top of them.
HASH_BYTES = 6


def packed(hashes: np.ndarray) -> np.ndarray:
    """The low bytes of hashes, as a flat array of bytes."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].reshape(-1)


def unpacked(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = data.reshape(-1, HASH_BYTES)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``length`` places lie in one of the spans."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
