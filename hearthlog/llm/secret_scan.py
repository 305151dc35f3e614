"""Secrets in texts: keyword automaton, anchored patterns near its hits, checksums.

An Aho-Corasick automaton finds the literals that every secret begins with, in one pass
over the text. Patterns are only tried where such a literal stands. A run of hexadecimal
digits has no literal, so the text is mapped to digit or no digit first, and the word
searched for is the shortest run of digits. Tokens that carry a checksum count only if it
is right.

Defined cases: a null text is an empty one; every row is scanned whole and for itself;
spans are in code points, end exclusive; further columns pass through unless they are
named ``spans``, which is replaced.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from hearthlog.llm.worker import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds in their order, and what is sought for each of them.
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "github", "npm", "xprv"]
_KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "xprv": "xprv",
}
_PATTERNS = {
    "assign": re.compile(
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE,
    ),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "xprv": re.compile(rb"(xprv[1-9A-HJ-NP-Za-km-z]{107})(?![A-Za-z0-9])"),
}
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_HEX_DIGITS = b"0123456789abcdef"
_MIN_HEX = 16
_IS_HEX = bytes(ord("h") if c in _HEX_DIGITS else ord(".") for c in range(256))

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


def crc_digits(body: bytes) -> bytes:
    """The six base-62 digits of a token's CRC-32."""
    value, digits = zlib.crc32(body), []
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(_BASE62[digit])
    return bytes(reversed(digits))


def base58_checks(text: bytes) -> bool:
    """Whether a base-58 string ends with the first bytes of its double SHA-256."""
    value = 0
    for digit in text:
        value = value * 58 + _BASE58.index(digit)
    data = value.to_bytes((value.bit_length() + 7) // 8, "big")
    body, check = data[:-4], data[-4:]
    return hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == check


def _is_secret(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= 12
    if kind == "access":
        return len(match[0]) >= 18
    if kind == "xprv":
        return base58_checks(match[1])
    return crc_digits(match[1][:30]) == match[1][30:]


def automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for word, kind in _KEYWORDS.items():
        words.add_word(word, (len(word), kind))
    words.make_automaton()
    return words


def find_spans(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All secrets of a text by start, then kind: (kind, start, end)."""
    data = (text or "").encode()
    lowered = data.lower().decode("latin-1")  # a character per byte; only ASCII is lowered
    found = []
    ends: dict[str, int] = {}
    hits = sorted((last - size + 1, kind) for last, (size, kind) in words.iter(lowered))
    for start, kind in hits:
        if start < ends.get(kind, 0):
            continue
        if match := _PATTERNS[kind].match(data, start):
            ends[kind] = match.end()
            if _is_secret(kind, match):
                found.append((start, KINDS.index(kind), match.end()))
    digits = data.translate(_IS_HEX)
    shortest = b"h" * _MIN_HEX
    start = digits.find(shortest)
    while start >= 0:
        end = digits.find(b".", start)
        end = len(data) if end < 0 else end
        found.append((start, KINDS.index("hex"), end))
        start = digits.find(shortest, end)
    found.sort()
    place = _code_points(data, [at for start, _, end in found for at in (start, end)])
    return [(KINDS[kind], place[start], place[end]) for start, kind, end in found]


def _code_points(data: bytes, offsets: list[int]) -> dict[int, int]:
    """Code points before each byte offset."""
    places, at, points = {}, 0, 0
    for offset in sorted(set(offsets)):
        points += len(data[at:offset].decode())
        at = offset
        places[offset] = points
    return places


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = automaton()
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for part in slices(batches, "text"):
        spans = [
            [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text, words)]
            for text in part.column("text").to_pylist()
        ]
        yield part.append_column("spans", pa.array(spans, pa.list_(struct)))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``, all secrets of each text."""
    docs = docs.drop("spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", SPANS)])
    return docs.mapInArrow(_scan, schema)


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = automaton()
    for part in slices(batches, "text"):
        texts = []
        for text in part.column("text").to_pylist():
            spans = find_spans(text, words) if text else []
            pieces, at = [], 0
            for kind, start, end in spans:
                if start >= at:
                    pieces += [text[at:start], f"<{kind}>"]
                elif end > at:
                    pass  # overlaps the span before, whose mark stands for both
                at = max(at, end)
            texts.append("".join([*pieces, text[at:]]) if spans else text)
        yield part.set_column(
            part.schema.get_field_index("text"), "text", pa.array(texts, pa.string())
        )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by its kind in angle brackets.

    ``n_chars``, if there is one, becomes the length of the new text.
    """
    clean = docs.mapInArrow(_redact, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(*docs.columns)
