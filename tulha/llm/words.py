"""Words and word n-grams of Arrow text columns, hashed without a Python loop over words.

A word is a run of digits, letters a-z (A-Z are lowered) and characters from
U+0080 on. In UTF-8 the latter are exactly the bytes from 0x80 on, so words can
be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same words as a Java or RE2 pattern, for texts whose A-Z are lowered.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows are hashed together up to this many bytes of text; a longer row comes alone.
CHUNK_BYTES = 1 << 20

_BASE, _GRAM_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x30:0x3A] = _WORD_BYTE[0x61:0x7B] = _WORD_BYTE[0x80:] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 0x20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """The words of rows `first` to `last` of a column, in order."""

    first: int
    last: int
    text: np.ndarray  # the rows' lowered bytes
    start: np.ndarray  # of each word in `text`
    end: np.ndarray
    row: np.ndarray  # of each word, counted from `first`
    hash: np.ndarray  # of each word

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.last - self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every k words in a row of one text: the first word's number, the hash."""
        n = max(0, len(self.hash) - k + 1)
        value = np.full(n, k, np.uint64)
        for step in range(k):
            value = value * np.uint64(_GRAM_BASE) + self.hash[step : step + n]
        inside = np.flatnonzero(self.row[:n] == self.row[k - 1 : k - 1 + n])
        return inside, mix(value[inside])

    def joined(self, first: int, count: int) -> str:
        """Words `first` and on, with single spaces between."""
        return " ".join(bytes(self.text[self.start[i] : self.end[i]]).decode() for i in range(first, first + count))


def words_of(column: pa.Array) -> Iterator[Words]:
    """The words of a text column, some rows at a time; NULL has none."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _hash_words(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def _hash_words(first: int, last: int, raw: np.ndarray, offsets: np.ndarray) -> Words:
    text = _LOWERED[raw]
    inside = _WORD_BYTE[text]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][filled]
    starts[edge] = inside[edge]
    edge = offsets[1:][filled] - 1
    ends[edge] = inside[edge]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power_table(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=sums[1:])
    value = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(first, last, text, start, end, np.searchsorted(offsets[1:], start, "right"), value)
