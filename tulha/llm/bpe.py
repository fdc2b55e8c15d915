"""Byte-level BPE, encoding and decoding, with a segment tree over each piece's bytes.

A text is cut into the pattern's matches, and each match (a piece) is merged on
its own. Leaf i of the tree holds the rank of the pair that begins at byte i, a
node the least rank below it and, of equal ones, the leftmost, so the root names
the next merge. A merge changes three leaves: the pair that grew, the pair before
it, and the one that is gone; each is a climb of logarithmic length. So a piece
of a million bytes takes n log n steps, where a scan per merge would take n^2.

Ids are packed as little-endian unsigned 32-bit integers, as shards of tokens are.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tulha.llm.tables import with_columns

#: The vocabulary file (base64 tokens with their ranks) and the pattern that pieces match; both are parameters.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: A text is cut into pieces this many characters at a time.
BLOCK_CHARACTERS = 1 << 16
#: Each worker remembers the ids of so many of the last pieces, twice at most, of this many characters each at most.
KEPT_PIECES, KEPT_CHARACTERS = 7 << 16, 48

#: Letters and numbers assigned after Unicode 16.0, which the vocabulary's splitting does not know as such (fixed values: first and last code points).
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
#: Takes their place while a text is split: a character that is neither letter, number nor space in any version.
STAND_IN = "\ue000"


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Ranks by token of a vocabulary file's bytes; every single byte must have one."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary has no rank for the bytes {missing[:5]}")
    return ranks


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the least rank is merged first, of equal ranks the leftmost pair."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    shift = n.bit_length()
    here, none = (1 << shift) - 1, 1 << shift + 32
    leaves = 1 << max(n - 2, 0).bit_length()
    tree = [none] * (2 * leaves)
    rank = ranks.get
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            tree[leaves + i] = r << shift | i
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after, before = list(range(1, n + 2)), list(range(-1, n))

    def put(leaf: int, key: int) -> None:
        node = leaves + leaf
        tree[node] = key
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least

    def pair(first: int, end: int) -> int:
        r = rank(piece[first:end])
        return none if r is None else r << shift | first

    while (least := tree[1]) != none:
        i = least & here
        gone = after[i]
        k = after[gone]
        after[i] = k
        before[k] = i
        if gone < n - 1:
            put(gone, none)
        put(i, pair(i, after[k]) if k < n else none)
        if i:
            put(before[i], pair(before[i], k))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Pieces(dict):
    """Packed ids by piece. Of the short pieces met last, a bounded number is remembered."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = merge_piece(piece.encode(), self.ranks)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_CHARACTERS:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes texts and decodes ids by one vocabulary, in one process.

    The pattern must end a match wherever white space follows another character,
    as the usual patterns do: texts are cut at such places, so that no list of
    all pieces of a long text is made.
    """

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN) -> None:
        import regex

        ranks = read_ranks(vocabulary)
        self.pattern = regex.compile(pattern)
        self.newer = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER) + "]")
        self.cut = regex.compile(r"(?<=\S)(?=\s)")
        self.pieces = _Pieces(ranks)
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def encode(self, text: str) -> bytes:
        """Packed ids."""
        return b"".join(b"".join(map(self.pieces.__getitem__, self.split(block))) for block in self._blocks(text))

    def split(self, text: str) -> list[str]:
        """The pattern's matches, letters and numbers being those of Unicode 16.0."""
        if text.isascii() or not self.newer.search(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(self.newer.sub(STAND_IN, text))]

    def _blocks(self, text: str) -> Iterator[str]:
        first = 0
        while first < len(text):
            place = self.cut.search(text, first + BLOCK_CHARACTERS)
            last = place.start() if place else len(text)
            yield text[first:last]
            first = last

    def decode(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for; an id without a token is an error."""
        try:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        except (IndexError, TypeError):
            raise ValueError("an id has no token in the vocabulary") from None


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """Made once in each worker."""
    key = hash((vocabulary, pattern))
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary, pattern)
    return _encoders[key]


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(documents: DataFrame, column: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN, into: str = "ids") -> DataFrame:
    """The rows with `into`: the packed ids of the column's text, no special tokens.

    A NULL text is the empty text, which has no ids. Equal rows get equal ids and
    stay as many; a text is encoded whole, however long, in blocks of bounded
    size. A column named like `into` is replaced, others stay; an empty table
    gives none. The vocabulary file, of fixed size, is read by the driver and
    sent to the executors.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def ids(texts: pa.Array) -> list[pa.Array]:
        own = _encoder(shared.value, pattern)
        return [pa.array((own.encode(t.as_py() or "") for t in texts), pa.binary())]

    return with_columns(documents, column, StructType([StructField(into, BinaryType())]), ids)


def decode(frame: DataFrame, column: str = "ids", vocabulary: str = VOCABULARY, into: str = "decoded") -> DataFrame:
    """The rows with `into`: the bytes that the packed ids stand for; NULL is no ids."""
    shared = frame.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def decoded(packed: pa.Array) -> list[pa.Array]:
        own = _encoder(shared.value, PATTERN)
        return [pa.array((own.decode(p.as_py() or b"") for p in packed), pa.binary())]

    return with_columns(frame, column, StructType([StructField(into, BinaryType())]), decoded)


def n_tokens(column: str = "ids") -> Column:
    """How many ids are packed."""
    return (F.octet_length(column) / 4).cast("long")


def unpacked(frame: DataFrame, column: str = "ids", into: str = "id_list") -> DataFrame:
    """The rows with `into`: the packed ids as an array of longs; NULL is no ids."""

    def listed(packed: pa.Array) -> list[pa.Array]:
        return [pa.array((np.frombuffer(p.as_py() or b"", "<u4").astype(np.int64) for p in packed), pa.list_(pa.int64()))]

    return with_columns(frame, column, StructType([StructField(into, ArrayType(LongType()))]), listed)
