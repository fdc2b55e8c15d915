"""Token counts of fields and sections from one encoding of the whole document.

A document is its fields, joined; the whole is encoded once, and the byte span
of each token follows from the lengths of the tokens before it. Sections (the
fields, and the lines inside them) are byte spans too. Both are sorted, so an
interval join is a merge: a token belongs to the section where most of its bytes
are, and of equal shares to the earlier one. So counts of the sections add up to
the count of the whole, whatever boundaries tokens cross.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.bpe import merge_piece

#: A vocabulary file of base64 tokens and their ranks; a parameter of every function that encodes.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pre-tokenisation pattern that this vocabulary was made with (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Separates the fields of a document; it is counted with the field before it.
FIELD_SEPARATOR = "\n\n"

#: Longer runs of white space are merged apart: the library's pattern search can't hold them.
LONG_RUN = 4096

_encoders: dict[int, tuple] = {}
_ranks: dict[int, dict[bytes, int]] = {}


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoder(vocabulary: bytes) -> tuple:
    """The encoder and the length of each token in bytes, made once in each worker."""
    key = hash(vocabulary)
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        _ranks[key] = ranks
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[key]


def encode(text: str, vocabulary: bytes, long_run: int = LONG_RUN) -> list[int]:
    """The ids of a text, however long its runs of white space.

    The pattern always begins a piece where white space follows another
    character. Of a run, all but the last character are one piece, or all if the
    text ends there; the last goes on with what follows. So the text can be cut
    at both places, and the run's piece is merged by itself.
    """
    encoder, _ = _encoder(vocabulary)
    ids: list[int] = []
    first = 0
    for run in regex.finditer(rf"\s{{{long_run},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[first : run.start()])
        ids += merge_piece(text[run.start() : end].encode(), _ranks[hash(vocabulary)])
        first = end
    return ids + encoder.encode_ordinary(text[first:])


def attribute(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a boundary; both are given by their ends, from 0 on.

    A token goes to the section that has most of its bytes, of equal shares to
    the earlier one. Empty sections get none.
    """
    counts = np.zeros(len(section_ends), np.int64)
    if not len(token_ends) or not len(section_ends):
        return counts, 0
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends, "left")
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    for i in crossing:
        cuts = np.concatenate([[starts[i]], section_ends[first[i] : last[i]], [token_ends[i]]])
        owner[i] = first[i] + int(np.diff(cuts).argmax())
    np.add.at(counts, owner, 1)
    return counts, len(crossing)


def count_tokens(documents: DataFrame, fields: list[str], keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The `keep` columns with n_tokens, n_crossing, field_tokens and line_tokens (of the last field) of each row.

    Fields are joined by FIELD_SEPARATOR in their order; a NULL is the empty
    text. Lines are cut after each newline. Empty documents have no tokens, an
    empty text one line of none. Equal rows get equal counts; the vocabulary file
    is read by the driver and sent to the executors, and its size is fixed.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, lengths = _encoder(shared.value)
        separator = len(FIELD_SEPARATOR.encode())
        for batch in batches:
            totals, crossings, by_field, by_line = [], [], [], []
            for row in zip(*[batch.column(f"_field_{i}").to_pylist() for i in range(len(fields))], strict=True):
                texts = [t or "" for t in row]
                ids = np.array(encode(FIELD_SEPARATOR.join(texts), shared.value), np.int64)
                ends = np.cumsum(lengths[ids])
                sizes = np.array([len(t.encode()) for t in texts], np.int64)
                sizes[:-1] += separator
                field_ends = np.cumsum(sizes)
                newlines = np.flatnonzero(np.frombuffer(texts[-1].encode(), np.uint8) == 10) + 1
                offset = field_ends[-1] - sizes[-1]
                line_ends = np.append(newlines + offset, field_ends[-1]) if not len(newlines) or newlines[-1] < sizes[-1] else newlines + offset
                counts, _ = attribute(ends, field_ends)
                lines, crossing = attribute(ends, np.append([offset], line_ends) if offset else line_ends)
                totals.append(len(ids))
                crossings.append(crossing)
                by_field.append(counts)
                by_line.append(lines[1:] if offset else lines)
            made = [pa.array(totals, pa.int64()), pa.array(crossings, pa.int64()), pa.array(by_field, pa.list_(pa.int64())), pa.array(by_line, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], [*keep, "n_tokens", "n_crossing", "field_tokens", "line_tokens"])

    rows = documents.select(*[F.col(c) for c in keep], *[F.col(c).cast("string").alias(f"_field_{i}") for i, c in enumerate(fields)])
    kept = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[: len(keep)])
    return rows.mapInArrow(run, f"{kept}, n_tokens long, n_crossing long, field_tokens array<long>, line_tokens array<long>")
