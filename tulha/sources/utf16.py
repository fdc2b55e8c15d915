"""UTF-16 exports read in byte ranges, so that one large file is many tasks.

Spark cuts a text file at its line end's bytes. In UTF-16 these bytes may also
stand across two letters or inside one, and a quoted cell may hold a line end. A
first scan looks at the pieces between the bytes `0A` and tells for every file
whether cutting it is exact; the files for which it is not are read from their
start, each by one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.sources.delimited import read_delimited, read_utf16_export

# A file's first bytes, as Latin-1 text, by its byte order.
MARKS = {"UTF-16LE": "ÿþ", "UTF-16BE": "þÿ"}
#: The letters below 256 of a text whose byte pairs are aligned; others are left out.
LETTERS = {"UTF-16LE": r"(?s)\G(?:(.)\x00|..)", "UTF-16BE": r"(?s)\G(?:\x00(.)|..)"}


def _open_quote(line: Column) -> Column:
    """Whether quotes of the line do not all belong to cells that it opens and closes."""
    paired = F.replace(F.regexp_replace(line, "\r$", ""), F.lit('""'), F.lit(""))
    return F.contains(F.regexp_replace(paired, r'(^|\t)"[^"]*+"(?=\t|$)', "$1"), F.lit('"'))


def split_ways(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, encoding, line_end) of every file; both are NULL where cutting it in ranges would not be exact.

    One scan, combined in the map tasks to one row per file. In little endian
    order every piece after a line end starts with the line end's second byte and
    is of odd length; in big endian order every piece before one ends with its
    first byte. A file that breaks this, begins with no mark, mixes line ends,
    holds a carriage return inside a line or a quote that its line does not close
    has no way.
    """
    value = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    pieces = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        value.alias("piece"),
    )
    piece, even = F.col("piece"), F.length("piece") % 2 == 0
    returned = piece.endswith("\r\0")
    inside = F.when(returned, F.substring(piece, F.lit(1), F.length(piece) - 2)).otherwise(piece)
    first = {e: (F.col("start") == 0) & even & piece.startswith(mark) for e, mark in MARKS.items()}
    little, big = MARKS
    body = {
        little: F.when(even, piece).otherwise(F.substring(piece, 2, 1 << 30)),
        big: F.when(even, piece).otherwise(F.substring(piece, F.lit(1), F.length(piece) - 1)),
    }
    quotes = {e: F.contains(piece, F.lit('"')) & _open_quote(F.regexp_replace(body[e], LETTERS[e], "$1")) for e in MARKS}
    order = F.struct("start", "at")
    marked = (F.col("start") == 0) & piece.startswith(MARKS[big])
    found = pieces.groupBy("path").agg(
        F.count("*").alias("n"),
        F.count_if(even).alias("n_even"),
        F.count_if(returned).alias("n_returned"),
        F.count_if(first[little]).alias("n_little"),
        F.bool_or(marked).alias("big"),
        F.bool_and(first[little] | (~even & piece.startswith("\0"))).alias("aligned_little"),
        F.bool_and(even | piece.endswith("\0")).alias("aligned_big"),
        F.max_by(F.struct(even.alias("even"), returned.alias("returned")), order).alias("last"),
        F.bool_or(F.contains(inside, F.lit("\r"))).alias("inside"),
        *[F.bool_or(q).alias(f"open_{e}") for e, q in quotes.items()],
    )
    is_little = F.col("aligned_little") & (F.col("n_little") == 1) & ~F.col("last.returned") & ~F.col(f"open_{little}")
    # Only a last line without an end may be even.
    is_big = F.col("big") & F.col("aligned_big") & (F.col("n_even") == F.col("last.even").cast("int")) & ~F.col(f"open_{big}")
    ends = F.when(is_little, F.col("n") - 1).when(is_big, F.col("n") - F.col("n_even"))
    line_end = F.when(F.col("inside"), None).when(F.col("n_returned") == 0, "\n").when(F.col("n_returned") == ends, "\r\n")
    encoding = F.when(line_end.isNull(), None).when(is_little, little).when(is_big, big)
    return found.select("path", encoding.alias("encoding"), F.when(encoding.isNotNull(), line_end).alias("line_end"))


def _literal(path: str) -> str:
    """A file's own path as the reader takes it: no escapes of an address, and no wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def read_utf16_split(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Tab separated UTF-16 exports of one header, in either byte order, a large file as many tasks.

    Two scans: `split_ways`, of which the driver gets one row per file, and the
    rows. Files without a way are read as `read_utf16_export` does. Options of
    that reader pass through.
    """
    ways: dict[tuple, list[str]] = {}
    for row in split_ways(spark, paths).orderBy("path").collect():
        ways.setdefault((row.encoding, row.line_end), []).append(_literal(row.path))
    if not ways:
        return read_utf16_export(spark, paths, **options)
    frames = [
        read_utf16_export(spark, files, **options)
        if encoding is None
        else read_delimited(spark, files, sep="\t", encoding=encoding, lineSep=line_end, **options)
        for (encoding, line_end), files in ways.items()
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
