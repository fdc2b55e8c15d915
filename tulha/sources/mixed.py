"""Folders of delimited files whose headers differ: each file is read by its own header."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import column_names, file_name
from tulha.functions.values import NA_TOKENS, decimal_comma
from tulha.session import fresh_path

REASON, SOURCE_FILE = "_motivo", "_source_file"


def cells_of(line: Column, sep: str) -> Column:
    """Cells of one line; separators inside double quotes do not count.

    Cut at the quotes, every second part is outside of them; there separators
    become a mark, at which the line is then cut. So the work grows with the
    line's length, however many cells are quoted. A line whose quotes do not
    pair is cut at every separator.
    """
    clean = F.replace(line, F.lit("\0"), F.lit(""))
    parts = F.split(clean, '"')
    marked = F.transform(parts, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(sep), F.lit("\0"))).otherwise(p))
    quoted = F.split(F.array_join(marked, '"'), "\0")
    unquoted = F.transform(quoted, lambda c: F.replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), F.lit('""'), F.lit('"')))
    return F.when(line.contains('"') & (F.size(parts) % 2 == 1), unquoted).otherwise(F.split(clean, rf"\Q{sep}\E"))


def _landed_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """Every line that is not blank, whole, with its file and its order there."""
    raw = F.col("value")
    text = F.make_valid_utf8(raw) if encoding.upper() == "UTF-8" else F.decode(raw.cast("binary"), encoding)
    clean = F.regexp_replace(F.replace(text, F.lit("\0"), F.lit("")), "^(?:\ufeff|ï»¿)", "")
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.text(paths).select(clean.alias("line"), path.alias("path"), file_name().alias(SOURCE_FILE), start.alias("start"), F.monotonically_increasing_id().alias("at"))
    return lines.where(F.trim("line") != "")


def mark_mixed_headers(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    decimals: Sequence[str] = (),
    thousands: str | None = None,
) -> tuple[DataFrame, list[Column]]:
    """Lines of files that may order, lack or add columns, each with the reason it can't be read, and the columns of those that can.

    One scan finds each file's first line; the driver gets one row per distinct
    header, which fixes the columns: all safe names in the order in which sorted
    headers name them. A second scan cuts each line by its own file's header.
    """
    lines = _landed_lines(spark, paths, encoding)
    # A file's header is the first line of its first block.
    first = lines.where("start = 0").groupBy("path").agg(F.min(F.struct("at", "line")).alias("first")).select("path", F.col("first.line").alias("header"))
    staged = fresh_path(spark, "headers")
    first.write.parquet(staged)
    headers = spark.read.parquet(staged)
    distinct = sorted(r.header for r in headers.select("header").distinct().collect())
    named = {h: column_names(header_cells(h, sep)) for h in distinct}
    columns = list(dict.fromkeys(c for h in distinct for c in named[h]))
    unknown = [c for c in decimals if c not in columns]
    if unknown:
        raise ValueError(f"no file has the decimal columns {unknown}")
    by_file = headers.join(spark.createDataFrame(list(named.items()), "header string, names array<string>"), "header")
    kept = lines.join(by_file, "path").where(F.col("line") != F.col("header"))
    rows = kept.select("line", "names", SOURCE_FILE, cells_of(F.col("line"), sep).alias("cells"))

    def cell(name: str) -> Column:
        place = F.array_position("names", name)
        text = F.when(place > 0, F.get("cells", (place - 1).cast("int")))
        return F.when(F.trim(text) != "", text)

    known = lambda name: cell(name).isNull() | cell(name).isin(NA_TOKENS)
    numbers = {c: decimal_comma(cell(c), "double", thousands) for c in decimals}
    bad = F.concat_ws(",", *[F.when(~known(c) & numbers[c].isNull(), F.lit(c)) for c in decimals])
    reason = F.when(F.size("cells") != F.size("names"), F.format_string("%d celulas para %d colunas", F.size("cells"), F.size("names")))
    reason = reason.when(bad != "", F.concat(F.lit("decimal ilegivel: "), bad)) if decimals else reason
    marked = rows.select("line", SOURCE_FILE, "names", "cells", F.explode(F.array(reason)).alias(REASON))
    return marked, [(numbers[c] if c in numbers else cell(c)).alias(c) for c in columns]


def good_lines(marked: DataFrame, values: Sequence[Column]) -> DataFrame:
    return marked.where(f"{REASON} IS NULL").select(*values, SOURCE_FILE)


def bad_lines(marked: DataFrame) -> DataFrame:
    return marked.where(f"{REASON} IS NOT NULL").select("line", SOURCE_FILE, REASON)


def read_mixed_headers(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    decimals: Sequence[str] = (),
    thousands: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of files that may order, lack or add columns.

    A column that a file lacks is NULL in its rows. Cells are text but for
    `decimals`, which write `1234,56`; empty cells are NULL. Rejects keep the
    line, its file and a reason: another number of cells than the header, or a
    decimal that can't be read. Every line is in one of the two but for blank
    lines and lines equal to their file's header, wherever they stand. Cells do
    not go over line ends. The encoding must write ASCII as ASCII does.
    """
    marked, values = mark_mixed_headers(spark, paths, sep, encoding, decimals, thousands)
    return good_lines(marked, values), bad_lines(marked)


def header_cells(header: str, sep: str) -> list[str]:
    """The cells of one header line held by the driver."""
    return next(csv.reader([header], delimiter=sep))
