"""Weather-station files: a preamble, a header, then `;` separated rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import BLANK_NAME, DIGIT_PREFIX, computed_once, slug
from tulha.functions.values import NA_TOKENS, decimal_comma
from tulha.sources.mixed import cells_of

# Lines before the header, and the case-insensitive file pattern.
PREAMBLE_LINES = 8
FILE_GLOB = "*.[cC][sS][vV]"


def read_binary_files(spark: SparkSession, path: str, glob: str = FILE_GLOB) -> DataFrame:
    """Whole files below a folder as `(path, content)`."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "content")
    )


def _unique_names(raw: Column) -> Column:
    """Safe header names: a blank one is `column`, a repeated one gets its occurrence as suffix from `_2` on.

    A blank name behind the last separator, where lines end, is no column.
    """
    safe = F.transform(raw, lambda c: F.when(slug(c) == "", BLANK_NAME).when(slug(c).rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), slug(c))).otherwise(slug(c)))
    before = lambda i: F.size(F.filter(F.slice(safe, 1, i), lambda c: c == F.get(safe, i)))
    named = F.transform(safe, lambda c, i: F.when(before(i) == 0, c).otherwise(F.concat(c, F.lit("_"), (before(i) + 1).cast("string"))))
    last = F.trim(F.element_at(raw, -1)) == ""
    return F.when(last, F.slice(named, 1, F.size(named) - 1)).otherwise(named)


def _station_cells(files: DataFrame, preamble: int, sep: str, encoding: str) -> DataFrame:
    """`(path, content)` to one row per data line: `arquivo_origem, path, header, cells`."""
    decoded = F.regexp_replace(F.decode("content", encoding), "^\ufeff", "")
    # The header is worked out per file, in a step of its own below the explode.
    headed = files.select("path", F.split(decoded, "\r\n|\n|\r").alias("lines"))
    headed = computed_once(headed, "raw", cells_of(F.get("lines", F.lit(preamble)), sep))
    headed = computed_once(headed, "header", _unique_names(F.col("raw")))
    lines = headed.select(
        F.substring_index("path", "/", -1).alias("arquivo_origem"),
        "path",
        "header",
        F.explode(F.slice("lines", preamble + 2, F.greatest(F.size("lines"), F.lit(1)))).alias("line"),
    )
    return lines.where(F.trim("line") != "").select("arquivo_origem", "path", "header", cells_of(F.col("line"), sep).alias("cells"))


def station_columns(
    files: DataFrame, preamble: int = PREAMBLE_LINES, sep: str = ";", encoding: str = "ISO-8859-1"
) -> dict[str, str]:
    """Every column the files' headers name, `double` where all its cells are numbers or NA.

    One grouped pass over all files; the driver gets one row per column.
    """
    cells = _station_cells(files, preamble, sep, encoding)
    pairs = cells.select(F.explode(F.arrays_zip(F.col("header").alias("name"), F.col("cells").alias("cell"))).alias("p"))
    cell = F.col("p.cell")
    number = cell.isNull() | cell.isin(NA_TOKENS) | decimal_comma(cell).isNotNull()
    found = (
        pairs.where("p.name IS NOT NULL")
        .groupBy(F.col("p.name").alias("name"))
        .agg(F.bool_and(number).alias("number"))
        .orderBy("name")
        .collect()
    )
    return {r["name"]: "double" if r["number"] else "string" for r in found}


def parse_station_files(
    files: DataFrame,
    columns: Mapping[str, str] | None = None,
    preamble: int = PREAMBLE_LINES,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    rejected: str | None = None,
) -> DataFrame:
    """`(path, content)` rows to station rows plus `arquivo_origem`.

    `columns` maps a safe column name to its type; None finds them with a pass
    of its own. Cells are found through each file's own header, so files may
    order columns differently or lack some; a column missing from a file is
    NULL there. `rejected` names a column that lists the numeric columns whose
    cell is neither a number nor NA. A station file is one year of hourly lines, so one file per row
    is bounded; files spread over tasks.
    """
    if columns is None:
        columns = station_columns(files, preamble, sep, encoding)
    cells = _station_cells(files, preamble, sep, encoding)

    def cell(name: str) -> Column:
        place = F.array_position("header", name)
        return F.when(place > 0, F.get("cells", (place - 1).cast("int")))

    def value(name: str, type_name: str) -> Column:
        text = cell(name)
        if type_name == "string":
            return F.when(F.trim(text) != "", text).alias(name)
        return decimal_comma(text, type_name).alias(name)

    def unreadable(name: str, type_name: str) -> Column:
        text = cell(name)
        return F.when(text.isNotNull() & ~text.isin(NA_TOKENS) & decimal_comma(text, type_name).isNull(), F.lit(name))

    failed = [unreadable(n, t) for n, t in columns.items() if t != "string"]
    listed = [F.array_compact(F.array(*failed)).alias(rejected)] if rejected else []
    return cells.select(*[value(n, t) for n, t in columns.items()], *listed, "arquivo_origem", "path")


def read_station_files(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Every station file below `path` as one DataFrame."""
    return parse_station_files(read_binary_files(spark, path), columns, **options)


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for archive, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as opened:
                for member in opened.infolist():
                    parts = member.filename.replace("\\", "/").split("/")
                    # A member that would land outside its folder is no data file.
                    if member.is_dir() or parts[0] == "" or ".." in parts or ":" in parts[0]:
                        continue
                    yield pd.DataFrame(
                        {"archive": [archive], "path": ["/".join(parts)], "content": [opened.read(member)]}
                    )


def expand_archives(archives: DataFrame) -> DataFrame:
    """`(path, content)` zip files to one row per member: `(archive, path, content)`.

    Members leave one at a time, so a task holds one archive and one member.
    """
    return archives.select("path", "content").mapInPandas(_expand, "archive string, path string, content binary")


def read_archived_station_files(
    spark: SparkSession, path: str, columns: Mapping[str, str] | None = None, **options
) -> DataFrame:
    """Station files inside the zip archives below `path`."""
    members = expand_archives(read_binary_files(spark, path, "*.[zZ][iI][pP]"))
    return parse_station_files(members.where(F.col("path").rlike(r"(?i)\.csv$")), columns, **options)
