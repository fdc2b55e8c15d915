"""Delimited scans: semicolon Latin-1, comma CSV, decimal commas, UTF-16 exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tulha.functions.names import conform_columns, file_name
from tulha.functions.values import NA_TOKENS, decimal_comma


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multi_line: bool = False,
    source_file: str | None = None,
    **csv_options: str | bool,
) -> DataFrame:
    """Files with one header row each, the same in all, as one DataFrame with safe column names.

    `source_file` names a column for the name of each row's file. Files whose
    headers differ are read by `mixed.read_mixed_headers`.

    A declared schema is read in one pass. Inference costs a second pass over
    the files and is off unless asked for; without either, columns are strings.
    Further options of Spark's CSV reader pass through.
    """
    reader = spark.read.options(**csv_options).option("header", True).option("sep", sep).option("encoding", encoding)
    if multi_line:
        reader = reader.option("multiLine", True)
    if schema is not None:
        # `enforceSchema` off makes a header that differs from the contract an error.
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(paths)
    named = conform_columns(df)
    return named if source_file is None else df.select("*", file_name()).toDF(*named.columns, source_file)


def read_semicolon_latin1(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Portal text files: `;` separated, ISO-8859-1."""
    return read_delimited(spark, paths, sep=";", encoding="ISO-8859-1", **options)


def read_comma_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Plain CSV: comma separated, UTF-8."""
    return read_delimited(spark, paths, **options)


def read_utf16_export(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Spreadsheet text export: tab separated UTF-16.

    UTF-16 lines can only be found by reading a file from its start, so one
    export is one task; many exports are read in parallel.
    """
    return read_delimited(spark, paths, sep="\t", encoding="UTF-16", multi_line=True, **options)


def parse_decimal_columns(
    df: DataFrame,
    columns: Sequence[str],
    type_name: str = "double",
    thousands: str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """Turn decimal-comma text columns into numbers."""
    return df.withColumns({c: decimal_comma(F.col(c), type_name, thousands, na_tokens) for c in columns})


def decimal_columns(
    df: DataFrame, thousands: str | None = None, na_tokens: Sequence[str] = NA_TOKENS
) -> list[str]:
    """Text columns whose every cell is a decimal-comma number or NA, found in one pass."""
    number = lambda c: F.col(c).isNull() | F.col(c).isin(list(na_tokens)) | decimal_comma(F.col(c), "double", thousands, na_tokens).isNotNull()
    row = df.agg(*[F.bool_and(number(c)).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"_{i}"]]


def read_decimal_comma(
    spark: SparkSession,
    paths: str | Sequence[str],
    decimals: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    type_name: str = "double",
    thousands: str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    rejected: str | None = None,
) -> DataFrame:
    """Delimited text whose `decimals` columns write `1234,56`; NA tokens are NULL everywhere.

    Naming the columns reads the files once; None finds them with a pass of its
    own. `rejected` names a column that lists the decimal columns whose text is
    neither a number nor NA; their cells are NULL.
    """
    df = read_delimited(spark, paths, sep=sep, encoding=encoding)
    known = set(decimal_columns(df, thousands, na_tokens) if decimals is None else decimals)
    unreadable = lambda c: F.col(c).isNotNull() & ~F.col(c).isin(list(na_tokens)) & decimal_comma(F.col(c), type_name, thousands, na_tokens).isNull()
    listed = [F.array_compact(F.array(*[F.when(unreadable(c), F.lit(c)) for c in df.columns if c in known])).alias(rejected)] if rejected else []
    return df.select(
        *[
            decimal_comma(F.col(c), type_name, thousands, na_tokens).alias(c)
            if c in known
            else F.when(~F.col(c).isin(list(na_tokens)), F.col(c)).alias(c)
            for c in df.columns
        ],
        *listed,
    )


# How zip-based and OLE workbooks begin.
BINARY_BEGINNINGS = [b"PK\x03\x04", b"\xd0\xcf\x11\xe0"]


def refuse_binary(spark: SparkSession, paths: str | Sequence[str]) -> None:
    """Raise if a file is a binary workbook: the text readers would make rows of its bytes.

    Only a file's beginning is looked at; the driver gets the names of the first few found.
    """
    begins = F.substring("content", 1, 4)
    files = spark.read.format("binaryFile").load(paths).where(begins.isin(BINARY_BEGINNINGS))
    found = [r.path for r in files.select("path").orderBy("path").take(5)]
    if found:
        raise ValueError(f"binary workbooks can't be read as text: {', '.join(found)}")


def read_landed_file(spark: SparkSession, path: str, extension: str, **options) -> DataFrame:
    """Choose the reader by file extension; an unknown one is an error."""
    readers = {
        "txt": read_semicolon_latin1,
        "csv": read_comma_csv,
        "xls": read_utf16_export,
        "xlsx": read_utf16_export,
    }
    reader = readers.get(extension.lower().lstrip("."))
    if reader is None:
        raise ValueError(f"unsupported file extension: {extension!r}")
    if reader is read_utf16_export:
        refuse_binary(spark, path)
    return reader(spark, path, **options)
