"""Tables of one sf folder, and intermediates written to the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tulha.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read again: later steps start from files, whatever executors are lost."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Two hashes that stand for a text; equal texts share every verdict that depends on the text alone.
TEXT_KEY = ("_text_key", "_text_key_2")


def text_key(column: str = "text") -> list[Column]:
    return [F.xxhash64(column).alias(TEXT_KEY[0]), F.xxhash64(F.lit("second"), column).alias(TEXT_KEY[1])]


def without_texts(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose text is not among the keys."""
    return documents.withColumns(dict(zip(TEXT_KEY, text_key(), strict=True))).join(keys, list(TEXT_KEY), "left_anti").drop(*TEXT_KEY)


def with_columns(frame: DataFrame, source: str, added: StructType, make: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """The frame with columns that `make` computes from each Arrow batch of the column `source`; they replace columns of the same names."""
    names = [f.name for f in added]
    rows = frame.select([c for c in frame.columns if c not in names or c == source])
    kept = [c for c in rows.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *make(batch.column(source))], [*kept, *names])

    return rows.mapInArrow(run, StructType([*[f for f in rows.schema if f.name in kept], *added.fields]))


def hash_share(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """About `rows` rows, those whose key's hash comes first, and all of a smaller frame; rows of one key come together.

    The share is fixed by a count beforehand, so that no task has to order rows.
    """
    share = rows / max(1, frame.count())
    if share >= 1:
        return frame
    return frame.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int(share * (1 << 30)))


def hash_sample(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """The same with twice as many rows at most, whatever rows share a key; for frames of short rows, which meet in one task."""
    return hash_share(frame, key, rows).limit(2 * rows)
