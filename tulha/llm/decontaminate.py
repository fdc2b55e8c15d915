"""Benchmark decontamination by winnowing.

Every benchmark window (13 words, or a whole shorter item) is fingerprinted by
the least hash among its k-grams, k being half the window. A document that
holds the window has the same k-gram as the least of the same stretch, so each
shared window meets its fingerprint; that is the guarantee of winnowing. The
windows of documents whose fingerprint may be a benchmark one are joined with
the benchmark windows on their words, which leaves exact hits only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.filters import FILTER_BITS, build_filter, passes
from tulha.llm.tables import TEXT_KEY, text_key, without_texts, written
from tulha.llm.words import LOWER, UPPER, WORD_PATTERN, Words, words_of

WINDOW_WORDS = 13


def _fingerprints(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every stretch of `length` words: the number of its first word, and its least k-gram hash."""
    k = (length + 1) // 2
    width = length - k + 1
    first, grams = words.grams(k)
    if len(grams) < width:
        return first[:0], grams[:0]
    least = np.lib.stride_tricks.sliding_window_view(grams, width).min(axis=1)
    whole = np.flatnonzero(first[width - 1 :] - first[: len(first) - width + 1] == width - 1)
    whole = whole[words.row[first[whole]] == words.row[first[whole + width - 1]]]
    return first[whole], least[whole]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """item_id (text), n (words of the window) and the window's words, once per item."""
    found = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD_PATTERN), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), found.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))
    return items.select("item_id", F.least(F.size("w"), F.lit(window)).alias("n"), F.explode(cut).alias("window")).distinct()


def _with_fingerprint(windows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("n").to_numpy()
            keys = np.zeros(len(lengths), np.uint64)
            for words in words_of(batch.column("window")):
                for length in np.unique(lengths[words.first : words.last]):
                    first, least = _fingerprints(words, int(length))
                    row = words.row[first] + words.first
                    mine = lengths[row] == length
                    keys[row[mine]] = least[mine]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["fingerprint"])

    return windows.select("n", "window").distinct().mapInArrow(run, "fingerprint long")


def _candidates(documents: DataFrame, lengths: list[int], table: np.ndarray) -> DataFrame:
    """Each row with its number of words and the windows that may be benchmark ones."""
    shared = documents.sparkSession.sparkContext.broadcast(table)
    found_type = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("window", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for words in words_of(batch.column("text")):
                per_row = words.per_row()
                counts[words.first : words.last] = per_row
                before = np.cumsum(per_row) - per_row
                for length in lengths:
                    first, least = _fingerprints(words, length)
                    for at in first[passes(shared.value, least)]:
                        row = words.row[at]
                        found[words.first + row].append({"start": int(at - before[row]), "n": length, "window": words.joined(int(at), length)})
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts), pa.array(found, found_type)], [*names, "_n_words", "_found"])

    rows = documents.select(*[c for c in documents.columns if c != "text"], "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*fields, "_n_words long", "_found array<struct<start:int,n:int,window:string>>"]))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted texts), contaminated: one row per document row.

    `n_hit` counts words inside any occurrence of a benchmark window. A document
    is contaminated if it has hits and they are at least a twentieth of its words.
    NULL and empty texts have no words; equal rows each give a row; an empty
    benchmark hits nothing; a NULL item_id is the empty text. Other columns are ignored.
    """
    return _verdicts(documents, benchmark, window, filter_bits).drop(*TEXT_KEY)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The documents, all columns, but for those whose text is contaminated."""
    bad = _verdicts(documents, benchmark, window, filter_bits).filter("contaminated").select(*TEXT_KEY).distinct()
    return without_texts(documents, bad)


def _verdicts(documents: DataFrame, benchmark: DataFrame, window: int, filter_bits: int) -> DataFrame:
    windows = written(benchmark_windows(benchmark, window), "benchmark-windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most `window` numbers
    table = build_filter(_with_fingerprint(windows), "fingerprint", filter_bits)
    rows = documents.select("doc_id", F.monotonically_increasing_id().alias("_row"), *text_key(), "text")
    found = written(_candidates(rows, lengths, table), "decontamination")
    hits = (
        found.select("_row", F.explode("_found").alias("f"))
        .select("_row", "f.start", "f.n", "f.window")
        .join(windows.select("window", "item_id"), "window")
        .groupBy("_row")
        .agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set("item_id").alias("items"))
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    hits = hits.select("_row", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.array_sort("items").alias("items"))
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return (
        found.withColumnRenamed("_n_words", "n_words")
        .join(hits, "_row", "left")
        .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), *TEXT_KEY)
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )
