"""Importance resampling of documents towards a target text, by hashed word n-grams.

Scoring: every feature (a run of 1 to 3 words) falls into one of a fixed number
of buckets; one pass counts the buckets of the documents and of the target, which
gives an array of gains, and a second pass adds up each document's gains.

Drawing: the highest scores, with exact ranks, by parallel sorting with regular
sampling. Sorted runs are written; every so many rows of a run, one is a sample;
the samples, sorted, give splitters at regular places. Each row goes to the
segment between its splitters, segments are sorted where they land, and the
counts of the segments before give exact ranks. Keys end with a row's place in
its run, so that no two are equal and however many rows share a score, or are
copies of one row, splitters part them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tulha.llm.tables import with_columns, written
from tulha.llm.words import Words, words_of

BUCKETS = 10_000
LONGEST_RUN = 3
SEED = 42
#: Documents of fewer words are not drawn; of the others, so many in a hundred are.
LEAST_WORDS, PERCENT = 20, 5

#: The driver gets so many samples of the scored rows at most, of five numbers each.
SAMPLES = 1 << 18
#: Rows aimed at in a segment, and the least number of segments.
SEGMENT_ROWS = 1 << 20

#: Words of more bytes than this are hashed by themselves.
_TABLE_BYTES = 64
_BYTE = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)


def _zero_bytes() -> np.ndarray:
    """What each byte of a checksum becomes when 0, 1, 2 ... zero bytes follow."""
    table = np.empty((_TABLE_BYTES + 2, 4, 256), np.uint32)
    for place in range(4):
        table[0, place] = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
    for n in range(1, len(table)):
        table[n] = _BYTE[table[n - 1] & 0xFF] ^ (table[n - 1] >> np.uint32(8))
    return table


_SHIFT = _zero_bytes()


def _followed(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The share of a checksum in that of the text with n more bytes; that of the n bytes is to be added by exclusive or."""
    parts = [_SHIFT[n, place, (crc >> np.uint32(8 * place)) & np.uint32(0xFF)] for place in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


def _word_checksums(words: Words) -> np.ndarray:
    """CRC-32 of every word, the words' bytes taken together place by place."""
    length = words.end - words.start
    order = np.argsort(-length, kind="stable")
    longest_first, start = length[order], words.start[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    first = int(np.searchsorted(-longest_first, -_TABLE_BYTES, "left"))
    for place in range(int(longest_first[first]) if first < len(order) else 0):
        last = int(np.searchsorted(-longest_first, -place, "left"))
        own = crc[first:last]
        crc[first:last] = _BYTE[(own ^ words.text[start[first:last] + place]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    crc = ~crc
    for at in range(first):
        crc[at] = zlib.crc32(words.text[start[at] : start[at] + longest_first[at]])
    result = np.empty(len(order), np.uint32)
    result[order] = crc
    return result


def feature_checksums(words: Words, longest: int = LONGEST_RUN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 ... words: the number of each run's first word, and the CRC-32 of the run joined by single spaces."""
    length = words.end - words.start
    own = _word_checksums(words)
    run, first = own, np.arange(len(own))
    yield first, run
    is_long = length > _TABLE_BYTES
    safe = np.where(is_long, 0, length)
    led = own ^ _followed(np.full(len(own), zlib.crc32(b" "), np.uint32), safe)  # of the space and the word
    for k in range(2, longest + 1):
        n = max(0, len(own) - k + 1)
        last = np.arange(n) + k - 1
        grown = _followed(run[:n], safe[last] + 1) ^ led[last]
        for at in np.flatnonzero(is_long[last]):
            word = last[at]
            grown[at] = zlib.crc32(words.text[words.start[word] : words.end[word]], zlib.crc32(b" ", int(run[at])))
        run = grown
        first = np.flatnonzero(words.row[:n] == words.row[k - 1 : k - 1 + n])
        yield first, run[first]


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of the column's texts fall into each bucket; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for words in words_of(batch.column(0)):
                for _, checksums in feature_checksums(words):
                    counts += np.bincount(checksums % np.uint32(buckets), minlength=buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], ["bucket", "n"])

    found = texts.select(F.col(column).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _as_array(counts: DataFrame, buckets: int) -> np.ndarray:
    """One number per bucket, however many texts were counted."""
    found = counts.toPandas()
    array = np.zeros(buckets, np.int64)
    array[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return array


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the source), per bucket."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratios = [(t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def score_documents(documents: DataFrame, gains: np.ndarray, column: str = "text") -> DataFrame:
    """The rows with n_words, n_features and weight (the sum of their features' gains) instead of the text."""
    shared = documents.sparkSession.sparkContext.broadcast(gains)
    added = StructType([StructField(n, LongType()) for n in ("n_words", "n_features", "weight")])

    def scored(texts: pa.Array) -> list[pa.Array]:
        table, rows = shared.value, len(texts)
        n_words, n_features, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        for words in words_of(texts):
            here, size = slice(words.first, words.last), words.last - words.first
            n_words[here] = words.per_row()
            for first, checksums in feature_checksums(words):
                row = words.row[first]
                n_features[here] += np.bincount(row, minlength=size)
                sums = np.concatenate([[0], np.cumsum(table[checksums % np.uint32(len(table))])])
                edges = np.searchsorted(row, np.arange(size + 1))
                weight[here] += sums[edges[1:]] - sums[edges[:-1]]
        return [pa.array(n_words), pa.array(n_features), pa.array(weight)]

    return with_columns(documents, column, added, scored).drop(column)


def _with_noise(scored: DataFrame, key: str, seed: int) -> DataFrame:
    """score: the weight and the row's seeded Gumbel noise, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return scored.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))))


#: The order of the draw: a row's place in its run ends it, so that no two rows are equal.
_ORDER = ("score", "key", "n_features", "_place")


def _sort_keys(score: np.ndarray, key: np.ndarray, no_key: np.ndarray, n_features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Fixed-length bytes that compare as the rows do: the higher score first, then the smaller key, none last."""
    sign = np.uint64(1 << 63)
    unsigned = lambda x: x.astype(np.int64).view(np.uint64) ^ sign
    parts = [~unsigned(score), no_key.astype(np.uint64), unsigned(np.where(no_key, 0, key)), unsigned(n_features), unsigned(row)]
    whole = np.empty((len(score), len(parts)), ">u8")
    for place, part in enumerate(parts):
        whole[:, place] = part
    return whole.view(f"S{8 * len(parts)}").ravel()


def _keys_of(batch: pa.RecordBatch) -> np.ndarray:
    column = lambda name: batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)
    return _sort_keys(column("score"), column("key"), np.asarray(batch.column("key").is_null()), column("n_features"), column("_place"))


def deal_to_segments(runs: DataFrame, rows: int, segment_rows: int, samples: int) -> tuple[DataFrame, int]:
    """Sorted runs (rows with a place each) with `_segment`, and the number of segments.

    A segment holds at most rows/segments + runs * stride rows, the stride being
    rows/samples; the driver gets `samples` rows at most, which are sorted there.
    """
    spark = runs.sparkSession
    stride = -(-rows // samples)
    in_run = F.col("_place").bitwiseAND((1 << 33) - 1)
    regular = runs.filter((in_run + 1) % stride == 0).select(*_ORDER).toArrow()
    keys = np.sort(np.concatenate([_keys_of(b) for b in regular.to_batches()] or [np.zeros(0, "S40")]))
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // segment_rows))
    places = np.arange(1, segments) * len(keys) // segments
    shared = spark.sparkContext.broadcast(np.unique(keys[places]) if len(keys) else keys)
    schema = StructType([*runs.schema.fields, StructField("_segment", LongType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = np.searchsorted(shared.value, _keys_of(batch), "right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], schema.names)

    return runs.mapInArrow(placed, schema), segments


def exact_ranks(scored: DataFrame, draws: int, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """The rows (key, n_features, score and others) with `rank`, from 1, of the first `draws` by score; NULL for the rest.

    Order: the higher score, the smaller key (NULL last), the fewer features.
    Segments that begin after the last draw are not exchanged.
    """
    rows = scored.count()
    if not draws or not rows:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("n_features")]
    runs = written(scored.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "resampling-runs")
    dealt, segments = deal_to_segments(runs, rows, segment_rows, samples)
    sizes = dict(dealt.groupBy("_segment").count().collect())  # one number per segment
    before = np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(segments)])])
    drawn_segments = int(np.searchsorted(before, draws, "left"))
    firsts = scored.sparkSession.createDataFrame([(s, int(before[s])) for s in range(drawn_segments)], "_segment long, _before long")
    kept = [c for c in runs.columns if c != "_place"]
    exchanged = dealt.filter(F.col("_segment") < drawn_segments).repartitionById(drawn_segments, F.col("_segment").cast("int"))
    place = F.row_number().over(Window.partitionBy("_segment").orderBy(*order, "_place"))
    ranked = exchanged.withColumn("_in_segment", place).join(firsts, "_segment")
    rank = F.col("_before") + F.col("_in_segment")
    ranked = ranked.select(*kept, F.when(rank <= draws, rank).alias("rank"))
    rest = dealt.filter(F.col("_segment") >= drawn_segments).select(*kept, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document row: the key, n_words, n_features, weight, score and rank (NULL if not drawn).

    Of the documents with at least `least_words` words, `percent` in a hundred
    are drawn (rounded down). A NULL or empty text has no words and weight 0; a
    NULL key is the empty text in the noise and comes last among equal scores;
    equal rows each give a row and, if drawn, ranks of their own; texts are read
    whole, however long; an empty target counts nothing; an empty table gives no
    rows. Other columns are ignored. Words of the text are digits, letters with
    A-Z lowered, and characters from U+0080 on.
    """
    gains = bucket_gains(_as_array(bucket_counts(documents, "text", buckets), buckets), _as_array(bucket_counts(target, "text", buckets), buckets))
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    scored = written(_with_noise(score_documents(rows, gains), "key", seed), "resampling-scores")
    long_enough = F.col("n_words") >= least_words
    eligible = scored.filter(long_enough)
    ranked = exact_ranks(eligible, eligible.count() * percent // 100)
    short = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short).withColumnRenamed("key", key)
