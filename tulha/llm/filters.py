"""A Bloom filter over 64-bit keys, built by Spark, of a size that does not grow with the data.

It only spares work: whatever passes is joined afterwards, and nothing that
belongs to the keys is ever held back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^24 bits are 2 MB, the most that one filter sends to the driver and to each task.
FILTER_BITS = 24


def build_filter(keys: DataFrame, column: str, log2_bits: int = FILTER_BITS) -> np.ndarray:
    """Bits of two positions for each key of a long column, in 64-bit words."""
    key = F.col(column)
    positions = F.array(F.shiftrightunsigned(key, 64 - log2_bits), key.bitwiseAND((1 << log2_bits) - 1))
    words = (
        keys.select(F.explode(positions).alias("p"))
        .groupBy(F.shiftrightunsigned("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    )
    table = np.zeros(1 << (log2_bits - 6), np.uint64)
    found = words.toPandas()
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (unsigned) may be among those the filter was built from."""
    log2_bits = int(len(table) * 64).bit_length() - 1
    result = np.ones(len(keys), bool)
    for place in (keys >> np.uint64(64 - log2_bits), keys & np.uint64((1 << log2_bits) - 1)):
        result &= (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return result
