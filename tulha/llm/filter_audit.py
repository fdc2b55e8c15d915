"""How filters of documents act together: what each removes, alone, in every order, and its Shapley share.

One pass finds which filters each document fails. Documents are then counted by
part and set of failed filters, and for all coalitions of filters the removals
are tabulated: 32 numbers a part for five filters, whatever the documents. All
results follow from these. A step of an order removes the difference between two
coalitions. Shapley shares are the solution of a least-squares problem: find
shares whose sums come nearest to every coalition's removals, under the kernel's
weights, and which add up to the removals of all filters. Its normal equations
are solved in rationals, once, for each coalition as right-hand side; the
solution times the number of orders is a table of integers, by which removals
are weighed exactly in long arithmetic.
"""

from __future__ import annotations

import hashlib
import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from tulha.llm.tables import with_columns, written

#: The filters, by letter: too short, too repetitive, shouting, symbols, and copies of an earlier document.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 50, 65, 5
SYMBOLS, CAPITALS = b"#$%&*|", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: str) -> int:
    """Bits of the filters A to D that one text fails. Words are cut at the six ASCII white spaces."""
    raw = text.encode()
    words = raw.split()
    tests = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MOST_CAPITALS_PERCENT * len(text),
        len(raw.translate(None, SYMBOLS)) < len(raw),
    )
    return sum(failed << place for place, failed in enumerate(tests))


def failures(documents: DataFrame, key: str = "doc_id", part: str = "source") -> DataFrame:
    """key, part (NULL: empty), and failed: the bits of the filters that each document row fails.

    A row fails E if a row with a smaller key has the same text; a NULL key is
    smaller than none and has none smaller. Texts are compared by SHA-256. The
    least key of each text is joined back on text and key together, so copies of
    one text, however many, do not meet in one task.
    """

    def tested(texts: pa.Array) -> list[pa.Array]:
        own = [t.as_py() or "" for t in texts]
        return [pa.array(map(text_failures, own), pa.int32()), pa.array((hashlib.sha256(t.encode()).digest() for t in own), pa.binary())]

    added = StructType([StructField("_failed", IntegerType()), StructField("_text", BinaryType())])
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    rows = written(with_columns(rows, "text", added, tested).drop("text"), "audit-rows")
    firsts = rows.groupBy("_text").agg(F.min("key").alias("key")).withColumn("_first", F.lit(True))
    copy = F.col("key").isNotNull() & F.col("_first").isNull()
    failed = F.col("_failed").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0))
    return rows.join(firsts, ["_text", "key"], "left").select("key", "part", failed.alias("failed"))


def coalition_removals(marked: DataFrame, n_filters: int, counted: dict[str, Column]) -> DataFrame:
    """part, coalition (bits), and per count: the rows that any filter of the coalition removes; `n_all` counts all rows.

    Rows are counted by part and failed filters before anything else is done, so
    what follows is as large as the number of parts.
    """
    kinds = marked.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n_all"), *[F.count_if(c).alias(n) for n, c in counted.items()])
    each = kinds.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
    removed = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    return each.groupBy("part", "coalition").agg(F.sum("n_all").alias("n_all"), *[F.sum(F.when(removed, F.col(n)).otherwise(0)).alias(n) for n in counted])


def shapley_weights(n: int) -> list[list[int]]:
    """For each of n players, by coalition: what the coalition's value counts in the player's Shapley share, times n!.

    The shares p minimise the sum over coalitions S of k(S) (v(S) - sum of p in
    S)^2 and add up to v(all), where k(S) = (n - 1) / (comb(n, s) s (n - s)). With
    a multiplier for the sum, the normal equations are linear; they are solved
    in rationals with one right-hand side per coalition.
    """
    coalitions = range(1 << n)
    whole = (1 << n) - 1
    size = int.bit_count

    def kernel(s: int) -> Fraction:
        return Fraction(n - 1, comb(n, size(s)) * size(s) * (n - size(s))) if 0 < size(s) < n else Fraction(0)

    inside = lambda s, i: s >> i & 1
    rows = []
    for i in range(n):
        left = [sum((kernel(s) for s in coalitions if inside(s, i) and inside(s, j)), Fraction(0)) for j in range(n)]
        rows.append([*left, Fraction(1), *[kernel(s) * inside(s, i) for s in coalitions]])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(int(s == whole)) for s in coalitions]])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    weights = [[factorial(n) * x for x in rows[i][n + 1 :]] for i in range(n)]
    if any(x.denominator != 1 for row in weights for x in row):
        raise ArithmeticError("the shares are no multiples of one order's")
    return [[int(x) for x in row] for row in weights]


def audit(marked: DataFrame, filters: str, good: Column, toxic: Column) -> DataFrame:
    """What each step of each order of the filters does, per part, from rows with `part` and `failed` bits.

    part, filter_order, step (from 1), and kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley (times the number of orders), as longs. Every
    part that has a row gives every order and step; no rows give none.
    """
    n = len(filters)
    counted = {"removed": F.lit(True), "good": good, "toxic": toxic}
    table = coalition_removals(marked, n, counted)
    entry = F.struct("removed", "good", "toxic")
    parts = table.groupBy("part").agg(F.max("n_all").alias("n_all"), F.map_from_entries(F.collect_list(F.struct("coalition", entry))).alias("v"))
    weights = shapley_weights(n)
    value = lambda s, name="removed": F.col("v")[s][name]
    shares = F.array(*[sum((value(s) * w for s, w in enumerate(own) if w), F.lit(0).cast("long")) for own in weights])
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({"o": "".join(filters[j] for j in order), "step": step, "i": i, "a": before, "b": before | 1 << i, "alone": 1 << i, "others": (1 << n) - 1 - (1 << i)})
            before |= 1 << i
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<o:string,step:int,i:int,a:int,b:int,alone:int,others:int>>")
    each = parts.select("part", "n_all", "v", shares.alias("shares"), F.inline(listed))
    lost = lambda name: value(F.col("b"), name) - value(F.col("a"), name)
    return each.select(
        "part",
        F.col("o").alias("filter_order"),
        "step",
        (F.col("n_all") - value(F.col("b"))).alias("kept"),
        lost("removed").alias("removed"),
        (value(F.col("alone")) - lost("removed")).alias("redundant"),
        (value(F.lit((1 << n) - 1)) - value(F.col("others"))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shares", "i").alias("shapley"),
    )


def audit_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of the five filters over whole documents, per source.

    A NULL text is the empty text, which fails A only; a NULL source is the empty
    text. Repeated rows each count; a document is good, or toxic, if any of its
    label rows says so, and neither without labels. Long texts are tested whole.
    An empty table gives no rows; other columns are ignored.
    """
    said = labels.groupBy(F.col("doc_id").alias("key")).agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    marked = failures(documents).join(said, "key", "left")
    return audit(marked, FILTERS, F.coalesce("_good", F.lit(False)), F.coalesce("_toxic", F.lit(False)))
