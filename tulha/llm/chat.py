"""Chat formatting: collapse of cumulative snapshots, then rendering, with built-in functions only.

Chat logs often hold a conversation once per turn, each time a little longer.
Every turn gets the rolling hash of the prefix that it ends; a conversation whose
whole hash is a prefix hash of a longer one is an earlier snapshot of it.
Anti-joins keep the maximal conversations, and one of each group of equal ones;
only the turns of these are gathered and rendered. Until then a row is one turn,
so a conversation of any length passes through sorts and windows that spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tulha.llm.tables import written

#: Markers of a rendered turn; where a text holds the start of one it is escaped.
OPEN, SEPARATOR, CLOSE = "<|", "|>\n", "<|end|>\n"
ESCAPED_OPEN = "<\\|"
#: A turn's place and digest are hashed to so many numbers of so many hex digits, which are summed along the turns.
SUMS, SUM_DIGITS = 4, 15
#: Hex digits kept of a prefix hash: 16 bytes.
HASH_DIGITS = 32


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n, hash, whole, role, text), one row per turn.

    `pos` is the turn's place from 1, `n` the turns of its conversation, `hash`
    that of the turns up to it and `whole` that of all. Turns are ordered by
    number, role and text, NULLs first; repeated rows are turns of their own. A
    row without conv_id belongs to no other, so it is a conversation of one turn.
    """
    # NULL and empty differ, and lengths keep neighbouring fields apart.
    digest = F.sha2(F.concat_ws(":", F.coalesce(F.length("role"), F.lit(-1)), F.coalesce(F.length("text"), F.lit(-1)), "role", "text"), 256)
    rows = turns.select("conv_id", "turn", "role", "text")
    placed = F.sha2(F.concat_ws(":", F.col("pos").cast("string"), digest), 256)
    part = lambda i: F.conv(F.substring("placed", i * SUM_DIGITS + 1, SUM_DIGITS), 16, 10).cast("decimal(20,0)")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def hashed(rows: DataFrame, total) -> DataFrame:
        parts = rows.withColumn("placed", placed)
        sums = F.concat_ws(":", *[total(part(i)).cast("string") for i in range(SUMS)])
        return parts.withColumn("hash", F.unhex(F.substring(F.sha2(sums, 256), 1, HASH_DIGITS)))

    named = rows.filter("conv_id IS NOT NULL").withColumn("pos", F.row_number().over(order))
    named = hashed(named, lambda c: F.sum(c).over(upto)).withColumns({"n": F.count("*").over(every), "whole": F.last("hash").over(every)})
    single = hashed(rows.filter("conv_id IS NULL").withColumn("pos", F.lit(1)), lambda c: c.cast("decimal(30,0)"))
    single = single.withColumns({"n": F.lit(1).cast("long"), "whole": F.col("hash")})
    columns = ["conv_id", F.col("pos").cast("long").alias("pos"), "n", "hash", "whole", "role", "text"]
    return named.select(columns).unionByName(single.select(columns))


def maximal(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n, hash, n_collapsed) of the conversations that are no proper prefix of another, one of each group of equal ones.

    Of equal conversations the one with the least conv_id stays, an id before
    none. n_collapsed counts the others that a kept conversation stands for:
    equal ones and its prefixes, each of their copies; a prefix of several kept
    conversations counts for each.
    """
    first = F.min(F.struct(F.isnull("conv_id").alias("none"), "conv_id")).alias("first")
    groups = prefixes.filter("pos = n").groupBy("n", "hash").agg(F.count("*").alias("copies"), first)
    begins = prefixes.filter("pos < n").select(F.col("whole").alias("longer"), F.col("pos").alias("n"), "hash").distinct()
    tops = groups.join(begins.select("n", "hash"), ["n", "hash"], "left_anti")
    begun = begins.join(tops.select(F.col("hash").alias("longer")), "longer", "left_semi").join(groups, ["n", "hash"])
    begun = begun.groupBy("longer").agg(F.sum("copies").alias("snapshots"))
    return tops.join(begun, tops["hash"] == begun["longer"], "left").select(
        F.col("first.conv_id").alias("conv_id"), "n", "hash", (F.col("copies") - 1 + F.coalesce("snapshots", F.lit(0))).cast("long").alias("n_collapsed")
    )


def rendered(role: str = "role", text: str = "text") -> Column:
    """One turn between markers, a missing role as `unknown`."""
    escape = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit(OPEN), F.lit(ESCAPED_OPEN))
    return F.concat(F.lit(OPEN), F.when(F.col(role).isNull(), "unknown").otherwise(escape(role)), F.lit(SEPARATOR), escape(text), F.lit("\n" + CLOSE))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_collapsed and the rendered text of each maximal conversation.

    An empty table gives no rows. Other columns are ignored. A text of any
    length is one turn; a kept conversation's rendered text is one value.
    """
    prefixes = written(turn_prefixes(turns), "turn-prefixes")
    kept = written(maximal(prefixes), "kept-conversations")
    said = F.struct("pos", rendered().alias("said"))
    named = prefixes.drop("n", "hash").join(kept.filter("conv_id IS NOT NULL").drop("hash"), "conv_id")
    whole = named.groupBy("conv_id", "n", "n_collapsed").agg(F.array_sort(F.collect_list(said)).alias("turns"))
    whole = whole.select("conv_id", F.col("n").alias("n_turns"), "n_collapsed", F.array_join("turns.said", "").alias("rendered"))
    # Rows without an id and of one hash are equal, so one of them is rendered.
    loose = prefixes.filter("conv_id IS NULL").join(kept.filter("conv_id IS NULL").drop("conv_id", "n"), "hash")
    loose = loose.groupBy("hash", "conv_id", "n", "n_collapsed").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    return whole.unionByName(loose.select("conv_id", F.col("n").alias("n_turns"), "n_collapsed", rendered().alias("rendered")))
