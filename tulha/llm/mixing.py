"""Mixing overlapping sources to target weights.

Documents are aggregated by the set of sources they belong to. A min-cost flow
routes the words of each such pattern to the sources' targets: the first use of
a word is free, each further use costs more than the one before (convex), so
repeats come only where first uses do not suffice. Patterns that share no source
are networks of their own, solved in the tasks that hold them. Documents are then
selected in the order of a seeded hash until the routed words are reached.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tulha.llm.tables import written

#: Words of a text, as the mix counts them.
SIZE_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
TOTAL_SHARE, MAX_REPEATS = 1.5, 2
SEED = "mix-1"
#: Documents are first summed in this many ranges of their hash, so that only one range of a pattern has to be ordered.
HASH_DIGITS = 3


def size_of(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(SIZE_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) with `target`: the weights' share of the total, no source above `repeats` times its size.

    Sources that reach their limit do so in the order of limit over weight; the
    level of the others follows from what those leave. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    capped = sizes.withColumn("weight", weight).withColumn("cap", repeats * F.col("source_size"))
    # Sources in the order in which they reach their limits; sums before each are of whole numbers, so they are exact.
    ranked = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    below = F.coalesce(F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(everything) - below) / left
    levels = capped.withColumn("level", level).withColumn("fits", F.col("weight") * F.col("level") <= F.col("cap"))
    # The level holds from the first source that does not reach its limit.
    found = levels.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
    return found.select("source", "source_size", target.alias("target"))


def min_cost_flow(patterns: list[tuple[tuple, int]], targets: dict, repeats: int = MAX_REPEATS) -> dict[tuple[int, int], dict]:
    """Words that each pattern's n-th use sends to each source: {(pattern, use): {source: words}}.

    The cost of use n is n - 1 for each word; cheapest augmenting paths are
    taken until the targets are met or no words are left.
    """
    sources = sorted({s for members, _ in patterns for s in members}, key=lambda s: (s is None, s))
    index = {s: 2 + i for i, s in enumerate(sources)}
    edges: list[list] = []  # to, capacity left, cost
    graph: dict[int, list[int]] = {}

    def add(a: int, b: int, capacity: float, cost: int) -> int:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            graph.setdefault(x, []).append(len(edges))
            edges.append([y, c, w])
        return len(edges) - 2

    uses: dict[tuple[int, int], dict] = {}
    at = 2 + len(sources)
    for number, (members, size) in enumerate(patterns):
        for use in range(1, repeats + 1):
            add(0, at, size, use - 1)
            uses[number, use] = {s: add(at, index[s], size, 0) for s in members}
            at += 1
    for s in sources:
        add(index[s], 1, round(targets.get(s, 0)), 0)
    potential = [0] * at
    while True:
        distance: dict[int, int] = {0: 0}
        by: dict[int, int] = {}
        queue = [(0, 0)]
        while queue:
            d, node = heapq.heappop(queue)
            if d > distance[node]:
                continue
            for e in graph.get(node, []):
                to, capacity, cost = edges[e]
                new = d + cost + potential[node] - potential[to]
                if capacity > 0 and new < distance.get(to, 1 << 60):
                    distance[to], by[to] = new, e
                    heapq.heappush(queue, (new, to))
        if 1 not in distance:
            break
        furthest = max(distance.values())
        for node in range(at):
            potential[node] += distance.get(node, furthest)
        path, node = [], 1
        while node:
            path.append(by[node])
            node = edges[by[node] ^ 1][0]
        flow = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= flow
            edges[e ^ 1][1] += flow
    return {key: {s: edges[e ^ 1][1] for s, e in routes.items()} for key, routes in uses.items()}


def _routes(patterns: DataFrame, targets: DataFrame, repeats: int) -> DataFrame:
    """(pattern, words): how many words the mix takes of each pattern, repeats counted.

    Every pattern goes through the flow. One whose source no other pattern has is
    a network of its own, which its task solves; those that share sources are one
    network, a row per combination of sources, which the driver solves.
    """
    members = patterns.select("pattern", "size", F.explode("pattern").alias("source"))
    alone = members.groupBy("source").agg(F.max(F.size("pattern")).alias("most"))
    single = members.join(alone.filter("most = 1").drop("most"), members["source"].eqNullSafe(alone["source"]), "left_semi")
    wanted = targets.select("source", F.round("target").cast("long").alias("wanted"))
    networks = single.join(wanted, single["source"].eqNullSafe(wanted["source"])).select("pattern", "size", "wanted")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for pattern, size, target in zip(*[batch.column(c).to_pylist() for c in ("pattern", "size", "wanted")], strict=True):
                flow = min_cost_flow([(tuple(pattern), size)], dict.fromkeys(pattern, target), repeats)
                words.append(sum(sum(sent.values()) for sent in flow.values()))
            yield pa.RecordBatch.from_arrays([batch.column("pattern"), pa.array(words, pa.int64())], ["pattern", "words"])

    solved = networks.mapInArrow(solve, "pattern array<string>, words long")
    touched = members.join(alone.filter("most > 1").drop("most"), members["source"].eqNullSafe(alone["source"]), "left_semi")
    overlapping = touched.select("pattern", "size").distinct().collect()  # one row per combination of sources, not per document
    if not overlapping:
        return solved
    goals = {r["source"]: r["wanted"] for r in wanted.collect()}
    rows = sorted(((tuple(r["pattern"]), r["size"]) for r in overlapping), key=lambda row: ([(s is not None, s or "") for s in row[0]], row[1]))
    flow = min_cost_flow(rows, goals, repeats)
    taken = [(list(members), int(sum(sum(flow[i, use].values()) for use in range(1, repeats + 1)))) for i, (members, _) in enumerate(rows)]
    return solved.unionByName(patterns.sparkSession.createDataFrame(taken, solved.schema))


def mixture(sized: DataFrame, targets: DataFrame, repeats: int = MAX_REPEATS, seed: str = SEED, digits: int = HASH_DIGITS) -> DataFrame:
    """The rows of `sized` (doc_id, size, pattern: sorted array of sources, and more), each with `taken`.

    A pattern that gives w words uses all its documents w // total times, and once
    more those that come first in the order of md5(seed:doc_id:size); the last of
    these gives just the words that are still wanted. So the words taken are the
    routed ones. Empty documents take nothing. Rows with equal doc_id and size
    are ordered by a hash of the whole row.
    """
    return _mixed(_keyed(sized, seed, digits), targets, repeats)


def _keyed(sized: DataFrame, seed: str = SEED, digits: int = HASH_DIGITS) -> DataFrame:
    """The rows with their place in the seeded order, written."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    row = F.xxhash64(*[f"`{c}`" for c in sized.columns])
    return written(sized.withColumns({"_key": key, "_row": row}).withColumn("_range", F.substring("_key", 1, digits)), "sized")


def _mixed(rows: DataFrame, targets: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    ranges = rows.groupBy("pattern", "_range").agg(F.sum("size").alias("range_size"))
    ranges = written(ranges, "ranges")
    patterns = ranges.groupBy("pattern").agg(F.sum("range_size").alias("size"))
    routes = _routes(patterns, targets, repeats)
    total = patterns.join(routes, "pattern").select("pattern", "size", "words")
    whole = F.when(F.col("total") > 0, F.floor(F.col("words") / F.col("total"))).otherwise(0)
    before = F.sum("range_size").over(Window.partitionBy("pattern").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    plan = ranges.withColumn("before", F.coalesce(before, F.lit(0))).join(total.withColumnRenamed("size", "total"), "pattern")
    plan = plan.withColumn("uses", whole).withColumn("rest", F.col("words") - F.col("uses") * F.col("total"))
    state = F.when(F.col("before") >= F.col("rest"), F.lit("none")).when(F.col("before") + F.col("range_size") <= F.col("rest"), F.lit("all")).otherwise("some")
    plan = plan.select("pattern", "_range", "uses", "before", "rest", state.alias("state"))
    placed = rows.join(plan, ["pattern", "_range"])
    extra = F.when(F.col("state") == "all", 1).otherwise(0)
    even = placed.filter("state <> 'some'").withColumn("taken", F.col("size") * (F.col("uses") + extra))
    order = Window.partitionBy("pattern").orderBy("_key", "_row").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = placed.filter("state = 'some'").withColumn("taken", F.col("size") * F.col("uses") + F.greatest(F.lit(0), F.least(F.col("size"), wanted)))
    return even.unionByName(edge).drop("_key", "_row", "_range", "uses", "before", "rest", "state").withColumn("taken", F.col("taken").cast("long"))


ADDED = ("size", "source_size", "target", "taken")


def mix_documents(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each document with size, source_size, target (of its source) and taken words; `keep` names the other columns wanted.

    A NULL source is a source of its own, the last one; a NULL text has size 0;
    with no words at all every target is 0. Columns of the added names are replaced.
    """
    names = [c for c in (documents.columns if keep is None else keep) if c not in ADDED]
    whole = F.struct(*[f"`{c}`" for c in names]).alias("_document")
    rows = _keyed(documents.select(whole, "doc_id", F.col("source").alias("_source"), size_of().alias("size"), F.array("source").alias("pattern")))
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes), "targets")
    joined = _mixed(rows, targets).join(targets, F.col("_source").eqNullSafe(F.col("source")))
    return joined.select(*[F.col("_document")[c].alias(c) for c in names], *ADDED)
