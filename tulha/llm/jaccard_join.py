"""Jaccard self-join of documents over sets of word n-grams, by chosen paths.

A set stands for the distinct n-grams of a text. Its sketch holds minimum
hashes: tokens that two sets share as often as their Jaccard similarity says.
Every run splits all sets along paths of tokens that a node's own hash samples,
1/similarity of them on average, so that two sets that are similar enough meet
in at least one child again. Buckets that are small are compared by brute
force; larger ones are split on, and after the last level they are kept whole.
Runs are repeated until the chance that a similar pair met in none of them is
under the target. Buckets give links between sketches that look similar;
the sets of each linked component are then compared exactly, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.components import components
from tulha.llm.filters import build_filter, passes
from tulha.llm.tables import TEXT_KEY, text_key, written
from tulha.llm.words import mix, words_of

GRAM_WORDS = 5
SIMILARITY = 0.8
#: Minimum hashes of a sketch, 16 bits each.
SKETCH = 64
#: Sketches agree this much less than sets by chance in 1 of 30,000 pairs at 0.8 (four deviations).
SKETCH_SLACK = 0.2
#: Sets that one bucket compares at once; levels that every set is split along, and after which buckets are kept whole.
BUCKET_SETS, FIRST_LEVELS, LEVELS = 2000, 2, 4
TARGET_RECALL = 0.9999
#: Grams that one block of a component holds, on average.
BLOCK_GRAMS = 200_000

_SEEDS = mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, SKETCH + 1001, dtype=np.uint64))


def runs_needed(similarity: float = SIMILARITY, levels: int = LEVELS, target: float = TARGET_RECALL) -> int:
    """Runs after which a pair of just this similarity has met with the target's chance."""
    meets, second = 1.0, 1 / similarity - 1
    for _ in range(levels):
        step = similarity * meets
        meets = (1 - second) * step + second * (1 - (1 - step) ** 2)
    return math.ceil(math.log(1 - target) / math.log(1 - meets))


# --- sets and sketches -------------------------------------------------------


def _gram_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's distinct n-grams, sorted; a text of fewer words is one gram; one without words has none."""
    for words in words_of(column):
        per_row = words.per_row()
        first, grams = words.grams(k)
        ends = np.searchsorted(words.row[first], np.arange(len(per_row)), "right")
        word_ends = np.cumsum(per_row)
        begin = 0
        for row, end in enumerate(ends):
            if end > begin:
                yield words.first + row, np.unique(grams[begin:end])
            elif n := int(per_row[row]):
                own = words.hash[word_ends[row] - n : word_ends[row]]
                total = np.uint64(n)
                with np.errstate(over="ignore"):
                    for value in own:
                        total = mix(np.array([total * np.uint64(31) + value], np.uint64))[0]
                yield words.first + row, np.array([total], np.uint64)
            else:
                yield words.first + row, grams[:0]
            begin = end


def _set_key(grams: np.ndarray) -> tuple[int, int]:
    """Two sums that stand for the set."""
    if not len(grams):
        return 0, 0
    other = mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    return int(grams.sum(dtype=np.uint64).view(np.int64)), int(other.sum(dtype=np.uint64).view(np.int64))


def _sketch(grams: np.ndarray) -> bytes:
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 4096):
        part = grams[None, at : at + 4096] * _SEEDS[:, None] + _SHIFTS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (mix(least) >> np.uint64(48)).astype(np.uint16).tobytes()


def _sketched(documents: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, sketches = [], [], []
            for _, grams in _gram_sets(batch.column("text"), k):
                keys.append(_set_key(grams))
                sizes.append(len(grams))
                sketches.append(_sketch(grams) if len(grams) else b"")
            added = [pa.array([x[0] for x in keys], pa.int64()), pa.array([x[1] for x in keys], pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *added], [*batch.schema.names[:-1], *SET_KEY, "n_grams", "sketch"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields[:-1])
    return documents.mapInArrow(run, f"{fields}, set_key long, set_key_2 long, n_grams long, sketch binary")


SET_KEY = ("set_key", "set_key_2")


# --- chosen paths ------------------------------------------------------------


def _children(nodes: np.ndarray, sketches: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows that go on, and the child node that each goes to."""
    draw = mix(nodes)
    one = (draw % np.uint64(SKETCH)).astype(np.int64)
    two = ((one + 1 + ((draw >> np.uint64(8)) % np.uint64(SKETCH - 1)).astype(np.int64)) % SKETCH).astype(np.int64)
    more = np.flatnonzero((draw >> np.uint64(40)) < np.uint64(int((1 / similarity - 1) * (1 << 24))))
    rows = np.concatenate([np.arange(len(nodes)), more])
    place = np.concatenate([one, two[more]])
    token = sketches[rows, place].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(16))
    return rows, mix(nodes[rows] * np.uint64(0x9E3779B97F4A7C15) + mix(token + np.uint64(1)))


def _split(sets: DataFrame, similarity: float, runs: int | None = None) -> DataFrame:
    """(node, id): the children of each row's node, or the nodes some levels below the roots of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            if not len(ids):
                continue
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
            roots = [np.full(len(ids), mix(np.array([r + 1], np.uint64))[0]) for r in range(runs)] if runs else [batch.column("node").to_numpy().view(np.uint64)]
            for nodes in roots:
                rows, child = _children(nodes, sketches, similarity)
                for _ in range(FIRST_LEVELS - 1 if runs else 0):
                    further, child = _children(child, sketches[rows], similarity)
                    rows = rows[further]
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[rows])], ["node", "id"])

    return sets.mapInArrow(run, "node long, id long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, whichever batches they come in."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        edges = np.zeros(rest.num_rows, bool)
        edges[0] = True
        for key in keys:
            value = rest.column(key).to_numpy()
            edges[1:] |= value[1:] != value[:-1]
        starts = np.flatnonzero(edges)
        rest = rest.combine_chunks()
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            yield rest.slice(begin, end - begin)
        rest = rest.slice(starts[-1])
    if rest is not None:
        yield rest


def _stars(links: np.ndarray) -> np.ndarray:
    """For each node of a small symmetric link matrix, the least node of its component."""
    root = np.arange(len(links))
    while True:
        lower = np.minimum(root, np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links)))
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def _similar_sketches(buckets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) of a forest over each bucket's sets whose sketches agree in `least` places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from_, to = [], []
        for group in _groups(batches, ["node"]):
            ids = group.column("id").to_numpy()
            if len(ids) > 1:
                sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
                if len(ids) == 2:
                    root = np.array([0, 0 if np.count_nonzero(sketches[0] == sketches[1]) >= least else 1])
                else:
                    agree = np.zeros((len(ids), len(ids)), np.uint8)
                    for place in range(SKETCH):
                        agree += sketches[:, None, place] == sketches[None, :, place]
                    root = _stars(agree >= least)
                hang = np.flatnonzero(root != np.arange(len(ids)))
                from_.append(ids[hang])
                to.append(ids[root[hang]])
            if len(from_) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(from_)), pa.array(np.concatenate(to))], ["a", "b"])
                from_, to = [], []
        if from_:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(from_)), pa.array(np.concatenate(to))], ["a", "b"])

    dealt = buckets.select("node", "id", "sketch").repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(run, "a long, b long")


def candidate_links(sets: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> DataFrame:
    """Links (a, b) that join all sets (id, sketch) which met on a chosen path and whose sketches look similar."""
    least = math.floor(SKETCH * (similarity - SKETCH_SLACK))
    rows = written(_split(sets, similarity, runs_needed(similarity, LEVELS, target_recall)), "paths")
    links = []
    for level in range(FIRST_LEVELS, LEVELS + 1):
        sizes = written(rows.groupBy("node").count().filter("count > 1"), "buckets")
        small = rows.join(sizes.filter(F.col("count") <= BUCKET_SETS), "node").join(sets, "id")
        links.append(_similar_sketches(small, least))
        large = sizes.filter(F.col("count") > BUCKET_SETS)
        if (sizes.agg(F.max("count")).first()[0] or 0) <= BUCKET_SETS:
            break
        rows = rows.join(large, "node").select("node", "id")
        if level < LEVELS:
            rows = written(_split(rows.join(sets, "id").select("node", "id", "sketch"), similarity), "paths")
        else:
            # Sets that still share a bucket hang together without a look at their sketches; the exact check sorts them out.
            hub = rows.groupBy("node").agg(F.min("id").alias("b"))
            links.append(rows.join(hub, "node").select(F.col("id").alias("a"), "b").filter("a <> b"))
    return reduce(DataFrame.union, links)


# --- exact comparison --------------------------------------------------------


def _rebuilt_sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(id, grams) of the wanted texts, made again from the texts; a filter of fixed size spares the others the work."""
    table = documents.sparkSession.sparkContext.broadcast(build_filter(wanted, TEXT_KEY[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(TEXT_KEY[0]).to_numpy()
            rows = np.flatnonzero(passes(table.value, keys.view(np.uint64)))
            # Copies within a task are made once; the set of keys seen is bounded.
            new = []
            for row in rows:
                if int(keys[row]) not in seen:
                    new.append(row)
                    seen.add(int(keys[row]))
            if len(seen) > 200_000:
                seen.clear()
            if new:
                part = batch.take(pa.array(new, pa.int64()))
                made = [grams.tobytes() for _, grams in _gram_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, pa.binary())], [*TEXT_KEY, "grams"])

    made = documents.select(*text_key(), "text").mapInArrow(run, f"{TEXT_KEY[0]} long, {TEXT_KEY[1]} long, grams binary")
    return made.join(wanted, list(TEXT_KEY)).select("id", "grams").dropDuplicates(["id"])


def _block_links(blocks: DataFrame, similarity: float) -> DataFrame:
    """For each block pair: rows (id, other, links); `links` counts similar documents of the other block, `other` hangs the set on a similar one.

    Rows of one key come from one block (side 0) or two (sides 0 and 1). Sets are
    compared through a product of incidence matrices, some columns at a time.
    """
    exact = round(similarity * 1000)

    def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        if len(left) * len(right) <= 16:
            return np.array([[len(np.intersect1d(a, b, True)) for b in right] for a in left])
        grams = np.concatenate([*left, *right])
        owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
        _, column, count = np.unique(grams, return_inverse=True, return_counts=True)
        often = count > 1
        place = np.cumsum(often) - 1
        used = often[column]
        owner, column = owner[used], place[column[used]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        total = np.zeros((len(left), len(right)), np.float32)
        step = 8192
        for at in range(0, int(often.sum()), step):
            begin, end = np.searchsorted(column, [at, at + step])
            matrix = np.zeros((len(left) + len(right), step), np.float32)
            matrix[owner[begin:end], column[begin:end] - at] = 1
            total += matrix[: len(left)] @ matrix[len(left) :].T
        return total.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, others, links = [], [], []
        for group in _groups(batches, ["component", "i", "j"]):
            side = group.column("side").to_numpy()
            own = group.column("id").to_numpy()
            copies = group.column("copies").to_numpy()
            grams = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
            a = np.flatnonzero(side == 0)
            b = a if group.column("i")[0].as_py() == group.column("j")[0].as_py() else np.flatnonzero(side == 1)
            if not len(a) or not len(b):
                continue
            size = np.array([len(x) for x in grams])
            both = shared([grams[x] for x in a], [grams[x] for x in b])
            near = both * 1000 >= exact * (size[a][:, None] + size[b][None, :] - both)
            if a is b:
                np.fill_diagonal(near, False)
            for rows, cols, hit in ((a, b, near),) if a is b else ((a, b, near), (b, a, near.T)):
                n = hit @ copies[cols]
                some = np.flatnonzero(n)
                ids.append(own[rows[some]])
                others.append(own[cols[hit[some].argmax(axis=1)]])
                links.append(n[some])
            if a is b:  # within a block the forest is finished here
                root = _stars(near)
                hang = np.flatnonzero(root != np.arange(len(a)))
                ids.append(own[a[hang]])
                others.append(own[a[root[hang]]])
                links.append(np.zeros(len(hang), np.int64))
            else:
                extra = _forest(near)
                ids.append(own[a[extra[0]]])
                others.append(own[b[extra[1]]])
                links.append(np.zeros(len(extra[0]), np.int64))
            if len(ids) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (ids, others, links)], ["id", "other", "links"])
                ids, others, links = [], [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (ids, others, links)], ["id", "other", "links"])

    dealt = blocks.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return dealt.mapInArrow(run, "id long, other long, links long")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of two blocks that connect all that the full matrix connects, at most one for each set."""
    n, m = near.shape
    whole = np.zeros((n + m, n + m), bool)
    whole[:n, n:] = near
    whole[n:, :n] = near.T
    root = _stars(whole)
    # A component's least node is of the left block unless the component is a lone right set.
    left, right = [], []
    reached = np.zeros(n + m, bool)
    for start in np.unique(root[:n]):
        queue = [int(start)]
        reached[start] = True
        while queue:
            node = queue.pop()
            for other in np.flatnonzero(whole[node] & ~reached):
                reached[other] = True
                queue.append(int(other))
                left.append(min(node, other))
                right.append(max(node, other) - n)
    return np.array(left, np.int64), np.array(right, np.int64)


def jaccard_classes(documents: DataFrame, k: int = GRAM_WORDS, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per document row: doc_id, class_id, n_links, n_copies, n_grams, keeper and the text's key.

    class_id is the least doc_id of all documents connected by links, a link
    being a pair of the given similarity or more. n_links counts the other
    documents linked to this one directly, n_copies those with the same set,
    itself among them. keeper marks one row of each class. NULL, empty and
    wordless texts have no set and are classes of their own; a text of fewer
    than k words is one gram; equal rows are copies; a NULL doc_id comes after all
    others and gives a NULL class_id only where the class has no other.
    """
    rows = documents.select("doc_id", F.monotonically_increasing_id().alias("_row"), *text_key(), "text")
    docs = written(_sketched(rows, k), "sketches")
    held = docs.filter("n_grams > 0")
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "_row", *TEXT_KEY)).alias("first")
    sets = held.groupBy(*SET_KEY, "n_grams", "sketch").agg(F.count("*").alias("copies"), first)
    sets = written(sets.select(*SET_KEY, "n_grams", "sketch", "copies", "first", F.col("first._row").alias("id")), "sets")
    near = components(candidate_links(sets.select("id", "sketch"), similarity, target_recall))
    members = written(near.join(sets, near["node"] == sets["id"]).select("id", "component", "copies", "n_grams", *[F.col(f"first.{c}").alias(c) for c in TEXT_KEY]), "members")
    found = written(_verified(documents, members, k, similarity), "verified")
    classes = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = sets.join(links, "id", "left").join(classes, sets["id"] == classes["node"], "left").withColumn("component", F.coalesce("component", "id"))
    least = joined.groupBy("component").agg(F.min(F.struct("first.none", "first.doc_id", "first._row")).alias("least"))
    joined = joined.join(least, "component").select(*SET_KEY, "n_grams", "copies", F.coalesce("links", F.lit(0)).alias("links"), "least")
    whole = docs.drop("sketch").join(joined, [*SET_KEY, "n_grams"], "left")
    alone = F.isnull("least")
    return whole.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        "n_grams",
        F.when(alone, F.lit(True)).otherwise(F.col("least._row") == F.col("_row")).alias("keeper"),
        *TEXT_KEY,
    )


def _verified(documents: DataFrame, members: DataFrame, k: int, similarity: float) -> DataFrame:
    sets = _rebuilt_sets(documents, members.select("id", *TEXT_KEY), k)
    weight = members.groupBy("component").agg(F.ceil(F.sum("n_grams") / BLOCK_GRAMS).alias("n_blocks"))
    placed = members.join(weight, "component").withColumn("block", F.pmod(F.xxhash64("id"), "n_blocks"))
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    dealt = dealt.select("id", "component", "copies", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), (F.col("block") > F.col("with")).cast("int").alias("side"))
    return _block_links(dealt.join(sets, "id"), similarity)


def one_of_each(documents: DataFrame, k: int = GRAM_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns: one of each class, the one with the least doc_id."""
    found = written(jaccard_classes(documents, k, similarity), "classes")
    # A row is known by its doc_id and text here; rows equal in both are copies of which one stays.
    key = ["doc_id", *TEXT_KEY]
    counted = found.groupBy(*key).agg(F.max("keeper").alias("keeper"), F.count("*").alias("n"))
    gone = counted.filter("not keeper or n > 1")
    keyed = documents.withColumns(dict(zip(TEXT_KEY, text_key(), strict=True)))
    same = [keyed["doc_id"].eqNullSafe(gone["doc_id"]), *[keyed[c] == gone[c] for c in TEXT_KEY]]
    once = keyed.join(gone.filter("keeper"), same, "left_semi").dropDuplicates(key)
    return keyed.join(gone, same, "left_anti").unionByName(once).drop(*TEXT_KEY)
