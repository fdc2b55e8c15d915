"""Approximate nearest neighbours by inner product, with learned partitions.

A bounded sample is linked to its nearest neighbours by inner product, and the graph is cut into
balanced parts by repeated bisection that moves vertices to the side of most of
their neighbours. A small softmax classifier learns the parts; every vector is
indexed in its most probable part, and a query searches several of its most
probable parts, as many as a held-back share of the sample needed for the wanted
recall. The inner product of a query x and a candidate y orders candidates as the
cosine of (x, 0) and (y, sqrt(L^2 - |y|^2)) does, so the classifier sees lengths
by this further coordinate. Parts are searched in blocks of bounded size with
exact products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tulha.llm.tables import hash_sample, written

#: Vectors that partitions are learned from (twice as many at most), and neighbours of each in the graph.
SAMPLE_ROWS, GRAPH_NEIGHBOURS = 4000, 10
#: Vectors of one part on average, and parts at most and at least.
PART_ROWS, MOST_PARTS, LEAST_PARTS = 2000, 128, 16
#: Share of the true neighbours that the held-back sample queries must find; what is promised is 0.9.
WANTED_RECALL = 0.95
#: Vectors of a block, and queries of one; a part, however large and however often asked, is searched block by block.
BLOCK_ROWS, QUERY_ROWS = 4000, 4000
#: Share of the sample's vectors that are no longer than L; the classifier sees longer ones as of length L.
USUAL_LENGTHS = 0.99
SEED = 11


@dataclass
class Partitions:
    """The classifier's weights (the last rows for the further coordinate and the intercept), the parts that a query searches, and L."""

    weights: np.ndarray
    probes: int
    usual: float = 1.0

    def log_odds(self, x: np.ndarray, asks: bool) -> np.ndarray:
        seen = as_query(x) if asks else as_candidate(x, self.usual)
        return np.hstack([seen, np.ones((len(x), 1))]) @ self.weights


def as_query(x: np.ndarray) -> np.ndarray:
    """Directions, with a further coordinate of 0; a query's length does not change its neighbours."""
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])


def as_candidate(x: np.ndarray, usual: float) -> np.ndarray:
    """Vectors in units of `usual` with the further coordinate that makes their length 1; longer ones are cut to length 1."""
    x = x / np.maximum(usual, np.linalg.norm(x, axis=1, keepdims=True))
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))])


# --- learning ----------------------------------------------------------------


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row, by inner product."""
    products = x @ x.T
    np.fill_diagonal(products, -np.inf)
    k = min(k, len(x) - 1)
    return np.argpartition(-products, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(x), 0), int)


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row: the graph is halved along its main direction, refined by moves in pairs, and halved again.

    Sizes of the two sides differ in proportion to the parts each is to give, by one row at most.
    """
    label = np.zeros(len(x), int)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        if count <= 1 or len(rows) < 2:
            label[rows] = first
            return
        left_parts = count // 2
        size = len(rows) * left_parts // count
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.random.default_rng(SEED + first).normal(size=x.shape[1])
        for _ in range(20):
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) + 1e-30
        place = np.full(len(x), -1)
        place[rows] = np.arange(len(rows))
        own = place[near[rows]]
        source, k = np.nonzero(own >= 0)
        target = own[source, k]
        side = np.zeros(len(rows), bool)
        side[np.argsort(centred @ axis, kind="stable")[:size]] = True
        for _ in range(30):  # swap those that would gain most, equally many from either side
            pull = np.zeros(len(rows))
            sign = np.where(side, 1.0, -1.0)
            np.add.at(pull, source, sign[target])
            np.add.at(pull, target, sign[source])
            gain = -pull * sign
            a, b = np.flatnonzero(side), np.flatnonzero(~side)
            a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
            n = min(len(a), len(b))
            swap = int(np.argmin(np.append(gain[a[:n]] + gain[b[:n]] > 0, False)))
            swap = (swap + 1) // 2
            if not swap:
                break
            side[a[:swap]], side[b[:swap]] = False, True
        halve(rows[side], first, left_parts)
        halve(rows[~side], first + left_parts, count - left_parts)

    halve(np.arange(len(x)), 0, parts)
    return label


def _softmax(x: np.ndarray, label: np.ndarray, parts: int, steps: int = 300) -> np.ndarray:
    """Weights of a softmax regression by gradient steps with momentum."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, speed = np.zeros((a.shape[1], parts)), 0.0
    goal = np.eye(parts)[label]
    for _ in range(steps):
        z = a @ w
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + a.T @ (goal - p) / len(a) - 1e-4 * w
        w = w + 4.0 * speed
    return w


def learn(vectors: DataFrame, rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS) -> Partitions:
    """Partitions for a table of (vec_id, vector), learned from about `rows` of them."""
    total = vectors.count()
    found = hash_sample(vectors, "vec_id", rows).toPandas().sort_values("vec_id", kind="stable")
    if not len(found):
        return Partitions(np.zeros((1, 1)), 1)
    width = found["vector"].map(len).max()
    x = np.stack([v for v in found["vector"] if len(v) == width])
    usual = float(np.quantile(np.linalg.norm(x, axis=1), USUAL_LENGTHS))
    parts = int(min(MOST_PARTS, max(LEAST_PARTS, total // part_rows), max(1, len(x) // 8)))
    held = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
    base = x[~held]
    seen = as_candidate(base, usual)
    weights = _softmax(seen, balanced_parts(seen, _graph(base, GRAPH_NEIGHBOURS), parts), parts)
    partitions = Partitions(weights, parts, usual)
    if held.any():
        of = partitions.log_odds(base, asks=False).argmax(axis=1)
        order = np.argsort(-partitions.log_odds(x[held], asks=True), axis=1)
        true = np.argsort(-(x[held] @ base.T), axis=1, kind="stable")[:, : min(20, len(base))]
        rank = np.argsort(order, axis=1)
        needed = np.take_along_axis(rank, of[true], axis=1)
        shares = [(needed < probes).mean() for probes in range(1, parts + 1)]
        partitions.probes = int(np.argmax(np.array(shares) >= WANTED_RECALL)) + 1
    return partitions


# --- search ------------------------------------------------------------------


def clean_vectors(frame: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector of doubles) of the rows whose vector can take part: not NULL, not zero, all components finite."""
    value = F.col(embedding).cast("array<double>")
    finite = F.forall(value, lambda v: F.isnotnull(v) & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return frame.select(F.col(vec_id).alias("vec_id"), value.alias("vector")).filter(finite & F.exists("vector", lambda v: v != 0))


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of each vector length: length, row numbers, matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    return [(int(n), rows := np.flatnonzero(lengths == n), flat[starts[rows][:, None] + np.arange(n)]) for n in np.unique(lengths)]


def _routed(vectors: DataFrame, partitions: Partitions, probes: int, asks: bool) -> DataFrame:
    """(vec_id, vector, part) for the most probable parts; vectors of a length the classifier does not know go to part -n."""
    shared = vectors.sparkSession.sparkContext.broadcast(partitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = shared.value
            for n, rows, x in _matrix(batch.column("vector")):
                if n + 2 == len(known.weights):
                    top = np.argsort(-known.log_odds(x, asks), axis=1, kind="stable")[:, :probes]
                else:
                    top = np.full((len(rows), 1), -n)
                part = batch.take(pa.array(np.repeat(rows, top.shape[1])))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("vector"), pa.array(top.ravel().astype(np.int64))], ["vec_id", "vector", "part"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, part long")


def _searched(blocks: DataFrame, k: int) -> DataFrame:
    """The k nearest of each block's candidates for each of its queries."""

    def search(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        out: list[list[np.ndarray]] = [[], [], []]
        for _, rows, x in _matrix(table.column("vector")):
            own, is_query = ids[rows], asks[rows]
            order = np.argsort(own[~is_query], kind="stable")
            base, base_ids = x[~is_query][order], own[~is_query][order]
            query, query_ids = x[is_query], own[is_query]
            longest = np.linalg.norm(base, axis=1).max(initial=0)
            for at in range(0, len(query), 256):
                product = query[at : at + 256] @ base.T
                product[query_ids[at : at + 256][:, None] == base_ids[None, :]] = -np.inf
                n = min(k, len(base_ids))
                if not n:
                    continue
                # Products are rounded in an order that depends on the block, so what may be among the first n is multiplied
                # anew, row by row: equal vectors then have equal scores, and ties go to the smaller id.
                slack = 1e-12 * np.linalg.norm(query[at : at + 256], axis=1) * longest
                border = (np.partition(product, -n, axis=1)[:, -n] if n < len(base_ids) else np.full(len(product), -np.inf)) - slack
                for i, row in enumerate(product):
                    held = np.flatnonzero((row >= border[i]) & (row > -np.inf))
                    score = (base[held] * query[at + i]).sum(axis=1)
                    first = np.lexsort((base_ids[held], -score))[:n]
                    best, score = held[first], score[first]
                    out[0].append(np.full(len(best), query_ids[at + i]))
                    out[1].append(base_ids[best])
                    out[2].append(score)
        joined = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2].astype(np.float64))})

    return blocks.groupBy("part", "block", "query_block").applyInArrow(search, "query_id long, vec_id long, score double")


def _numbers(count: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(count) - 1)


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int = 20, partitions: Partitions | None = None, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of `vectors` found for each of `queries`, both (vec_id, vector).

    A query is not its own neighbour. Ties go to the smaller vec_id; vectors of
    another length than a query's are not compared with it. Of rows with equal
    vec_id each counts, as a candidate and once as a query; a NULL vec_id takes
    no part. An empty table gives no rows. No task holds more than about
    `block_rows` candidates and `query_rows` queries at once.
    """
    vectors, queries = vectors.filter("vec_id is not null"), queries.filter("vec_id is not null").dropDuplicates(["vec_id"])
    if partitions is None:
        partitions = learn(vectors)
    index = written(_routed(vectors, partitions, 1, asks=False), "index")
    # Blocks hash a part's rows, so one vector that fills a part is spread as well.
    sizes = index.groupBy("part").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    candidates = index.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), "blocks"))
    asked = written(_routed(queries, partitions, partitions.probes, asks=True), "asked")
    turns = asked.groupBy("part").agg(F.ceil(F.count("*") / query_rows).alias("query_blocks"))
    # Each block of candidates meets each block of queries; parts that no query asks are not searched.
    candidates = candidates.join(turns, "part").withColumn("query_block", F.explode(_numbers("query_blocks")))
    asked = asked.join(turns, "part").withColumn("query_block", F.pmod(F.xxhash64("vec_id"), "query_blocks"))
    asked = asked.join(sizes, "part").withColumn("block", F.explode(_numbers("blocks")))
    columns = ["part", "block", "query_block", "vec_id", "vector"]
    blocks = candidates.select(*columns, F.lit(False).alias("asks")).union(asked.select(*columns, F.lit(True).alias("asks")))
    found = _searched(blocks, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
