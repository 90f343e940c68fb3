"""Approximate nearest neighbours by learned partitions.

1. On a bounded sample of vectors, the graph of nearest neighbours is cut into parts of equal size:
   each part is bisected at the median of the graph's second eigenvector, and swaps of nodes that
   cut fewer edges refine the halves.
2. A softmax classifier learns the parts, and every vector of the table belongs to the part it
   finds most probable. A second one, the router, learns what share of a point's true neighbours
   lies in each part.
3. A query visits the parts the router finds most probable, until they hold ``coverage`` of its
   neighbours by the router's own estimate, and its inner products with all their vectors are
   computed. Parts are cut into blocks of bounded size, so a part with a third of all vectors is
   many tasks' work; each (query, block) keeps its best, and the best of all blocks are merged.

Equal vectors are one entry with its smallest ids: more than ``k + 1`` of them can never be
needed, as ties go to smaller ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civiclake.plans.scratch import written

#: Vectors the partitions and the router are fitted on at most, by the order of a hash of their id.
SAMPLE_VECTORS = 8192

#: Levels of bisection (2 ** LEVELS parts) and edges per node of the neighbour graph.
LEVELS = 5
EDGES = 16

#: Share of the neighbours that the visited parts should hold by the router's estimate.
COVERAGE = 0.95

#: Distinct vectors of one block, queries that meet a block in one task, and scored at a time.
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 16384
QUERIES_AT_A_TIME = 512

#: Inner products this close, relative to the norms, are computed again before they are compared.
SLACK = 1e-9


def nearest_in(points: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` largest inner products of each row with the others."""
    out = np.empty((len(points), k), np.int64)
    for at in range(0, len(points), 1024):
        scores = points[at : at + 1024] @ points.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        out[at : at + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def second_vector(edges: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 60) -> np.ndarray:
    """An approximate second eigenvector of the graph's normalised adjacency, by power iteration."""
    degree = np.sqrt(np.bincount(edges[:, 0], minlength=size) + 1e-9)
    x = rng.standard_normal(size)
    for _ in range(rounds):
        x -= degree * (degree @ x) / (degree @ degree)
        y = np.bincount(edges[:, 0], x[edges[:, 1]] / (degree[edges[:, 0]] * degree[edges[:, 1]]), minlength=size)
        x = x + y
        x /= np.linalg.norm(x) + 1e-300
    return x / degree


def bisect_balanced(edges: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Two halves of equal size with few edges between them, as a boolean side per node."""
    side = np.zeros(size, bool)
    side[np.argsort(second_vector(edges, size, rng), kind="stable")[size // 2 :]] = True
    for _ in range(30):
        across = side[edges[:, 0]] != side[edges[:, 1]]
        gain = np.bincount(edges[:, 0], np.where(across, 1.0, -1.0), minlength=size)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        pairs = min(len(left), len(right), max(1, size // 50))
        better = gain[left[:pairs]] + gain[right[:pairs]] > 2
        if not better.any():
            break
        side[left[:pairs][better]], side[right[:pairs][better]] = True, False
    return side


def balanced_parts(points: np.ndarray, levels: int, edges: int, seed: int = 7) -> np.ndarray:
    """A part number for each point, parts of equal size up to one point."""
    rng = np.random.default_rng(seed)
    near = nearest_in(points, min(edges, len(points) - 1))
    pairs = np.c_[np.repeat(np.arange(len(points)), near.shape[1]), near.reshape(-1)]
    pairs = np.unique(np.r_[pairs, pairs[:, ::-1]], axis=0)
    part = np.zeros(len(points), np.int64)
    for _ in range(levels):
        new = part * 2
        for own in np.unique(part):
            nodes = np.flatnonzero(part == own)
            if len(nodes) < 2:
                continue
            number = np.full(len(points), -1)
            number[nodes] = np.arange(len(nodes))
            inside = number[pairs[(part[pairs[:, 0]] == own) & (part[pairs[:, 1]] == own)]]
            new[nodes] += bisect_balanced(inside, len(nodes), rng)
        part = new
    return part


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_softmax(points: np.ndarray, targets: np.ndarray, rounds: int = 300, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (features and a constant, classes) that predict rows of ``targets``, by Adam steps."""
    x = np.c_[points, np.ones(len(points))]
    weights = np.zeros((x.shape[1], targets.shape[1]))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for n in range(1, rounds + 1):
        gradient = x.T @ (softmax(x @ weights) - targets) / len(x) + decay * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= rate * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-9)
    return weights


class Router:
    """The two classifiers, fitted on a sample."""

    def __init__(self, sample: np.ndarray, levels: int = LEVELS, k: int = 20, scale: float = 1.0) -> None:
        self.scale = scale
        x = sample * scale
        levels = max(0, min(levels, int(np.log2(max(len(x) // (2 * k), 1)))))
        if levels == 0:
            self.member = self.visit = np.zeros((x.shape[1] + 1, 1))
            return
        classes = 1 << levels
        hard = np.eye(classes)[balanced_parts(x, levels, EDGES)]
        self.member = fit_softmax(x, hard)
        part = self.parts(sample)
        near = nearest_in(x, min(k, len(x) - 1))
        shares = np.zeros((len(x), classes))
        np.add.at(shares, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].reshape(-1)), 1 / near.shape[1])
        self.visit = fit_softmax(x, shares)

    def _logits(self, points: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return (points * self.scale) @ weights[:-1] + weights[-1]

    def parts(self, points: np.ndarray) -> np.ndarray:
        return self._logits(points, self.member).argmax(1)

    def visits(self, points: np.ndarray, coverage: float, sizes: np.ndarray, least: int) -> np.ndarray:
        """Which parts each query visits: the most probable up to ``coverage`` and ``least`` vectors."""
        p = softmax(self._logits(points, self.visit))
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p, held = np.take_along_axis(p, order, 1), sizes[order]
        needed = (np.cumsum(sorted_p, 1) - sorted_p < coverage) | (np.cumsum(held, 1) - held < least)
        out = np.zeros_like(needed)
        np.put_along_axis(out, order, needed, 1)
        return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): vectors of double precision that take part, one per id (the smallest, if an id has several)."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col(id_column).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return kept.groupBy(F.col(id_column).cast("bigint").alias("id")).agg(F.min(v).alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def best_of_block(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """Each query's ``k`` best ids of the block, its own left out, ties to smaller ids."""
    out: tuple[list[int], list[int], list[float]] = ([], [], [])
    if queries.num_rows and block.num_rows:
        points, ids = _matrix(block.column("v")), block.column("ids").to_pylist()
        norm = np.sqrt((points * points).sum(1).max())
        keys, vectors = queries.column("id").to_pylist(), _matrix(queries.column("v"))
        for at in range(0, len(keys), QUERIES_AT_A_TIME):
            part = vectors[at : at + QUERIES_AT_A_TIME]
            scores = part @ points.T
            # k + 1 distinct vectors hold k ids besides the query's own; what may tie with the last is kept
            rank = min(k + 1, len(points))
            last = np.partition(scores, len(points) - rank, axis=1)[:, len(points) - rank]
            slack = SLACK * norm * np.sqrt((part * part).sum(1))
            for key, query, row, limit in zip(keys[at:], part, scores, last - slack):
                near = np.flatnonzero(row >= limit)
                exact = (points[near] * query).sum(1)
                found = [(-score, own) for n, score in zip(near.tolist(), exact.tolist()) for own in ids[n] if own != key]
                for score, own in sorted(found)[:k]:
                    out[0].append(key)
                    out[1].append(own)
                    out[2].append(-score)
    types = pa.int64(), pa.int64(), pa.float64()
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, out, types))))


def nearest(
    vectors: DataFrame,
    k: int = 20,
    query_divisor: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    coverage: float = COVERAGE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for ids divisible by ``query_divisor`` the ``k`` nearest found.

    Nearness is the largest inner product in double precision; ties go to the smaller id; a query
    is not its own neighbour, but other ids with its vector are neighbours. Vectors that are null,
    zero, or hold null or non-finite components, rows without id, and vectors of another length
    than most of the sample take no part. Rows that repeat an id count once. With fewer than ``k``
    candidates all are returned; an empty table gives an empty table. Every vector is indexed; only
    the fit of partitions and router uses a sample, of ``SAMPLE_VECTORS``.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, vec_id bigint, score double"
    every = usable(vectors, id_column, vector_column)
    sample = every.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_VECTORS).collect()
    lengths = [len(r.v) for r in sample]
    if not lengths:
        return spark.createDataFrame([], schema).selectExpr("query_id", "0 AS rank", "vec_id", "score")
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    points = np.array([r.v for r in sample if len(r.v) == length])
    scale = np.sqrt(length) / np.sqrt((points * points).sum(1).mean())
    shared = spark.sparkContext.broadcast(Router(points, k=k, scale=scale))
    every = every.where(F.size("v") == length)
    first = F.row_number().over(W.partitionBy("v").orderBy("id"))
    entries = every.withColumn("n", first).where(F.col("n") <= k + 1)
    entries = entries.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def assigned(batches):
        for batch in batches:
            if batch.num_rows:
                part = shared.value.parts(_matrix(batch.column(0)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], ["v", "ids", "part"])

    entries = written(entries.select("v", "ids").mapInArrow(assigned, "v array<double>, ids array<bigint>, part bigint"), "parts")
    counts = {r.part: (r.n, r.m) for r in entries.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("m")).collect()}
    classes = shared.value.visit.shape[1]
    sizes = np.array([counts.get(p, (0, 0))[1] for p in range(classes)], np.int64)
    blocks = [-(-counts.get(p, (0, 0))[0] // BLOCK_VECTORS) for p in range(classes)]
    queries = every.where(F.col("id") % query_divisor == 0)
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def routed(batches):
        for batch in batches:
            if batch.num_rows:
                for at in range(0, batch.num_rows, 1024):
                    rows = batch.slice(at, 1024)
                    visits = shared.value.visits(_matrix(rows.column(1)), coverage, sizes, k + 1)
                    query, part = np.nonzero(visits)
                    times = np.array(blocks)[part]
                    query, part = np.repeat(query, times), np.repeat(part, times)
                    block = np.arange(len(part)) - np.repeat(np.cumsum(times) - times, times)
                    picked = rows.take(pa.array(query))
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns, pa.array(part, pa.int64()), pa.array(block, pa.int64())], ["id", "v", "part", "block"]
                    )

    visited = queries.select("id", "v").mapInArrow(routed, "id bigint, v array<double>, part bigint, block bigint")
    visited = visited.withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(query_blocks)))
    per_part = F.element_at(F.array(*map(F.lit, blocks)), (F.col("part") + 1).cast("int"))
    block = F.pmod(F.xxhash64("v"), per_part.cast("bigint"))
    turns = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))
    cut = entries.withColumn("block", block).withColumn("turn", turns)
    keys = ["part", "block", "turn"]

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return best_of_block(left, right, k)

    found = visited.groupBy(*keys).cogroup(cut.groupBy(*keys)).applyInArrow(scored, schema)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
