"""Exact top-k by inner product: columnar branch and bound.

Vectors and queries meet in a grid of bounded blocks: a vector goes to every
block of queries, a query to every group of vectors, by an equi-join key. Inside
a cell the vectors lie dimension by dimension. Scores are accumulated one block
of dimensions at a time; after each block the largest score still possible (the
partial sum plus the product of the remaining norms) is held against the k-th
best score so far, and the candidates that cannot reach it are dropped from the
arrays before the next block is read. Bounds only skip work: every candidate is
either scored fully or proven to lie below the k best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import matrix, widened

#: Queries in one block, vectors in one group, vectors handled at a time.
QUERY_BLOCK = 4096
VECTOR_GROUP = 16384
STEP = 2048
#: Queries handled at a time, and dimensions read before the bound is tested.
QUERY_STEP = 256
DIM_BLOCK = 16
#: Below this share of survivors single pairs are followed instead of whole rows.
SPARSE = 0.1
#: Whole numbers up to here are exact in double precision.
EXACT = float(1 << 53)


def usable(vector: str) -> Column:
    """True where the vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """The k highest inner products of every query with all other rows.

    Both frames hold an id and a vector of whole numbers (array of bigint); more
    columns are ignored. Result: query_id, rank (from 1), vec_id, score; ties go
    to the smaller id. Repeated equal rows count once; two different vectors with
    one id are two rows. A row never meets a row of its own id. Null ids and null
    vectors take no part; shorter vectors count as ending in zeros; a query with
    fewer than k candidates gets all of them; without queries the result is empty.
    Scores must fit a bigint.
    """
    pick = [F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<bigint>").alias("v")]
    there = F.col("id").isNotNull() & F.col("v").isNotNull()
    base = vectors.select(*pick).filter(there).dropDuplicates()
    asked = queries.select(*pick).filter(there).dropDuplicates()
    n, m = base.count(), asked.count()
    groups, blocks = max(1, math.ceil(n / VECTOR_GROUP)), max(1, math.ceil(m / QUERY_BLOCK))
    # by content, so that a task that is run again deals every row to the same cell
    turn = F.xxhash64("id", "v")
    left = asked.withColumn("qb", F.pmod(turn, F.lit(blocks)).cast("int")).withColumn(
        "vg", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    right = base.withColumn("vg", F.pmod(turn, F.lit(groups)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    cells = (
        left.select("qb", "vg", F.lit(0).alias("kind"), "id", "v")
        .unionByName(right.select("qb", "vg", F.lit(1).alias("kind"), "id", "v"))
        .repartition(min(groups * blocks, 100_000), "qb", "vg")
        .sortWithinPartitions("qb", "vg", "kind")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search_cells(batches, k)

    found = cells.mapInArrow(search, "query_id bigint, q_no bigint, vec_id bigint, score bigint")
    best = W.partitionBy("query_id", "q_no").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


class _Cell:
    """The queries of one cell with their best candidates so far."""

    def __init__(self, k: int):
        self.k = k
        self.ids: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.ready = False

    def add_queries(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(rows)

    def start(self) -> None:
        if self.ready:
            return
        width = max((r.shape[1] for r in self.rows), default=0)
        self.q = np.concatenate([widened(r, width) for r in self.rows]) if self.rows else np.zeros((0, 0), np.int64)
        self.qid = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64)
        self.steps = [
            _Best(self.qid[a:a + QUERY_STEP], self.q[a:a + QUERY_STEP], self.k)
            for a in range(0, len(self.qid), QUERY_STEP)
        ]
        self.ready = True

    def add_vectors(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.start()
        for a in range(0, len(ids), STEP):
            part, own = rows[a:a + STEP], ids[a:a + STEP]
            for best in self.steps:
                best.offer(own, part)

    def result(self) -> Iterator[pa.RecordBatch]:
        self.start()
        for best in self.steps:
            yield best.rows()


class _Best:
    """Up to ``QUERY_STEP`` queries: their k best scores, held in flat arrays."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.at = np.zeros(0, np.int64)
        self.vec = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, rows: np.ndarray) -> None:
        width = max(self.q.shape[1], rows.shape[1])
        q, x = widened(self.q, width), widened(rows, width)
        if not len(q) or not len(x):
            return
        peak = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(width, 1)
        if peak < EXACT:
            at, col, score = self._bounded(q.astype(np.float64), np.ascontiguousarray(x.T, np.float64))
        else:  # whole-number products too large for double precision
            whole = q @ x.T
            at, col = np.divmod(np.arange(whole.size), whole.shape[1])
            score = whole.ravel()
        vec = ids[col]
        other = vec != self.ids[at]
        self._merge(at[other], vec[other], score[other].astype(np.int64))

    def _bounded(self, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, column of x) that may be among the k best, with their scores."""
        width = x.shape[0]
        edges = [*range(0, width, DIM_BLOCK), width] if width else [0, 0]
        q_rest, x_rest = _rest_norms(q.T, edges), _rest_norms(x, edges)
        score = np.zeros((len(q), x.shape[1]))
        at = col = None
        for i in range(len(edges) - 1):
            dims = slice(edges[i], edges[i + 1])
            if at is None:
                score += q[:, dims] @ x[dims]
                limit = self.floor[:, None] - 0.5
                alive = score + np.outer(q_rest[i + 1], x_rest[i + 1]) >= limit
                kept = int(alive.sum())
                if kept < SPARSE * alive.size or i == len(edges) - 2:
                    at, col = np.nonzero(alive)
                    score = score[at, col]
            elif len(at):
                for d in range(edges[i], edges[i + 1]):
                    score += q[at, d] * x[d, col]
                alive = score + q_rest[i + 1][at] * x_rest[i + 1][col] >= self.floor[at] - 0.5
                at, col, score = at[alive], col[alive], score[alive]
        return at, col, np.rint(score)

    def _merge(self, at: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        # most pairs lie below the k-th best even when their bound did not
        good = score >= self.floor[at]
        at, vec, score = at[good], vec[good], score[good]
        at = np.concatenate([self.at, at])
        vec = np.concatenate([self.vec, vec])
        score = np.concatenate([self.score, score])
        order = np.lexsort((vec, -score, at))
        at, vec, score = at[order], vec[order], score[order]
        first = np.searchsorted(at, np.arange(len(self.ids)))
        keep = np.arange(len(at)) - first[at] < self.k
        self.at, self.vec, self.score = at[keep], vec[keep], score[keep]
        count = np.bincount(self.at, minlength=len(self.ids))
        full = count >= self.k
        last = np.cumsum(count) - 1
        self.floor[full] = self.score[last[full]]

    def rows(self) -> pa.RecordBatch:
        columns = [self.ids[self.at], _row_numbers(self.q)[self.at], self.vec, self.score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "q_no", "vec_id", "score"])


def _row_numbers(q: np.ndarray) -> np.ndarray:
    """A number that tells different vectors of one id apart, the same in every task."""
    weights = np.uint64(0x9E3779B97F4A7C15) * (np.arange(q.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    total = (q.astype(np.int64).view(np.uint64) * weights).sum(1, dtype=np.uint64)
    return total.view(np.int64)


def _rest_norms(columns: np.ndarray, edges: list[int]) -> list[np.ndarray]:
    """For each edge the length of what lies beyond it, rounded up."""
    squares = np.zeros((len(edges), columns.shape[1]))
    for i in range(len(edges) - 2, -1, -1):
        block = columns[edges[i]:edges[i + 1]]
        squares[i] = squares[i + 1] + (block * block).sum(0)
    return [np.sqrt(s) * (1 + 1e-12) for s in squares]


def _search_cells(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    key, cell = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        qb, vg, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("qb", "vg", "kind"))
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        turn = np.flatnonzero((np.diff(qb) != 0) | (np.diff(vg) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip([0, *turn], [*turn, batch.num_rows], strict=True):
            if (qb[a], vg[a]) != key:
                if cell:
                    yield from cell.result()
                key, cell = (qb[a], vg[a]), _Cell(k)
            rows = matrix(batch.column("v").slice(a, b - a), np.int64)
            (cell.add_vectors if kind[a] else cell.add_queries)(ids[a:b], rows)
    if cell:
        yield from cell.result()
