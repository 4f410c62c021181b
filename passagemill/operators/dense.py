"""Exact top-k by inner product for a whole batch of questions.

Vectors are scanned where they lie: each task multiplies its Arrow batches with
the question matrix and keeps only the best k per question, so k rows per
question and task reach the shuffle instead of one row per pair. Questions are
shipped to the tasks while they are within a measured bound; a larger batch is
cut into question blocks that meet bounded cells of vectors by an equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .topk import QUESTION_BLOCK, ROW_BLOCK, SCORE_DECIMALS, BlockBest, best_batch, hit_schema, numpy_values, rank_top, round_scores

#: Largest question matrix (rows, bytes) shipped to every task.
SHIP_ROWS = 20_000
SHIP_BYTES = 64 * 1024 * 1024
#: Rows per side in one cell of the block form, and their bytes as doubles. Question
#: blocks grow with the batch, as every block reads all vectors once.
CELL_QUESTIONS = 4_000
MOST_QUESTIONS = 16_384
CELL_VECTORS = 50_000
CELL_BYTES = 32 * 1024 * 1024


class Scorer:
    """The k best vectors of every question, offered in batches of any size."""

    def __init__(self, qids: np.ndarray, questions: np.ndarray, k: int):
        self.qids, self.questions = qids, questions
        self.blocks = [
            BlockBest(min(QUESTION_BLOCK, len(qids) - low), k, 10.0**-SCORE_DECIMALS)
            for low in range(0, len(qids), QUESTION_BLOCK)
        ]

    def offer(self, ids: np.ndarray, column: pa.Array | pa.ChunkedArray) -> None:
        """Rounded inner products of rows and questions, in steps of bounded size."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        for at in range(0, len(column), ROW_BLOCK):
            vectors, here = _matrix(column.slice(at, ROW_BLOCK)).T, ids[at:at + ROW_BLOCK]
            for i, block in enumerate(self.blocks):
                scores = self.questions[i * QUESTION_BLOCK:(i + 1) * QUESTION_BLOCK] @ vectors
                q, row = block.candidates(scores)
                block.add(q, here[row], round_scores(scores[q, row]))

    def batch(self, qid_type: pa.DataType, id_type: pa.DataType) -> pa.RecordBatch:
        return best_batch(self.blocks, self.qids, qid_type, id_type)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column of equal lengths as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _checked(vector: str, dim: int):
    size = F.coalesce(F.size(vector), F.lit(-1))
    return F.when(size == dim, F.col(vector)).otherwise(
        F.raise_error(
            F.concat(F.lit(f"vector of dimension {dim} expected, got "), size.cast("string"))
        )
    )


def dense_topk(
    questions: DataFrame,
    vectors: DataFrame,
    k: int,
    *,
    dim: int,
    vector: str = "embedding",
    id_column: str = "id",
) -> DataFrame:
    """``qid, id, score, rank``: the k best vectors of every question.

    Scores are rounded to six decimals and ties go to the smaller id. Null
    vectors and rows whose ``ok`` column is false are skipped; a vector of
    another dimension is an error.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if "ok" in vectors.columns:
        vectors = vectors.where("ok")
    v = vectors.where(F.col(vector).isNotNull()).select(
        F.col(id_column).alias("id"), _checked(vector, dim).alias("v")
    )
    q = questions.where(F.col(vector).isNotNull()).select("qid", _checked(vector, dim).alias("v"))
    limit = min(SHIP_ROWS, SHIP_BYTES // (8 * dim))
    count = q.limit(limit + 1).count()
    if count <= limit:
        partial = _scan(q, v, k)
    else:
        partial = _cells(q, v, k, q.count(), dim)
    return rank_top(partial, k)


def _scan(questions: DataFrame, v: DataFrame, k: int) -> DataFrame:
    """Map-side partial top-k; the question matrix travels with the task."""
    q = questions.toArrow()
    qids = numpy_values(q.column("qid"))
    matrix = _matrix(q.column("v")) if len(qids) else np.zeros((0, 1))
    qid_type = q.schema.field("qid").type

    def best(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, id_type = Scorer(qids, matrix, k), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            held.offer(numpy_values(batch.column("id")), batch.column("v"))
        if id_type is not None:
            yield held.batch(qid_type, id_type)

    return v.mapInArrow(best, hit_schema(questions, v))


def block_questions(n_questions: int, dim: int, least: int) -> int:
    """Questions of a block: a 32nd of the batch within the bounds of rows and bytes."""
    return max(1, min(max(least, min(MOST_QUESTIONS, n_questions // 32)), CELL_BYTES // (8 * dim)))


def _cells(q: DataFrame, v: DataFrame, k: int, n_questions: int, dim: int) -> DataFrame:
    """Block form for question batches too large to ship.

    Question block x vector cell meet once each; both sides of a meeting are
    bounded, and only its top-k rows leave it.
    """
    blocks = math.ceil(n_questions / block_questions(n_questions, dim, CELL_QUESTIONS))
    cells = max(1, math.ceil(v.count() / max(1, min(CELL_VECTORS, CELL_BYTES // (8 * dim)))))
    left = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(blocks))).withColumn(
        "vc", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    )
    right = v.withColumn("vc", F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    )

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        qids = numpy_values(a.column("qid"))
        held = Scorer(qids, _matrix(a.column("v")) if len(qids) else np.zeros((0, dim)), k)
        held.offer(numpy_values(b.column("id")), b.column("v"))
        types = a.schema.field("qid").type, b.schema.field("id").type
        return pa.Table.from_batches([held.batch(*types)])

    return (
        left.groupBy("qb", "vc")
        .cogroup(right.groupBy("qb", "vc"))
        .applyInArrow(meet, hit_schema(q, v))
    )
