"""Partial top-k inside tasks, and the final rank over what the tasks kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCORE_DECIMALS = 6
#: Questions and rows handled together inside a task, bounding the memory of one step.
QUESTION_BLOCK = 256
ROW_BLOCK = 2048
#: Entries that wait at least before they are merged into a block's best.
MERGE_ENTRIES = 8192


class Best:
    """The best k (score descending, id ascending) per question seen so far."""

    def __init__(self, qids: np.ndarray, k: int):
        self.qids, self.k = qids, k
        self.scores: list[np.ndarray] = [np.empty(0)] * len(qids)
        self.ids: list[np.ndarray | None] = [None] * len(qids)

    def offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        held = self.scores[q]
        if len(held) == self.k:  # only rows that can still enter
            chosen = scores >= held[-1]
            if not chosen.any():
                return
            ids, scores = ids[chosen], scores[chosen]
        if len(scores) > 4 * self.k:  # everything below the k-th score is out
            floor = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            chosen = scores >= floor
            ids, scores = ids[chosen], scores[chosen]
        if self.ids[q] is not None:
            ids = np.concatenate([self.ids[q], ids])
            scores = np.concatenate([held, scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids[q], self.scores[q] = ids[order], scores[order]

    def batch(self, qid_type: pa.DataType, id_type: pa.DataType) -> pa.RecordBatch:
        filled = [q for q in range(len(self.qids)) if self.ids[q] is not None]
        counts = [len(self.ids[q]) for q in filled]
        columns = [
            pa.array(np.repeat(self.qids[filled], counts) if filled else [], type=qid_type),
            pa.array(np.concatenate([self.ids[q] for q in filled]) if filled else [], type=id_type),
            pa.array(
                np.concatenate([self.scores[q] for q in filled]) if filled else [],
                type=pa.float64(),
            ),
        ]
        return pa.RecordBatch.from_arrays(columns, ["qid", "id", "score"])


class BlockBest:
    """The best k (score descending, id ascending) of each question of one block.

    Scores come as a matrix of questions and rows; only entries that can still be among
    the best leave it, so a step costs one comparison per entry.
    """

    def __init__(self, n_questions: int, k: int, slack: float = 0.0):
        self.k, self.slack = k, slack
        self.floor = np.full(n_questions, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def candidates(self, scores: np.ndarray, members: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Places (question, row) of a matrix that may be among the best; NaN counts as lowest.

        Scores that lie within ``slack`` below a bound are kept, as rounding may lift them.
        """
        floor = self.floor[members]
        if scores.shape[1] > self.k and np.isneginf(floor).any():
            kth = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            floor = np.fmax(floor, kth)
        with np.errstate(invalid="ignore"):
            bound = floor - (self.slack + np.abs(floor) * 1e-15)
            return np.nonzero(~(scores < bound[:, None]))

    def add(self, questions: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            self.parts.append((questions, ids, scores))
            self.waiting += len(ids)
            if self.waiting > max(MERGE_ENTRIES, self.k * len(self.floor)):
                self.settled()

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``questions, ids, scores`` of the best, by question and rank."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        questions, ids, scores = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -scores, questions))
        questions = questions[order]
        place = np.arange(len(order)) - np.searchsorted(questions, questions)
        kept = place < self.k
        best = questions[kept], ids[order][kept], scores[order][kept]
        full = place == self.k - 1
        self.floor[questions[full]] = np.nan_to_num(scores[order][full], nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        self.parts, self.waiting = [best], 0
        return best


def best_batch(blocks: list[BlockBest], qids: np.ndarray, qid_type: pa.DataType, id_type: pa.DataType) -> pa.RecordBatch:
    """``qid, id, score`` of what the blocks hold; each covers ``QUESTION_BLOCK`` of the questions."""
    found = [block.settled() for block in blocks]
    found = [(q + i * QUESTION_BLOCK, ids, scores) for i, (q, ids, scores) in enumerate(found) if len(q)]
    q, ids, scores = (np.concatenate(c) for c in zip(*found, strict=True)) if found else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(qids[q] if found else [], type=qid_type),
            pa.array(ids, type=id_type),
            pa.array(scores, type=pa.float64()),
        ],
        ["qid", "id", "score"],
    )


def round_scores(values: np.ndarray) -> np.ndarray:
    """Values at ``SCORE_DECIMALS``, halves away from zero as SQL rounds them."""
    scale = 10.0**SCORE_DECIMALS
    return np.copysign(np.floor(np.abs(values) * scale + 0.5) / scale, values) + 0.0


def rank_top(scored: DataFrame, k: int) -> DataFrame:
    """``qid, id, score, rank``: the k best per question; ties go to the smaller id."""
    order = W.partitionBy("qid").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hit_schema(questions: DataFrame, rows: DataFrame) -> str:
    qid = questions.schema["qid"].dataType.simpleString()
    return f"qid {qid}, id {rows.schema['id'].dataType.simpleString()}, score double"


def numpy_values(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        return column.to_numpy()
    return column.to_numpy(zero_copy_only=False)
