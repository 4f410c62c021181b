"""Keyword ranking: BM25 over a forward index of passages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..functions.vectors import word_counts
from ..session import broadcast_if_small, fits_broadcast, materialize
from .topk import QUESTION_BLOCK, SCORE_DECIMALS, BlockBest, best_batch, hit_schema, numpy_values, rank_top

K1 = 1.2
B = 0.75
#: Copies of a question term when question terms cannot be broadcast, so that
#: the passages of a very frequent term are spread over many tasks.
TERM_SALTS = 32
#: Largest table of question weights (rows, bytes) shipped to every task.
SHIP_WEIGHTS = 1_000_000
SHIP_BYTES = 64 * 1024 * 1024
#: Passages taken apart and passage entries scored in one step inside a task.
STEP_PASSAGES = 512
STEP_ENTRIES = 4_096
#: Parts are whole multiples of 1 / PART_SCALE; a score is rounded to SCORE_UNIT of them.
PART_SCALE = 1e10
SCORE_UNIT = PART_SCALE / 10**SCORE_DECIMALS


def forward_index(passages: DataFrame, *, id_column: str = "id", text: str = "content") -> DataFrame:
    """``id, dl, terms``: token count and distinct terms with counts, made inside the row."""
    words = passages.select(F.col(id_column).alias("id"), tokens(text).alias("w"))
    return words.select("id", *index_columns("w"))


def index_columns(words: str) -> tuple[Column, Column]:
    """``dl`` and ``terms`` from a column of tokens."""
    return (
        F.size(words).cast("bigint").alias("dl"),
        word_counts(words).alias("terms"),
    )


def document_frequencies(index: DataFrame) -> DataFrame:
    """``term, df`` over a forward index; counted before the shuffle."""
    return index.select(F.explode("terms.value").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    )


def question_terms(questions: DataFrame) -> DataFrame:
    return questions.select(
        "qid", F.explode(F.array_distinct(tokens("question"))).alias("term")
    )


def _size(index: DataFrame) -> tuple[int, float]:
    """Passages and their mean length, from the length column alone."""
    n, total = index.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
    return n, (total / n if n and total else 1.0)


def question_weights(
    questions: DataFrame, index: DataFrame, frequencies: DataFrame | None, n: int
) -> DataFrame:
    """``qid, term, idf`` of every question term that occurs in the index."""
    asked = question_terms(questions)
    if frequencies is None:
        wanted = broadcast_if_small(asked.select("term").distinct(), "term")
        terms = index.select(F.explode("terms.value").alias("term"))
        frequencies = (
            terms.join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
        )
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return broadcast_if_small(asked, "term").join(frequencies, "term").select(
        "qid", "term", idf.alias("idf")
    )


def bm25_topk(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    frequencies: DataFrame | None = None,
    *,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """``qid, id, score, rank``: the k best passages per question by BM25.

    A passage is one row of the index, so it is scored where it lies: a term
    that occurs in every passage costs arithmetic but emits nothing, and k rows
    per question and task reach the shuffle. Question weights are shipped to
    the tasks within a measured bound; above it the scores are joined and
    summed by Spark (``bm25_scores``).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    n, mean = _size(index)
    weights = materialize(question_weights(questions, index, frequencies, n), "weights")
    if fits_broadcast(weights, "term", max_rows=SHIP_WEIGHTS, max_bytes=SHIP_BYTES):
        scored = _scored_in_place(weights, index, k, mean, k1, b)
    else:
        scored = _joined_scores(weights, index, mean, k1, b)
    return rank_top(scored, k)


def bm25_scores(
    questions: DataFrame,
    index: DataFrame,
    frequencies: DataFrame | None = None,
    *,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """``qid, id, score`` of every passage that shares a term with the question."""
    n, mean = _size(index)
    return _joined_scores(question_weights(questions, index, frequencies, n), index, mean, k1, b)


def _joined_scores(
    weights: DataFrame, index: DataFrame, mean: float, k1: float, b: float
) -> DataFrame:
    """Scores by a join on the term, salted so that a frequent term spreads out."""
    postings = index.select("id", "dl", F.explode("terms").alias("p")).select(
        "id",
        "dl",
        F.col("p.value").alias("term"),
        F.col("p.n").cast("double").alias("tf"),
        F.pmod(F.xxhash64("id"), F.lit(TERM_SALTS)).cast("int").alias("salt"),
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(TERM_SALTS - 1)))
    matched = postings.join(weights.withColumn("salt", copies), ["term", "salt"])
    length = k1 * (1 - b + b * F.col("dl") / F.lit(mean))
    part = F.col("idf") * (F.col("tf") * (k1 + 1)) / (F.col("tf") + length)
    # The same whole multiples as in place, so that both forms agree at halves too.
    whole = F.floor(part * PART_SCALE + 0.5)
    score = F.floor((F.col("_sum").cast("double") + SCORE_UNIT / 2) / SCORE_UNIT) / 10**SCORE_DECIMALS
    return (
        matched.select("qid", "id", whole.alias("part"))
        .groupBy("qid", "id")
        .agg(F.sum("part").alias("_sum"))
        .where("_sum > 0")  # no hit where every part rounds to nothing
        .select("qid", "id", score.alias("score"))
    )


def _scored_in_place(
    weights: DataFrame, index: DataFrame, k: int, mean: float, k1: float, b: float
) -> DataFrame:
    shipped = weights.toArrow()
    vocabulary = pc.unique(shipped.column("term"))
    term_of = numpy_values(pc.index_in(shipped.column("term"), value_set=vocabulary))
    qids, question_of = np.unique(numpy_values(shipped.column("qid")), return_inverse=True)
    idf_of = numpy_values(shipped.column("idf"))
    qid_type = shipped.schema.field("qid").type
    # Per block of questions: its terms, and the questions and weights of each of them.
    blocks = []
    for low in range(0, len(qids), QUESTION_BLOCK):
        mine = np.flatnonzero((question_of >= low) & (question_of < low + QUESTION_BLOCK))
        mine = mine[np.argsort(term_of[mine], kind="stable")]
        used, starts, sizes = np.unique(term_of[mine], return_index=True, return_counts=True)
        blocks.append((min(QUESTION_BLOCK, len(qids) - low), used, starts, sizes, question_of[mine] - low, idf_of[mine]))

    def score(bests: list[BlockBest], ids: np.ndarray, rows: np.ndarray, terms: np.ndarray,
              top: np.ndarray, bottom: np.ndarray) -> None:
        """Offer passages: ``rows`` ascending, one entry per passage and known term."""
        heads = np.r_[True, rows[1:] != rows[:-1]]
        present, passage = ids[rows[heads]], np.cumsum(heads) - 1
        for best, (n_questions, used, starts, sizes, question, idf) in zip(bests, blocks, strict=True):
            place = np.minimum(np.searchsorted(used, terms), len(used) - 1)
            asked = np.flatnonzero(used[place] == terms)
            if not len(asked):
                continue
            # one pair per entry and question that asks its term
            n = sizes[place[asked]]
            entry, ends = np.repeat(asked, n), np.cumsum(n)
            pair = np.arange(ends[-1]) + np.repeat(starts[place[asked]] - (ends - n), n)
            parts = idf[pair]
            parts *= top[entry]
            parts /= bottom[entry]
            # Whole multiples of 1e-10, halves up as in decimals: their sum does not
            # depend on its order.
            parts *= PART_SCALE
            parts += 0.5
            np.floor(parts, out=parts)
            cells = question[pair] * len(present) + passage[entry]
            sums = np.bincount(cells, weights=parts, minlength=n_questions * len(present)).reshape(n_questions, -1)
            scores = np.floor((sums + SCORE_UNIT / 2) / SCORE_UNIT) / 10**SCORE_DECIMALS
            q, at = best.candidates(scores)
            hit = sums[q, at] > 0
            q, at = q[hit], at[hit]
            best.add(q, present[at], scores[q, at])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bests, id_type = [BlockBest(block[0], k) for block in blocks], None
        for batch in (b.slice(at, STEP_PASSAGES) for b in batches for at in range(0, max(b.num_rows, 1), STEP_PASSAGES)):
            id_type = batch.schema.field("id").type
            lists = batch.column("terms")
            entries = lists.flatten()
            found = pc.index_in(entries.field("value"), value_set=vocabulary)
            known = numpy_values(found.is_valid())
            if not known.any():
                continue
            sizes = numpy_values(pc.fill_null(pc.list_value_length(lists), 0))
            rows = np.repeat(np.arange(batch.num_rows), sizes)[known]
            terms = numpy_values(found.drop_null())
            tf = numpy_values(entries.field("n")).astype(np.float64)[known]
            dl = numpy_values(batch.column("dl")).astype(np.float64)
            top, bottom = tf * (k1 + 1), tf + k1 * (1 - b + b * dl[rows] / mean)
            ids = numpy_values(batch.column("id"))
            # Steps of bounded size that end between two passages.
            start = 0
            while start < len(rows):
                stop = min(start + STEP_ENTRIES, len(rows))
                if stop < len(rows):
                    stop = int(np.searchsorted(rows, rows[stop - 1], side="right"))
                cut = slice(start, stop)
                score(bests, ids, rows[cut], terms[cut], top[cut], bottom[cut])
                start = stop
        if id_type is not None:
            yield best_batch(bests, qids, qid_type, id_type)

    return index.select("id", "dl", "terms").mapInArrow(scan, hit_schema(weights, index))
