"""Approximate top-k over a stored inverted file with product-quantised residuals.

``build_cells`` groups the vectors around centres and writes two tables that are
partitioned by cell: short codes of what is left of a vector after its centre,
and the vectors themselves. A search reads only the partitions of the cells it
probes. Codes are scored by adding up entries of look-up tables, made once per
question; the best of them are scored again on the original vectors, so scores and
their order are exact among the rows that were looked at.

A cell with many rows lies in several files, each read by its own task. Only the
centres and code books, whose size depends on the number of cells and
dimensions, are held by the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from ..sources.tables import swap_table
from .dense import _checked, _matrix, block_questions, dense_topk
from .topk import SCORE_DECIMALS, Best, BlockBest, hit_schema, numpy_values, rank_top, round_scores

#: Rows the cell centres and the code books are fitted on; assignment covers every row.
FIT_ROWS = 200_000
CODE_ROWS = 50_000
#: Values of one byte of a code, and rounds of fitting them.
CODE_VALUES = 256
CODE_ROUNDS = 12
#: Rows of one file of a cell.
FILE_ROWS = 500_000
#: Vectors compared with all centres, and questions scored together, in one step.
STEP_ROWS = 1024
STEP_QUESTIONS = 256
#: Largest look-up tables (bytes) a task makes for shipped questions, and rows that leave
#: a task for each of them; more are scored again where they lie.
SHIP_BYTES = 64 * 1024 * 1024
SHIP_KEPT = 1_000
#: Questions of a block of the block form (at least), rows (about) and bytes as doubles of a slab,
#: and candidates of all questions that a task holds together.
CELL_QUESTIONS = 4_000
SLAB_ROWS = 131_072
SLAB_BYTES = 64 * 1024 * 1024
HELD_ROWS = 1 << 18
#: Largest number of cells; their ids are held by the driver.
MOST_CELLS = 65_536
#: Rows that ask for their neighbours when the number of probes is chosen.
TUNE_ROWS = 500


@dataclass(frozen=True)
class CellIndex:
    """Handle of a stored index: centres, code books (sub-vector, value, entries), probes."""

    name: str
    dim: int
    centres: np.ndarray
    books: np.ndarray
    n_probes: int

    def codes(self, spark: SparkSession) -> DataFrame:
        """``id, code, cell, part``."""
        return spark.read.table(f"{self.name}_codes")

    def vectors(self, spark: SparkSession) -> DataFrame:
        """``id, code, embedding, cell, part``."""
        return spark.read.table(f"{self.name}_vectors")

    def probes(self, questions: np.ndarray, n_probes: int) -> tuple[np.ndarray, np.ndarray]:
        """For each question the cells of the largest inner products, and these products."""
        products = questions @ self.centres.T
        cells = np.argsort(-products, axis=1, kind="stable")[:, :n_probes]
        return cells, np.take_along_axis(products, cells, axis=1)

    def probing(self, questions: np.ndarray, n_probes: int) -> np.ndarray:
        """Which cells each question probes, as a matrix of booleans."""
        if n_probes >= len(self.centres):
            return np.ones((len(questions), len(self.centres)), bool)
        products = questions @ self.centres.T
        least = np.partition(products, -n_probes, axis=1)[:, -n_probes]
        asked = products >= least[:, None]
        for q in np.flatnonzero(asked.sum(axis=1) != n_probes):  # equal products: the first cells
            asked[q] = False
            asked[q, np.argsort(-products[q], kind="stable")[:n_probes]] = True
        return asked

    def decoded(self, codes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        left = [book[codes[:, j]] for j, book in enumerate(self.books)]
        return self.centres[cells] + np.concatenate(left, axis=1)

    def tables(self, questions: np.ndarray) -> np.ndarray:
        """Inner products of each question's sub-vectors with all values of the code books."""
        parts = questions.reshape(len(questions), len(self.books), -1)
        return np.einsum("qmd,mvd->qmv", parts, self.books).astype(np.float32)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (rows @ centres.T), axis=1)


def fit_centres(vectors: DataFrame, cells: int, *, vector: str = "embedding", seed: int = 42) -> np.ndarray:
    """Cell centres from a sample of the vectors (the whole table when it is small)."""
    features = vectors.select(array_to_vector(vector).alias("features"))
    total = features.count()
    if total > FIT_ROWS:
        features = features.sample(FIT_ROWS / total, seed)
    model = KMeans(k=cells, seed=seed, maxIter=10, initSteps=2).fit(features)
    return np.asarray(model.clusterCenters())


def _values(rows: np.ndarray, seed: int) -> np.ndarray:
    """At most ``CODE_VALUES`` centres of some rows, by a bounded number of rounds."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= CODE_VALUES:
        return distinct
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), CODE_VALUES, replace=False)]
    for _ in range(CODE_ROUNDS):
        near = np.concatenate([_nearest(rows[a:a + STEP_ROWS], centres) for a in range(0, len(rows), STEP_ROWS)])
        counts = np.bincount(near, minlength=CODE_VALUES)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit_books(vectors: DataFrame, centres: np.ndarray, subs: int, *, seed: int = 42) -> np.ndarray:
    """Code books of the residuals of a bounded sample, one task per sub-vector."""
    dim = centres.shape[1]
    total = vectors.count()
    if total > CODE_ROWS:
        vectors = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(CODE_ROWS / total * 1_000_000))

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(0))
            for a in range(0, len(rows), STEP_ROWS):
                part = rows[a:a + STEP_ROWS]
                left = (part - centres[_nearest(part, centres)]).reshape(len(part) * subs, -1)
                offsets = np.arange(len(left) + 1, dtype=np.int32) * left.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(subs, dtype=np.int32), len(part))),
                        pa.ListArray.from_arrays(offsets, pa.array(left.ravel())),
                    ],
                    ["sub", "r"],
                )

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        sub = int(group["sub"].iloc[0])
        rows = np.stack(group["r"])
        rows = rows[np.lexsort(rows.T)]  # the same sample gives the same values in any order
        return pd.DataFrame({"sub": sub, "v": list(_values(rows, seed + sub))})

    found = (
        vectors.select("v").mapInArrow(residuals, "sub int, r array<double>")
        .groupBy("sub").applyInPandas(fitted, "sub int, v array<double>").collect()
    )
    books = np.zeros((subs, CODE_VALUES, dim // subs))
    for sub in range(subs):
        mine = [r.v for r in found if r["sub"] == sub]
        if mine:  # unused values repeat the first one
            books[sub] = mine[0]
            books[sub, : len(mine)] = mine
    return books


def _encoded(vectors: DataFrame, centres: np.ndarray, books: np.ndarray) -> DataFrame:
    """``id, v, cell, code`` of every vector."""
    subs = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(at, STEP_ROWS)
                rows = _matrix(batch.column("v"))
                cells = _nearest(rows, centres)
                left = (rows - centres[cells]).reshape(len(rows), subs, -1)
                codes = np.stack([_nearest(left[:, j], books[j]) for j in range(subs)], axis=1).astype(np.uint8)
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), pa.array(cells.astype(np.int32)), packed],
                    ["id", "v", "cell", "code"],
                )

    kept = [f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "v")]
    return vectors.mapInArrow(run, ", ".join([*kept, "cell int", "code binary"]))


def _subs(dim: int, wanted: int) -> int:
    """The largest number of equal sub-vectors that is not above ``wanted``."""
    return max(s for s in range(1, min(dim, wanted) + 1) if dim % s == 0)


def build_cells(
    vectors: DataFrame,
    name: str,
    *,
    dim: int,
    cells: int | None = None,
    code_bytes: int = 16,
    n_probes: int | None = None,
    k: int = 12,
    recall_target: float = 0.92,
    vector: str = "embedding",
    id_column: str = "id",
) -> CellIndex:
    """Write the index tables of all vectors; ``cells`` defaults to twice the root of their number.

    Null vectors and rows whose ``ok`` column is false are left out; a vector of
    another dimension is an error. Without ``n_probes`` the smallest number is taken
    with which ``TUNE_ROWS`` of the rows, asking for their ``k`` nearest, find the
    ``recall_target`` of them in the probed cells.
    """
    spark = vectors.sparkSession
    if "ok" in vectors.columns:
        vectors = vectors.where("ok")
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(id_column).alias("id"), _checked(vector, dim).alias("v"))
    total = rows.count()
    cells = min(MOST_CELLS, max(1, total), cells or max(1, round(2 * math.sqrt(total))))
    centres = fit_centres(rows, cells, vector="v") if total else np.zeros((1, dim))
    books = fit_books(rows, centres, _subs(dim, code_bytes))
    encoded = materialize(_encoded(rows, centres, books), "cells")
    sizes = encoded.groupBy("cell").agg(F.count("*").alias("n"))  # at most one row per cell
    files = F.ceil(F.col("n") / FILE_ROWS).cast("int")
    parted = encoded.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), files).cast("int"))
    dealt = parted.repartition("cell", "part")
    swap_table(dealt.select("id", "code", "part", "cell"), f"{name}_codes", partition_by=["cell"])
    vectors = dealt.select("id", "code", F.col("v").alias("embedding"), "part", "cell")
    swap_table(vectors, f"{name}_vectors", partition_by=["cell"])
    index = CellIndex(name, dim, centres, books, n_probes or len(centres))
    if n_probes is None and total:
        index = CellIndex(name, dim, centres, books, choose_probes(spark, index, k, recall_target))
    _save(spark, index)
    return index


def _save(spark: SparkSession, index: CellIndex) -> None:
    rows = [("centre", i, 0, c.tolist()) for i, c in enumerate(index.centres)]
    rows += [("book", j, i, v.tolist()) for j, book in enumerate(index.books) for i, v in enumerate(book)]
    rows.append(("probes", index.n_probes, index.dim, []))
    swap_table(spark.createDataFrame(rows, "kind string, a int, b int, v array<double>").coalesce(1), f"{index.name}_model")


def open_cells(spark: SparkSession, name: str) -> CellIndex:
    """The handle of an index that was built before."""
    rows = spark.read.table(f"{name}_model").orderBy("kind", "a", "b").collect()
    centres = np.array([r.v for r in rows if r.kind == "centre"])
    subs = 1 + max(r.a for r in rows if r.kind == "book")
    books = np.array([r.v for r in rows if r.kind == "book"]).reshape(subs, CODE_VALUES, -1)
    (probes,) = [r for r in rows if r.kind == "probes"]
    return CellIndex(name, probes.b, centres, books, probes.a)


def choose_probes(spark: SparkSession, index: CellIndex, k: int, target: float) -> int:
    """The fewest probes that reach ``target`` for a bounded sample of the index's own rows.

    Their true neighbours are found by one exact scan; each neighbour then needs as
    many probes as the place of its cell in the asking row's order of cells.
    """
    vectors = index.vectors(spark)
    total = vectors.count()
    share = int(min(1.0, TUNE_ROWS / total) * 1_000_000)
    asked = vectors.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) < share)
    asked = asked.select(F.col("id").alias("qid"), "embedding").limit(2 * TUNE_ROWS)
    near = dense_topk(asked, vectors, k, dim=index.dim)
    ids = broadcast_if_small(near.select("id").distinct())
    cells = {r.id: r.cell for r in vectors.join(ids, "id", "left_semi").select("id", "cell").collect()}
    questions = asked.toArrow()
    if not questions.num_rows:
        return len(index.centres)
    order, _ = index.probes(_matrix(questions.column("embedding")), len(index.centres))
    places = {q: np.argsort(o) for q, o in zip(numpy_values(questions.column("qid")).tolist(), order, strict=True)}
    needed = np.sort([places[r.qid][cells[r.id]] + 1 for r in near.select("qid", "id").collect()])
    return int(needed[max(0, math.ceil(target * len(needed)) - 1)])


def _approximate(
    index: CellIndex, k: int, qids: np.ndarray, matrix: np.ndarray, cells: np.ndarray, base: np.ndarray
):
    """A scorer that offers batches of codes to the questions that probe their cells."""
    held = Best(qids, k)
    asking = [np.zeros(0, np.int64)] * len(index.centres)
    order = np.argsort(cells, axis=None, kind="stable")
    found, starts = np.unique(cells.ravel()[order], return_index=True)
    for cell, members in zip(found, np.split(order, starts[1:]), strict=True):
        asking[cell] = members  # flat places in ``cells``
    flat_base, width = base.ravel(), cells.shape[1]
    made = index.tables(matrix)

    def offer(cell_column: np.ndarray, ids: np.ndarray, codes: np.ndarray) -> None:
        for cell in np.unique(cell_column):
            mine = cell_column == cell
            chosen, here = codes[mine], ids[mine]
            for low in range(0, len(asking[cell]), STEP_QUESTIONS):
                flat = asking[cell][low:low + STEP_QUESTIONS]
                rows = flat // width
                scores = np.repeat(flat_base[flat, None], len(chosen), axis=1)
                for j in range(len(index.books)):
                    scores += made[rows, j][:, chosen[:, j]]
                for q, row in zip(rows, scores, strict=True):
                    held.offer(q, here, row)

    return held, offer


def _code_matrix(column: pa.Array, subs: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), subs)


def search_cells(
    questions: DataFrame,
    index: CellIndex,
    k: int,
    *,
    n_probes: int | None = None,
    rerank: int = 8,
    vector: str = "embedding",
) -> DataFrame:
    """``qid, id, score, rank``: the k best rows found in each question's nearest cells.

    The ``rerank * k`` rows with the best codes are scored on their vectors; scores
    are inner products rounded to six decimals and ties go to the smaller id.
    Questions with a null vector have no hits; a vector of another dimension is an
    error. A batch of questions whose look-up tables are too large for a task, or that
    keeps many rows each, meets the cells in blocks instead, with the same rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = questions.sparkSession
    n = min(n_probes or index.n_probes, len(index.centres))
    q = questions.where(F.col(vector).isNotNull()).select("qid", _checked(vector, index.dim).alias("v"))
    limit = max(1, SHIP_BYTES // (4 * len(index.books) * CODE_VALUES))
    if rerank * k > SHIP_KEPT or q.limit(limit + 1).count() > limit:
        return _met(q, index, n, rerank * k, k)
    near, probed = _shipped(q, index.codes(spark), index, n, rerank * k)
    best = rank_top(near, rerank * k).select("qid", "id")
    vectors = index.vectors(spark).where(F.col("cell").isin(probed)).select("id", F.col("embedding").alias("w"))
    wanted = materialize(best.join(q, "qid"), "candidates")
    pairs = vectors.join(broadcast_if_small(wanted), "id")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                products = np.einsum("ij,ij->i", _matrix(batch.column("v")), _matrix(batch.column("w")))
                scores = pa.array(round_scores(products))
                yield pa.RecordBatch.from_arrays([batch.column("qid"), batch.column("id"), scores], ["qid", "id", "score"])

    scored = pairs.select("qid", "id", "v", "w").mapInArrow(exact, hit_schema(q, vectors))
    return rank_top(scored, k)


def _shipped(q: DataFrame, codes: DataFrame, index: CellIndex, n: int, k: int) -> tuple[DataFrame, list[int]]:
    """Questions travel with the tasks; only partitions of probed cells are read."""
    asked = q.toArrow()
    qids, qid_type = numpy_values(asked.column("qid")), asked.schema.field("qid").type
    matrix = _matrix(asked.column("v")) if len(qids) else np.zeros((0, index.dim))
    cells, base = index.probes(matrix, n)
    probed = [int(c) for c in np.unique(cells)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, offer = _approximate(index, k, qids, matrix, cells, base)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            if batch.num_rows:
                found = _code_matrix(batch.column("code"), len(index.books))
                offer(numpy_values(batch.column("cell")), numpy_values(batch.column("id")), found)
        if id_type is not None:
            yield held.batch(qid_type, id_type)

    read = codes.where(F.col("cell").isin(probed)).select("id", "code", "cell")
    return read.mapInArrow(scan, hit_schema(q, codes)), probed


def _met(q: DataFrame, index: CellIndex, n: int, kept: int, k: int) -> DataFrame:
    """Blocks of questions meet slabs, groups of whole files of cells; both are bounded.

    Codes and vectors of a slab come together, so the rows with the best codes are
    scored again there and leave with both scores, at most ``kept`` per question and slab.
    Where ``kept`` covers all probed rows, the codes leave none out, and the ``k`` best
    by their vectors are enough.
    """
    dim = index.dim

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        found = np.zeros(len(index.centres), bool)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                found |= index.probing(_matrix(batch.column("v").slice(at, STEP_ROWS)), n).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found), pa.int32())], ["cell"])

    stored = index.vectors(q.sparkSession)
    if n < len(index.centres):
        probed = q.select("v").mapInArrow(asked, "cell int").distinct().collect()  # at most MOST_CELLS
        stored = stored.where(F.col("cell").isin([r.cell for r in probed]))
    total, count = stored.count(), q.count()
    every = kept >= total
    slabs = max(1, math.ceil(total / max(1, min(SLAB_ROWS, SLAB_BYTES // (8 * dim)))))
    blocks = max(1, math.ceil(count / block_questions(count, dim, CELL_QUESTIONS)))
    left = q.select(
        "qid", "v", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"),
    )
    right = stored.select(
        "id", "code", F.col("embedding").alias("w"), "cell",
        F.pmod(F.xxhash64("cell", "part"), F.lit(slabs)).cast("int").alias("slab"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("qb"),
    )
    qid_type, id_type = q.select("qid").limit(0).toArrow().schema[0].type, stored.select("id").limit(0).toArrow().schema[0].type

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
        if a.num_rows and b.num_rows:
            for found in _slab_hits(index, a, b, n, None if every else kept, k):
                for part, column in zip(parts, found, strict=True):
                    part.append(column)
        asker, row, near, score = (np.concatenate(p) for p in parts)
        return pa.table({
            "qid": a.column("qid").take(pa.array(asker)).cast(qid_type) if a.num_rows else pa.array([], qid_type),
            "id": b.column("id").take(pa.array(row)).cast(id_type) if b.num_rows else pa.array([], id_type),
            "near": near,
            "score": score,
        })

    schema = hit_schema(q, stored).replace("score", "near double, score")
    hits = left.groupBy("qb", "slab").cogroup(right.groupBy("qb", "slab")).applyInArrow(meet, schema)
    if not every:
        hits = rank_top(hits.select("qid", "id", F.col("near").alias("score"), F.col("score").alias("exact")), kept)
        hits = hits.select("qid", "id", F.col("exact").alias("score"))
    best = rank_top(hits.select("qid", "id", "score"), k).drop("rank")
    return rank_top(_repeated(best, q, stored), k)


def _repeated(hits: DataFrame, q: DataFrame, stored: DataFrame) -> DataFrame:
    """Hits as often as a join with questions by ``qid`` and vectors by ``id`` gives them.

    The shipped form joins so; a hit whose keys are unique stays once.
    """
    again = F.lit(1)
    for rows, key in ((q, "qid"), (stored, "id")):
        counts = rows.groupBy(key).agg(F.count("*").cast("int").alias(f"n_{key}")).where(f"n_{key} > 1")
        hits = hits.join(broadcast_if_small(counts), key, "left")
        again = again * F.coalesce(f"n_{key}", F.lit(1))
    return hits.select("qid", "id", "score", F.explode(F.sequence(F.lit(1), again))).drop("col")


def _slab_hits(index: CellIndex, a: pa.Table, b: pa.Table, n: int, kept: int | None, k: int):
    """``asker, row, near, score`` of a block of questions in one slab, in steps of questions.

    ``kept`` rows per question have the best codes; without it all rows of probed cells
    are scored on their vectors.
    """
    questions, vectors = _matrix(a.column("v")), _matrix(b.column("w"))
    ids, cell = numpy_values(b.column("id")), numpy_values(b.column("cell"))
    order = np.lexsort((ids, cell))
    vectors, cell = vectors[order], cell[order]
    # ties go to the smaller id: rows are known by the place of their id
    place = np.empty(len(ids), np.int64)
    by_id = np.argsort(ids[order], kind="stable")
    place[by_id] = np.arange(len(ids))
    cells, starts = np.unique(cell, return_index=True)
    ends = np.append(starts[1:], len(ids))
    if kept is None:
        seen, limit, slack = vectors, k, 10.0**-SCORE_DECIMALS
    else:
        codes = _code_matrix(b.column("code").combine_chunks(), len(index.books))[order]
        seen, limit, slack = index.decoded(codes, cell), min(kept, len(ids)), 0.0
    step = max(1, min(STEP_ROWS, HELD_ROWS // limit))
    for low in range(0, len(questions), step):
        mine = questions[low:low + step]
        probing = index.probing(mine, n)[:, cells]
        best = BlockBest(len(mine), limit, slack)
        for c, (start, end) in enumerate(zip(starts, ends, strict=True)):
            members = np.flatnonzero(probing[:, c])
            for at in range(start, end if len(members) else start, STEP_ROWS):
                rows = seen[at:min(at + STEP_ROWS, end)]
                scores = mine[members] @ rows.T
                q, row = best.candidates(scores, members)
                scores = scores[q, row]
                best.add(members[q], place[at + row], scores if kept else round_scores(scores))
        q, places, near = best.settled()
        rows = by_id[places]
        score = near
        if kept:
            score = np.empty(len(q))
            for at in range(0, len(q), HELD_ROWS // 4):
                here = slice(at, at + HELD_ROWS // 4)
                score[here] = round_scores(np.einsum("ij,ij->i", mine[q[here]], vectors[rows[here]]))
        yield q + low, order[rows], near, score


def ann_topk(questions: DataFrame, vectors: DataFrame, k: int, *, n_probes: int | None = None, **build) -> DataFrame:
    """Build an index of ``vectors`` under a name of its own and search it once."""
    index = build_cells(vectors, f"cells_{uuid4().hex}", n_probes=n_probes, k=k, **build)
    return search_cells(questions, index, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found, over all questions."""
    hits = exact.select("qid", "id").join(
        found.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left"
    )
    return hits.agg((F.count("hit") / F.count("*")).alias("recall"))
