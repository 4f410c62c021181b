"""Dense, keyword and approximate ranking against brute force."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from passagemill.operators import dense, keyword
from passagemill.operators.ann import ann_topk, recall
from passagemill.operators.dense import dense_topk
from passagemill.operators.fusion import apply_k_override, largest_k, reciprocal_rank_fusion
from passagemill.operators.keyword import bm25_topk, forward_index


def ranked(rows):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in rows)


def vectors(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    made = rng.integers(-3, 4, (n, dim)).astype(float)
    if copies:
        made[:copies] = made[0]  # many equal scores
    return made


def brute_dense(questions, corpus, k):
    out = []
    for q, v in enumerate(questions):
        scores = [(-round(float(v @ w), 6), i) for i, w in enumerate(corpus)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def frames(spark, questions, corpus):
    q = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(questions)], "qid long, embedding array<float>"
    )
    c = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(corpus)], "id long, embedding array<float>"
    )
    return q, c.repartition(5)


@pytest.mark.parametrize("shipped", [True, False])
def test_dense_is_exact_with_ties(spark, monkeypatch, shipped):
    if not shipped:
        monkeypatch.setattr(dense, "SHIP_ROWS", 3)
        monkeypatch.setattr(dense, "CELL_QUESTIONS", 4)
        monkeypatch.setattr(dense, "CELL_VECTORS", 60)
    questions, corpus = vectors(9, 5, 1), vectors(300, 5, 2, copies=100)
    q, c = frames(spark, questions, corpus)
    got = dense_topk(q, c, 7, dim=5).collect()
    assert ranked(got) == brute_dense(questions, corpus, 7)


def test_dense_edges(spark):
    q, c = frames(spark, vectors(2, 4, 1), vectors(3, 4, 2))
    assert dense_topk(q, c, 10, dim=4).count() == 6  # k above the row count
    assert dense_topk(q.where("false"), c, 3, dim=4).isEmpty()
    assert dense_topk(q, c.where("false"), 3, dim=4).isEmpty()
    flagged = c.withColumn("ok", F.col("id") == 1)
    assert {r.id for r in dense_topk(q, flagged, 3, dim=4).collect()} == {1}
    with pytest.raises(Exception, match="dimension 5"):
        dense_topk(q, c, 3, dim=5).collect()
    with pytest.raises(ValueError):
        dense_topk(q, c, 0, dim=4)


def test_only_k_rows_per_task_are_shuffled(spark):
    q, c = frames(spark, vectors(9, 5, 1), vectors(300, 5, 2))
    plan = dense_topk(q, c, 7, dim=5)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.index("Exchange hashpartitioning(qid") < plan.index("MapInArrow")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


TEXTS = [
    "the cat sat on the mat",
    "the dog and the cat",
    "",
    "a dog",
    "the the the the",
    "mat mat mat cat",
    "the cat sat on the mat",
]
ASKED = ["the cat", "MAT sat", "nothing known", "dog dog a"]


def words(text):
    return re.findall(r"\w+", text.lower())


def brute_bm25(k):
    docs = [Counter(words(t)) for t in TEXTS]
    size = [sum(d.values()) for d in docs]
    mean = sum(size) / len(docs)
    out = []
    for q, text in enumerate(ASKED):
        scores = []
        for i, d in enumerate(docs):
            s = 0.0
            for t in set(words(text)):
                df = sum(t in e for e in docs)
                if d[t]:
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    s += idf * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * size[i] / mean))
            if s:
                scores.append((-round(s, 6), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shipped", [True, False])
def test_bm25(spark, monkeypatch, shipped):
    if not shipped:
        monkeypatch.setattr(keyword, "SHIP_WEIGHTS", 1)
    monkeypatch.setattr(keyword, "STEP_ENTRIES", 3)
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, content string").repartition(3)
    asked = spark.createDataFrame(list(enumerate(ASKED)), "qid long, question string")
    got = bm25_topk(asked, forward_index(rows), 3).collect()
    want = brute_bm25(3)
    assert [r[:3] for r in ranked(got)] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in ranked(got)], [r[3] for r in want], atol=2e-6)


def test_fusion_sums_reciprocal_ranks(spark):
    schema = "qid long, id long, rank int"
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], schema)
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], schema)
    got = reciprocal_rank_fusion(a, b, 2).orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [
        (11, round(1 / 61 + 1 / 62, 6)),
        (10, round(1 / 61, 6)),
    ]


def test_k_override(spark):
    hits = spark.createDataFrame(
        [(q, i, i) for q in (1, 2, 3) for i in range(1, 6)], "qid long, id long, rank int"
    )
    asked = spark.createDataFrame([(1, 0), (2, None), (3, 4)], "qid long, k_override int")
    assert largest_k(asked, 2) == 4
    counts = apply_k_override(hits, asked, 2).groupBy("qid").count().collect()
    assert {r.qid: r["count"] for r in counts} == {2: 2, 3: 4}


def test_approximate_search_finds_most_neighbours(spark, data):
    given = spark.read.parquet(f"{data}/embeddings.parquet")
    q = given.select(F.col("vec_id").alias("qid"), "embedding")
    c = given.select(F.col("vec_id").alias("id"), "embedding")
    exact = dense_topk(q, c, 5, dim=64)
    share = recall(ann_topk(q, c, 5, dim=64, cells=12, n_probes=4), exact).first().recall
    assert share > 0.6
    full = recall(ann_topk(q, c, 5, dim=64, cells=4, n_probes=4), exact).first().recall
    assert full == 1.0


def test_scoring_holds_steps_of_bounded_size():
    rng = np.random.default_rng(5)
    questions, corpus = rng.normal(size=(300, 8)), rng.normal(size=(50_000, 8)).astype(np.float32)
    corpus[7], corpus[49_000] = corpus[100], corpus[100]  # equal rows: smaller ids first
    column = pa.FixedSizeListArray.from_arrays(pa.array(corpus.ravel()), 8).cast(pa.list_(pa.float32()))
    scorer = dense.Scorer(np.arange(300), questions, 3)
    tracemalloc.start()
    scorer.offer(np.arange(50_000), column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # one matrix of 256 questions and all rows has 102 MB
    got = scorer.batch(pa.int64(), pa.int64()).to_pylist()
    scores = np.round(questions @ corpus.T.astype(float), 6)
    want = [(q, i, scores[q, i]) for q in range(300) for i in np.lexsort((np.arange(50_000), -scores[q]))[:3]]
    assert [(r["qid"], r["id"]) for r in got] == [w[:2] for w in want]
    assert np.allclose([r["score"] for r in got], [w[2] for w in want], atol=1e-9)


def test_rounding_may_lift_a_row_into_the_best():
    scorer = dense.Scorer(np.array([4]), np.array([[1.0]]), 2)
    values = [0.5000004, 0.5000002, 0.4999998, 0.1, float("nan"), 0.4999996]
    column = pa.array([[v] for v in values], pa.list_(pa.float64()))
    for at in (4, 0, 2):  # one batch after the other
        scorer.offer(np.array([9, 8, 7, 6, 5, 3])[at:at + 2], column[at:at + 2])
    assert [tuple(r.values()) for r in scorer.batch(pa.int64(), pa.int64()).to_pylist()] == [(4, 3, 0.5), (4, 7, 0.5)]
