import numpy as np
from pyspark.sql import functions as F

from passagemill.functions.text import tokens
from passagemill.functions.vectors import _let, count_runs, dense_from_counts, hash_embedding, hashed_word_counts, word_counts
from passagemill.operators import keyword
from passagemill.operators.index import Index, index_entries

TEXTS = [None, "", "... !", "b a b é É 漢字 a", "one", "Zebra apple ZEBRA 12 ½", "x " * 300]


def _rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id bigint, content string").coalesce(1)


def test_batches_count_and_embed_as_expressions_do(spark, monkeypatch):
    monkeypatch.setattr("passagemill.functions.vectors.STEP_ROWS", 2)
    rows = _rows(spark).withColumn("w", F.when(F.col("id") != 0, tokens("content")))
    slow = _let(hashed_word_counts("content", 16), lambda c: dense_from_counts(c, 16))
    got = rows.select(
        word_counts("w").alias("a"), count_runs(F.col("w")).alias("b"), hash_embedding("content", 16).alias("c"), slow.alias("d")
    ).collect()
    assert len(got) == len(TEXTS)
    assert all(r.a == r.b and r.c == r.d for r in got)


def test_an_entry_finds_its_tokens_once(spark):
    entries = index_entries(_rows(spark), Index("unused", 16))
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert [(r.dl, r.ok) for r in entries.orderBy("id").collect()][:4] == [(0, False), (0, False), (0, False), (7, True)]


def test_scoring_makes_no_cell_per_term_and_question(spark, monkeypatch):
    """A step holds pairs of entries and asking questions, not all terms times all questions."""
    asked = spark.createDataFrame([(q, f"w{q} common") for q in range(300)], "qid bigint, question string")
    passages = spark.createDataFrame([(p, f"w{p} w{p + 1} common") for p in range(40)], "id bigint, content string")
    index = keyword.forward_index(passages.coalesce(1))
    made = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def zeros(self, shape, *a, **k):
            made.append(shape)
            raise AssertionError("a table of all terms and questions")

    want = {(r.qid, r.id): r.score for r in keyword.bm25_scores(asked, index).collect()}
    monkeypatch.setattr(keyword, "np", Counting())
    monkeypatch.setattr(keyword, "STEP_ENTRIES", 7)
    got = keyword.bm25_topk(asked, index, 3).collect()
    assert len(got) == 900 and all(want[r.qid, r.id] == r.score for r in got)
    for q in (0, 5, 39, 299):
        best = sorted(((-s, i) for (a, i), s in want.items() if a == q))[:3]
        assert [(r.id, -r.score) for r in sorted((r for r in got if r.qid == q), key=lambda r: r.rank)] == [(i, s) for s, i in best]
