"""Stored postings against the scan of the whole forward index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.operators import postings as P
from passagemill.operators.keyword import bm25_topk, forward_index


def passages(spark, n=900, seed=3, id_step=7):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(60)])
    weight = 1 / np.arange(1, 61)
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 30))
        rows.append((i * id_step, " ".join(rng.choice(words, size, p=weight / weight.sum()))))
    rows += [(10**12 + i, "w0 " * 40 + f"rare{i}") for i in range(30)]
    return spark.createDataFrame(rows, "id bigint, content string")


ASKED = [
    (1, "w0"), (2, "w0 w1 w2"), (3, "w59 w0"), (4, "rare3 w0 w0"), (5, "nowhere"), (6, ""), (7, None), (8, "w30 w31 w32 w33 w5"),
]


def rows(df):
    return sorted(map(tuple, df.select("qid", "id", "score", "rank").collect()))


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SHARD_PASSAGES", 200), ("BLOCK", 8), ("RANGE", 8), ("FIRST_RANGES", 2), ("MERGED", 2), ("BEST_KEPT", 6)):
        monkeypatch.setattr(P, name, value)


@pytest.fixture
def built(spark, small):
    index = forward_index(passages(spark))
    return index, P.build_postings(index, "postings_small")


def test_same_rows_as_the_scan(spark, built, monkeypatch):
    index, stored = built
    asked = spark.createDataFrame(ASKED, "qid int, question string")
    for k in (1, 5, 40):  # below and above the number of maxima kept
        assert rows(P.postings_topk(asked, stored, k)) == rows(bm25_topk(asked, index, k))
    monkeypatch.setattr(P, "SHIP_WEIGHTS", 2)
    monkeypatch.setattr(P, "PUSHED_TERMS", 1)
    assert rows(P.postings_topk(asked, stored, 5)) == rows(bm25_topk(asked, index, 5))


def test_blocks_hold_every_posting_once(spark, built):
    index, stored = built
    want = index.select("id", "dl", F.explode("terms").alias("t")).select("id", "t.value", "t.n", "dl")
    got = stored.blocks(spark).select("term", F.explode("postings").alias("p")).select("p.id", F.col("term").alias("value"), F.col("p.tf").cast("bigint").alias("n"), "p.dl")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    bad = stored.blocks(spark).where("size(postings) > 8 or first > last or postings[0].id <> first")
    assert bad.isEmpty()
    maxima = {r.term: r for r in stored.terms(spark).collect()}
    tops = {}
    for r in stored.blocks(spark).select("term", "top").collect():
        tops.setdefault(r.term, []).append(r.top)
    assert all(maxima[t].best == sorted(v, reverse=True)[:6] for t, v in tops.items())
    counts = {r.value: r["count"] for r in want.groupBy("value").count().collect()}
    assert {t: r.df for t, r in maxima.items()} == counts


def test_only_asked_terms_are_read(spark, built):
    _, stored = built
    asked = spark.createDataFrame([(1, "w7 w9")], "qid int, question string")
    weights = P._weights(asked, stored, 3)
    read = P.read_blocks(spark, stored, weights)
    assert {r.term for r in read.select("term").distinct().collect()} <= {"w7", "w9"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan or "PartitionFilters: [isnotnull(bucket#" in plan
    assert "In(term, [w7,w9])" in plan


def test_blocks_below_the_known_score_stay_out(spark, small):
    """Ten passages made of one word answer alone; most blocks of the others cannot matter."""
    data = [(i, "common " + " ".join(f"x{j}" for j in range(20 + i % 50))) for i in range(1000)]
    data += [(5000 + i, "common common common") for i in range(10)]
    index = forward_index(spark.createDataFrame(data, "id bigint, content string"))
    stored = P.build_postings(index, "postings_skip")
    asked = spark.createDataFrame([(1, "common")], "qid int, question string")
    every = stored.blocks(spark).where("term = 'common'").count()
    read = P.read_blocks(spark, stored, P._weights(asked, stored, 2)).count()
    assert read < every / 5
    assert rows(P.postings_topk(asked, stored, 2)) == rows(bm25_topk(asked, index, 2))


def test_ranges_below_the_kth_score_are_skipped(spark, small):
    import pyarrow.compute as pc

    data = [(i, ("a " * (1 + 30 * (i % 97 == 0)) + "b " * (1 + 30 * (i % 89 == 0)) + "c " * 30)) for i in range(3000)]
    index = forward_index(spark.createDataFrame(data, "id bigint, content string"))
    stored = P.build_postings(index, "postings_intervals")
    flat = stored.blocks(spark).where("shard = 0 and term in ('a', 'b')").select(
        "term", "first", "last", "top", F.col("postings.id").alias("ids"), F.col("postings.tf").alias("tf"), F.col("postings.dl").alias("dl")
    ).toArrow()
    shard = P._Shard(flat, pc.unique(flat.column("term")), stored)
    best = P.Best(np.array([1]), 2)
    shard.search(best, 0, np.array([0, 1]), np.array([1.0, 1.0]), 0.0)
    assert len(best.ids[0]) == 2
    assert shard.scored < sum(map(len, flat.column("ids").to_pylist())) / 2


def test_edges(spark, small):
    empty = P.build_postings(forward_index(passages(spark).limit(0)), "postings_empty")
    asked = spark.createDataFrame(ASKED, "qid int, question string")
    assert rows(P.postings_topk(asked, empty, 3)) == []
    same = forward_index(spark.createDataFrame([(i, "a b") for i in range(50)] + [(60, None), (61, "")], "id bigint, content string"))
    stored = P.build_postings(same, "postings_ties")
    got = P.postings_topk(spark.createDataFrame([(1, "a b"), (2, "b")], "qid int, question string"), stored, 4)
    assert [(q, i) for q, i, _, _ in rows(got)] == [(q, i) for q in (1, 2) for i in range(4)]
    with pytest.raises(ValueError):
        P.postings_topk(asked, stored, 0)


def test_joined_and_shipped_scores_agree_at_halves(spark, monkeypatch):
    """Scores of both forms of the scan, and of the postings, are equal to the last bit."""
    from passagemill.operators import keyword

    index = forward_index(passages(spark, 400, seed=8))
    asked = spark.createDataFrame(ASKED + [(9, "w1 w2 w3 w4 w5 w6 w7 w8 w9")], "qid int, question string")
    shipped = rows(bm25_topk(asked, index, 200))
    assert shipped == rows(P.postings_topk(asked, P.build_postings(index, "postings_halves"), 200))
    monkeypatch.setattr(keyword, "SHIP_WEIGHTS", 0)
    assert rows(bm25_topk(asked, index, 200)) == shipped

    # one term whose part is a half of the last place: idf * tf * (k1 + 1) / (tf + length)
    half = spark.createDataFrame([(1, 1, [("t", 1)])], "id bigint, dl bigint, terms array<struct<value: string, n: int>>")
    weights = spark.createDataFrame([(1, "t", (7 + 0.5) / 1e10)], "qid int, term string, idf double")
    mean, k1, b = 1.0, 1.2, 0.75
    one = keyword._joined_scores(weights, half, mean, k1, b).collect()
    two = keyword._scored_in_place(weights, half, 1, mean, k1, b).collect()
    assert [(r.qid, r.id, r.score) for r in one] == [(r.qid, r.id, r.score) for r in two]


def test_postings_are_built_with_one_shuffle_of_passages(spark, monkeypatch):
    written = []
    swap = P.swap_table
    monkeypatch.setattr(P, "swap_table", lambda df, name, **more: (written.append(df), swap(df, name, **more))[1])
    rows = spark.createDataFrame([(i, f"word{i % 7} all") for i in range(90)], "id bigint, content string")
    P.build_postings(forward_index(rows), "postings_one_shuffle")
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate explode") < plan.index("Exchange")
