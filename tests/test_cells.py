"""The stored inverted file against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.operators import ann
from passagemill.operators.dense import dense_topk


def frame(spark, ids, rows, **more):
    extra = "".join(f", {c} {t}" for c, (t, _) in more.items())
    data = [(int(i), None if r is None else [float(x) for x in r], *(v for _, v in more.values())) for i, r in zip(ids, rows)]
    return spark.createDataFrame(data, f"id bigint, embedding array<float>{extra}")


def asked(df):
    return df.select(F.col("id").alias("qid"), "embedding")


def rows(df):
    return sorted(map(tuple, df.select("qid", "id", "score", "rank").collect()))


@pytest.fixture(scope="module")
def clustered(spark):
    """40 tight groups of 30 vectors on the unit sphere, and an index of 20 cells."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    v = np.repeat(centres, 30, axis=0) + 0.1 * rng.normal(size=(1200, 32))
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    df = frame(spark, range(1200), v, label=("int", 1))
    return df, ann.build_cells(df, "cells_clustered", dim=32, cells=20, code_bytes=8, k=10)


def test_clusters_need_few_probes(spark, clustered):
    df, index = clustered
    exact = dense_topk(asked(df), df, 10, dim=32)
    assert index.n_probes <= 3  # chosen on a sample of the rows
    found = ann.search_cells(asked(df), index, 10)
    assert ann.recall(found, exact).first().recall >= 0.9
    worst = found.groupBy("qid").count().agg(F.min("count")).first()[0]
    assert worst == 10
    two = ann.recall(ann.search_cells(asked(df), index, 10, n_probes=2), exact).first().recall
    assert two <= ann.recall(ann.search_cells(asked(df), index, 10, n_probes=6), exact).first().recall


def test_only_probed_partitions_are_read(spark, clustered):
    df, index = clustered
    one = asked(df.where("id = 7"))
    q = one.withColumnRenamed("embedding", "v")
    counts = {r.cell: r["count"] for r in index.codes(spark).groupBy("cell").count().collect()}
    read = []
    for n in (1, 2, 5, 20):
        near, probed = ann._shipped(q, index.codes(spark), index, n, 80)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull(cell#" in plan or "PartitionFilters: [cell#" in plan
        assert len(probed) == n
        files = index.codes(spark).where(F.col("cell").isin(probed)).inputFiles()
        assert {f.split("cell=")[1].split("/")[0] for f in files} == {str(c) for c in probed}
        read.append(sum(counts[c] for c in probed))
    assert read == sorted(read) and read[-1] == 1200 and read[0] < 200


def test_all_cells_and_all_candidates_are_exact(spark, clustered, monkeypatch):
    df, index = clustered
    want = rows(dense_topk(asked(df.where("id < 90")), df, 10, dim=32))
    some = asked(df.where("id < 90"))
    assert rows(ann.search_cells(some, index, 10, n_probes=20, rerank=200)) == want
    monkeypatch.setattr(ann, "STEP_QUESTIONS", 7)
    shipped = rows(ann.search_cells(some, index, 10, n_probes=3))
    monkeypatch.setattr(ann, "SHIP_BYTES", 1)
    monkeypatch.setattr(ann, "CELL_QUESTIONS", 25)
    assert rows(ann.search_cells(some, index, 10, n_probes=20, rerank=200)) == want
    assert rows(ann.search_cells(some, index, 10, n_probes=3)) == shipped


def test_reopened_index_gives_the_same_rows(spark, clustered):
    df, index = clustered
    again = ann.open_cells(spark, "cells_clustered")
    assert (again.n_probes, again.dim) == (index.n_probes, index.dim)
    some = asked(df.where("id % 50 = 0"))
    assert rows(ann.search_cells(some, again, 5)) == rows(ann.search_cells(some, index, 5))


def test_a_large_cell_lies_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(ann, "FILE_ROWS", 50)
    v = [[1.0, 0.0, 0.0, 0.0]] * 400 + [[0.0, 1.0, 0.0, 0.1 * i] for i in range(10)]
    df = frame(spark, range(410), v)
    index = ann.build_cells(df, "cells_hot", dim=4, cells=2, k=3)
    parts = index.codes(spark).groupBy("cell").agg(F.count("*").alias("n"), F.count_distinct("part").alias("p")).collect()
    assert sum(r.n for r in parts) == 410
    assert all(r.p == -(-r.n // 50) for r in parts)
    got = rows(ann.search_cells(asked(df.where("id in (0, 399, 405)")), index, 3, n_probes=2, rerank=200))
    assert got == rows(dense_topk(asked(df.where("id in (0, 399, 405)")), df, 3, dim=4))
    assert [(q, i, r) for q, i, _, r in got if q == 399] == [(399, 0, 1), (399, 1, 2), (399, 2, 3)]  # ties: smaller ids


def test_edges(spark):
    df = frame(spark, [1, 2, 2, 3, 4], [[1.0, 0.0], None, [0.0, 1.0], [0.0, 1.0], [0.0, 0.0]])
    index = ann.build_cells(df, "cells_edges", dim=2, k=2)
    questions = spark.createDataFrame([(1, [0.0, 2.0]), (2, None)], "qid int, embedding array<double>")
    got = rows(ann.search_cells(questions, index, 9, n_probes=9))
    assert got == [(1, 1, 0.0, 3), (1, 2, 2.0, 1), (1, 3, 2.0, 2), (1, 4, 0.0, 4)]
    assert rows(ann.search_cells(questions.limit(0), index, 2)) == []
    bad = spark.createDataFrame([(1, [0.0, 2.0, 1.0])], "qid int, embedding array<double>")
    with pytest.raises(Exception, match="dimension 2 expected"):
        ann.search_cells(bad, index, 2).collect()
    with pytest.raises(ValueError):
        ann.search_cells(questions, index, 0)
    skipped = frame(spark, [1, 2], [[1.0, 0.0], [3.0, 0.0]], ok=("boolean", False))
    empty = ann.build_cells(skipped, "cells_empty", dim=2)
    assert rows(ann.search_cells(questions, empty, 2)) == []


def test_few_rows_leave_a_slab(spark, clustered, monkeypatch):
    df, index = clustered
    leaving = []

    def counted(scored, k):
        leaving.append(scored.count())
        return ann_rank_top(scored, k)

    ann_rank_top = ann.rank_top
    monkeypatch.setattr(ann, "rank_top", counted)
    want = rows(dense_topk(asked(df), df, 10, dim=32))
    assert rows(ann.search_cells(asked(df), index, 10, n_probes=20, rerank=1 << 20)) == want
    assert set(leaving) == {12_000}  # every pair left before: 1,440,000
    shipped = rows(ann.search_cells(asked(df), index, 10, n_probes=4))
    monkeypatch.setattr(ann, "SHIP_BYTES", 1)
    monkeypatch.setattr(ann, "SLAB_ROWS", 400)
    monkeypatch.setattr(ann, "CELL_QUESTIONS", 500)
    leaving.clear()
    assert rows(ann.search_cells(asked(df), index, 10, n_probes=4)) == shipped
    assert leaving[0] <= 1200 * 3 * 80  # at most three slabs
