"""Exact and approximate search against brute force."""

import numpy as np
import pytest

from passagemill.llm import exact_search, hnsw, queries

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, rank int, score string, id string, v string"


def frame(spark, rows):
    """With columns whose names clash with those made inside."""
    return spark.createDataFrame([(i, v, 1, "s", "i", "v") for i, v in rows], SCHEMA)


def brute(rows, chosen, k, score, largest):
    out = []
    for q, a in rows:
        if q % chosen == 0:
            got = sorted((-score(a, b) if largest else score(a, b), i) for i, b in rows if i != q)[:k]
            out += [(q, r + 1, i, -s if largest else s) for r, (s, i) in enumerate(got)]
    return sorted(out)


def whole(df):
    from pyspark.sql import functions as F

    usable = df.filter(exact_search.usable("embedding"))
    return usable.withColumn("vector", F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x)))


def ask(df, k=20):
    w = whole(df)
    return sorted(map(tuple, exact_search.exact_topk(w, w.filter("vec_id % 20 = 0"), k).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("QUERY_BLOCK", 7), ("VECTOR_GROUP", 100), ("STEP", 16), ("QUERY_STEP", 3), ("DIM_BLOCK", 4)):
        monkeypatch.setattr(exact_search, name, value)


def test_exact_is_brute_force(spark, small_blocks):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=24) * (1 + i % 5))]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(60)]  # ties
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows]
    assert ask(frame(spark, rows)) == brute(ints, 20, 20, lambda a, b: int(a @ b), True)


def test_exact_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, NAN]), (3, [INF, 0.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (None, [1.0, 1.0]), (6, [2.0, 2.0]), (6, [2.0, 2.0]), (20, [3.0])]
    assert ask(frame(spark, rows)) == sorted(
        [(0, 1, 6, 64 * 128 + 128 * 128), (0, 2, 20, 64 * 192), (0, 3, 5, 0), (20, 1, 6, 192 * 128), (20, 2, 0, 192 * 64), (20, 3, 5, 0)]
    )
    assert ask(frame(spark, [])) == []
    assert ask(frame(spark, [(1, [1.0])])) == []


def test_exact_large_numbers(spark):
    w = spark.createDataFrame([(0, [3037000499, 1]), (1, [3037000499, 2]), (2, [1, 3])], "vec_id bigint, vector array<bigint>")
    got = sorted(map(tuple, exact_search.exact_topk(w, w.filter("vec_id = 0"), 2).collect()))
    assert got == [(0, 1, 1, 3037000499**2 + 2), (0, 2, 2, 3037000499 + 3)]


def near(df, k=10):
    index = hnsw.build_index(df, k)
    return sorted(map(tuple, hnsw.search_index(index, df.filter("vec_id % 100 = 0"), k).collect()))


def test_hnsw_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_NODES", 1000)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=32))]) for i in range(3000)]
    got = near(frame(spark, rows))
    vectors = np.array([v for _, v in rows])
    hits = total = 0
    for q in range(0, 3000, 100):
        dist = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        dist[q] = np.inf
        want = set(np.argsort(dist, kind="stable")[:10])
        mine = [r for r in got if r[0] == q]
        assert [r[1] for r in mine] == list(range(1, 11))
        assert all(abs(dist[r[2]] - r[3]) < 1e-12 for r in mine)
        hits, total = hits + len(want & {r[2] for r in mine}), total + 10
    assert hits / total >= 0.9


def graph_of(vectors):
    ids = np.arange(len(vectors), dtype=np.int64)
    top = hnsw.levels_of(ids)
    levels = hnsw.build_graph(vectors, top, np.lexsort((ids, -top)))
    return hnsw._Graph({
        "ids": [[i] for i in ids], "vectors": vectors.tobytes(), "n": len(vectors), "width": vectors.shape[1],
        "entry": int(np.lexsort((ids, -top))[0]), "level_nodes": [m.tobytes() for m, _ in levels], "level_links": [x.tobytes() for _, x in levels],
    })


@pytest.mark.parametrize(("clusters", "each", "apart"), [(60, 60, 10), (30, 100, 1000), (200, 12, 50)])
def test_hnsw_of_clusters(clusters, each, apart):
    """No query may lose its neighbours because its group has few links to others."""
    rng = np.random.default_rng(clusters)
    vectors = (rng.normal(size=(clusters, 1, 16)) * apart + rng.normal(size=(clusters, each, 16))).reshape(-1, 16)
    graph = graph_of(vectors)
    asked = np.arange(0, len(vectors), 7)
    for q, found in zip(asked, graph.search(vectors[asked], hnsw.EF), strict=True):
        dist = ((vectors - vectors[q]) ** 2).sum(1)
        assert len(set(np.argsort(dist, kind="stable")[:10]) & set(found[:10])) >= 8


def test_hnsw_reaches_every_node():
    """Also where all links of a node were given up for nearer ones."""
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=(400, 4)), rng.normal(size=(80, 4)) * 1e-3 + 1e4])
    graph = graph_of(vectors)
    for links in graph.levels:
        reached = np.zeros(len(vectors), bool)
        hnsw._spread(links, reached, np.array([graph.entry]))
        assert reached[(links >= 0).any(1)].all()
    cut = np.full((6, 1), -1, np.int32)
    cut[[0, 1, 2, 3], 0] = [1, 0, 3, 2]
    mended = hnsw._reachable(vectors[:6].astype(np.float32), cut, np.arange(6))
    reached = np.zeros(6, bool)
    assert sorted(hnsw._spread(mended, reached, np.array([0]))) == list(range(6))


def test_hnsw_on_the_tables(spark, data):
    got = queries.QUERIES["op10_hnsw"](spark, data).collect()
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    vectors, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    hits = 0
    for q in ids[ids % 100 == 0]:
        dist = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        dist[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, dist))[:10]])
        hits += len(want & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * len(got)


def test_hnsw_edges(spark):
    same = [(i, [1.0, 0.0, 2.0]) for i in range(300)]
    rows = [*same, *same[:5], (300, [1.0, 0.0, 2.5]), (301, None), (302, [0.0, 0.0, 0.0]), (303, [NAN, 1.0, 1.0]), (304, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    got = near(frame(spark, rows))
    assert [r for r in got if r[0] == 0] == [(0, i, i, 0.0) for i in range(1, 11)]
    assert [r for r in got if r[0] == 200] == [(200, i + 1, i, 0.0) for i in range(10)]
    assert [r for r in got if r[0] == 300] == [(300, i + 1, i, 0.5) for i in range(10)]
    assert near(frame(spark, [])) == []
    assert near(frame(spark, [(100, [1.0, 2.0])])) == []
    assert near(frame(spark, [(100, [1.0, 2.0]), (1, [1.0, 2.0])])) == [(100, 1, 1, 0.0)]


def test_cells_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    """Which group a vector is dealt to is given by its content, also when a task is run again."""
    monkeypatch.setattr(exact_search, "VECTOR_GROUP", 16)
    monkeypatch.setattr(exact_search, "QUERY_BLOCK", 4)
    rows = spark.createDataFrame([(i, [i, i % 7]) for i in range(100)], "vec_id bigint, vector array<bigint>")
    plan = exact_search.exact_topk(rows, rows.limit(10), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(" in plan and "monotonically_increasing_id" not in plan
