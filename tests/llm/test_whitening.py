"""Whitening against dense linear algebra and exact sums in plain Python."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm import queries, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, n int, component string, whitened string, deviation string"


def frame(spark, rows):
    """With columns whose names clash with those made inside."""
    return spark.createDataFrame([(i, v, 1, "c", "w", "d") for i, v in rows], SCHEMA)


def brute(rows, k):
    """(n, {(id, deviation)}, eigenvalues, explained) by fractions and numpy's solver."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept]
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    y = [[n * c - s for c, s in zip(r, sums)] for r in x]
    deviation = [(i, sum(c * c for c in r)) for (i, _), r in zip(kept, y)]
    cov = np.array([[float(Fraction(sum(a[p] * a[q] for a in y), n**3)) for q in range(width)] for p in range(width)])
    values, vectors = np.linalg.eigh(cov) if width else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = np.array(y, float).reshape(n, width) / max(n, 1) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return n, deviation, white, values / max(np.trace(cov), 1e-300) if width else values


def check(got, rows, k=32):
    n, deviation, white, share = brute(rows, k)
    assert len(got) == n * len(share)
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(deviation)
    assert {r.n for r in got} == {n}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-10
    for c in range(len(share)):
        mine = sorted((r.vec_id, r.deviation, r.whitened) for r in got if r.component == c + 1)
        for sign in (1, -1):
            theirs = sorted((i, d, sign * w) for (i, d), w in zip(deviation, white[:, c]))
            if np.allclose([m[2] for m in mine], [t[2] for t in theirs], atol=1e-6):
                break
        else:
            raise AssertionError(f"component {c + 1} differs")
    explained = {(r.component, r.explained) for r in got}
    assert np.allclose([e for _, e in sorted(explained)], share, rtol=1e-9)


def test_query_is_brute_force(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    rows = [(i, None if v is None else [float(np.float32(c)) if c is not None else None for c in v]) for i, v in rows]
    check(queries.op11_whitening(spark, data).collect(), rows)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 4)
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [5, 3, 2, 1, 0.5]]) for i in range(40)]
    rows += [(3, rows[3][1]), (41, None), (42, [NAN] * 5), (43, [1.0, INF, 0.0, 0.0, 0.0]), (44, [1.0, None]), (45, [2.0, 1.0]), (46, [])]
    assert all(len(v or []) <= 5 for _, v in rows)
    check(whitening.whiten(frame(spark, rows)).collect(), rows)
    check(whitening.whiten(frame(spark, rows), 2).collect(), rows, 2)


def test_null_id_and_other_columns(spark):
    df = frame(spark, [(None, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [3.0, 3.0])])
    assert len(whitening.whiten(df).collect()) == 6
    model = whitening.fit(df)
    out = whitening.transform(df, model)
    assert out.columns == ["vec_id", "embedding", "n", "component", "whitened", "deviation"]
    with pytest.raises(Exception, match="3 entries"):
        whitening.transform(frame(spark, [(1, [1.0, 2.0, 3.0])]), model).collect()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])] * 5, [(1, []), (2, [])]])
def test_nothing_to_scale(spark, rows):
    """Without rows, or with equal rows only, no component has any variance."""
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_far_entries_stay_exact(spark):
    """Beyond 2^40 steps an entry counts as 2^40; sums do not wrap around and no row is lost."""
    rows = [(1, [3e30, 0.0]), (2, [-3e30, 1.0]), (3, [5.0, -1.0]), (4, [0.0, 7.0])]
    found = whitening.statistics(frame(spark, rows))
    big = 1 << 40
    x = [[big, 0], [-big, 64], [320, -64], [0, 448]]
    sums = [sum(c) for c in zip(*x)]
    want = [[sum((4 * a[p] - sums[p]) * (4 * a[q] - sums[q]) for a in x) // 4 for q in range(2)] for p in range(2)]
    assert found.scaled_covariance.tolist() == want
    assert found.sums == [s + 4_000_000 for s in sums]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4} and {r.deviation for r in got if r.vec_id == 1} == {None}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.sampled_from(["spread", "equal", "pairs", "low rank"]))
def test_components(n, seed, kind):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {
        "spread": rng.exponential(size=n), "equal": np.ones(n), "pairs": np.repeat(rng.exponential(size=n), 2)[:n],
        "low rank": np.where(np.arange(n) < (n + 1) // 2, rng.exponential(size=n), 0),
    }[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, rows = whitening.leading_components(a, 32)
    assert np.allclose(found.astype(float), np.linalg.eigvalsh(a)[::-1], atol=1e-13)
    assert np.abs(rows @ rows.T - np.eye(n)).max() < 1e-15
    assert np.abs(a @ rows.T - rows.T * found).max() < 1e-13


def test_sturm_counts():
    d, e = np.array([4.0, 1.0, 3.0, 2.0], np.longdouble), np.array([1.0, 0.5, 0.0], np.longdouble)
    values = np.linalg.eigvalsh(np.diag(d.astype(float)) + np.diag(e.astype(float), 1) + np.diag(e.astype(float), -1))
    shifts = np.array([-10, 1.0, 2.5, 3.3, 10], np.longdouble)
    assert whitening.sturm_count(d, e, shifts).tolist() == [(values < s).sum() for s in shifts.astype(float)]
