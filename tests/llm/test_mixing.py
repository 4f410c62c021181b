"""Mixing: targets by the water level rule, exact word counts, no loss."""

import re
from collections import defaultdict

import pytest

from passagemill.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, unit int, target string, rows int"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)
    return mixing.mix(df).collect()


def targets(sizes):
    """By repeated sharing, in plain Python."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        level = rest / max(1e-9, sum(weight[s] for s in order if s not in full))
        more = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= more


def check(rows, got):
    words = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    assert sorted(map(repr, words)) == sorted(repr((r.doc_id, r.source, r["size"])) for r in got)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, n in words:
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_targets_and_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 5)
    rows = [(i, "w " * (1 + i * 37 % 50), ("a", "b", "c", None, "Z", "é")[min(i % 11, 5)]) for i in range(900)]
    got = run(spark, rows)
    check(rows, got)
    assert sorted(map(repr, got)) == sorted(map(repr, run(spark, rows[::-1])))


def test_edges(spark):
    rows = [(None, None, None), (1, "", "a"), (1, "x", "a"), (1, "x", "a"), (1, "x", "a"), (2, "y " * 5000, "b"), (3, "\u00a0 \x0b\x0c z", "c")]
    check(rows, run(spark, rows))
    assert run(spark, []) == []
    check([(1, None, "a")], run(spark, [(1, None, "a")]))


def test_chances(spark):
    """Over seeds every document is taken as often as its source wants."""
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(40)], "doc_id bigint, text string, source string")
    n = defaultdict(int)
    for seed in range(6):
        for r in mixing.mix(df, seed=seed).collect():
            n[r.source] += r.taken
    sizes = {s: sum(i % 7 + 1 for i in range(40) if "ab"[i % 2] == s) for s in "ab"}
    for s, target in targets(sizes).items():
        assert n[s] / 6 == pytest.approx(target, abs=5)


def test_documents_of_the_mix_follow_the_copies(spark):
    """Equal rows, rows that differ in other columns or null places, and null keys."""
    from collections import Counter

    from pyspark.sql import functions as F

    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3], None if i % 2 else "x", "n") for i in range(300)]
    rows += [(1000, "same text", "a", "x", None)] * 41 + [(1000, "same text", "a", None, "x")] * 20 + [(1000, "text same", "a", "x", "n")] * 9
    rows += [(None, "no id", None, "x", "n")] * 3 + [(7, None, "b", "x", "n"), (8, "", "c", "x", "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, unit string")
    df = df.withColumn("size", F.lit("own")).withColumn("_copies", F.create_map(F.lit("k"), "doc_id"))
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    chosen = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in got.collect())
    wanted = Counter()
    for r in mixing.mix(df).collect():
        wanted[r.doc_id, r.source, r.size] += r.copies
    assert chosen == +wanted
    each = Counter((r.text, r.lang, r.unit) for r in got.collect() if r.doc_id == 1000)
    share, left = divmod(wanted[1000, "a", 2], 70)
    for key, n in {("same text", "x", None): 41, ("same text", None, "x"): 20, ("text same", "x", "n"): 9}.items():
        assert share * n <= each[key] <= (share + 1) * n
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mixed_documents(df.repartition(5)).collect()))
