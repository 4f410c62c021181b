"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from passagemill.llm import graph, jaccard_join


def sets(text, words=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def brute(rows, percent=85):
    ids, shingles = [d for d, _ in rows], [sets(t) for _, t in rows]
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if None not in (ids[i], ids[j]) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(ids[i]), root(ids[j])))
                up[y] = x
    return sorted(repr((d, len(s), root(d))) for d, s in zip(ids, shingles, strict=True))


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "k", 2) for d, t in rows], "doc_id bigint, text string, n int, key string, id int")
    return sorted(repr(tuple(r)) for r in jaccard_join.near_duplicates(df).collect())


@pytest.mark.parametrize("small", [False, True])
def test_like_all_pairs(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(jaccard_join, "LEAF", 6)
        monkeypatch.setattr(jaccard_join, "LAST", 2)
        monkeypatch.setattr(jaccard_join, "FREQUENT", 20)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=40))
    rows = []
    for i in range(120):
        rows.append((len(rows), " ".join(rng.choices(words, k=rng.choice([3, 8, 30, 60])))))
    for i in range(120):  # chains of small edits, and documents that share a passage
        base = rows[i][1].split(" ") if i % 3 else rows[-1][1].split(" ")
        at = rng.randrange(len(base))
        base[at:at + 1] = rng.choices(words, k=rng.choice([0, 1, 1, 2]))
        rows.append((len(rows), " ".join(base)))
    for i in range(60):
        rows.append((len(rows), passage + " " + " ".join(rng.choices(words, k=rng.choice([2, 4, 6, 20])))))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, long), (8, long + " x"), (9, "É a b c"), (10, "é a b c"), (11, "a b c d e"), (12, "a b c d e"), (13, None)]
    assert run(spark, rows) == brute(rows)
    odd = [(None, "a b c d e"), (4, "a b c d e"), (4, "v w x y z"), (4, "v w x y z"), (9, "v w x y z")]
    assert run(spark, odd) == sorted(map(repr, [(None, 2, None), (4, 2, 4), (4, 2, 4), (4, 2, 4), (9, 2, 4)]))
    assert run(spark, []) == []


def test_exact_threshold(spark):
    # 17 common shingles of 20 in all are 85 per cent; 16 of 19 are less
    a = [f"t{i}" for i in range(23)]
    rows = [(1, " ".join(a[:20])), (2, " ".join(a)), (3, " ".join(f"u{i}" for i in range(19))), (4, " ".join(f"u{i}" for i in range(22)))]
    assert run(spark, rows) == brute(rows) == sorted(map(repr, [(1, 17, 1), (2, 20, 1), (3, 16, 3), (4, 19, 3 if 1600 >= 85 * 19 else 4)]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (150, 100), (7, 7)]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}


def test_repeated_id_in_trees(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 6)
    monkeypatch.setattr(jaccard_join, "LAST", 2)
    # one doc_id with two texts, each like the text of another document
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " x")]
    table = jaccard_join.shingle_table(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85, jaccard_join.np.zeros(0, "u8"))
    node = table.withColumnRenamed("doc_id", "id")
    known = spark.createDataFrame([], "id bigint, component bigint")
    got = jaccard_join._tree_pairs(jaccard_join._meetings(node, 85), node, known, 85).collect()
    assert {tuple(r) for r in got} >= {(1, 2), (1, 3)}
    assert run(spark, rows) == brute(rows)


def test_words_of_equal_polynomial_hash_differ(spark):
    """A Thue-Morse word and its complement agree in every polynomial hash modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(i, " ".join([w] * 6)) for i, w in ((1, one), (2, other), (3, one))]
    assert run(spark, rows) == brute(rows) == sorted(["(1, 1, 1)", "(2, 1, 2)", "(3, 1, 1)"])


def test_keys_of_equal_32_bit_hash_are_different_nodes(spark):
    from pyspark.sql import functions as F

    keys = spark.range(300_000).select(F.md5(F.col("id").cast("string")).cast("binary").alias("key"))
    keys = keys.withColumn("h", F.hash("key"))
    twins = keys.groupBy("h").agg(F.collect_list("key").alias("k")).filter("size(k) > 1").first().k[:2]
    # two nodes with such keys, each with a shingle that only a third node shares
    rows = [(1, twins[0], [10]), (2, twins[1], [20]), (3, bytearray(b"third"), [10, 20])]
    node = spark.createDataFrame([(i, k, 9, p, [0] * 4) for i, k, p in rows], "id bigint, key binary, n int, prefix array<bigint>, signature array<bigint>")
    met = jaccard_join._meetings(node, 85)
    assert {r.token for r in met.collect()} == {10, 20}


def test_of_one_id_the_smallest_text_stays(spark):
    rows = [(1, "b b b b b b"), (1, "a a a a a a"), (1, "a a a a a a"), (2, None), (None, "x"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(repr, map(tuple, jaccard_join.distinct_documents(df).collect())))
    assert got == sorted(map(repr, [(1, "a a a a a a"), (2, None), (None, "x"), (None, "x")]))


def test_wide_bitmaps_keep_all_links_and_spare_long_texts(spark, monkeypatch):
    from passagemill.llm.arrays import mix

    rng = np.random.default_rng(3)
    for n in (1, 3, 40, 700, 3000):
        for m in (n, n + 1, -(-n * 100 // 85)):
            for both in {0, n // 2, n * 9 // 10, n}:
                pool = np.unique(mix(rng.integers(0, 1 << 62, n + m, dtype=np.int64).view(np.uint64)))
                pool = rng.permutation(pool)
                x, y = np.sort(pool[:n]), np.sort(pool[n - both:n - both + m])
                may = jaccard_join._may_link(n, jaccard_join._wide(x), m, jaccard_join._wide(y), 85)
                if 100 * both >= 85 * (n + m - both):
                    assert may
                elif n > 100 and both <= n // 2:
                    assert not may
    # long texts with three quarters in common share rare shingles, but are not compared whole
    words = [f"w{i}" for i in range(4000)]
    rows = [(i, " ".join(words[100 * i:100 * i + 1500])) for i in range(0, 25, 4)] + [(90, " ".join(words[:1490]))]
    seen, real = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *a: seen.append(pairs.collect()) or real(pairs, *a))
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: 0 if i == 90 else i for i, _ in rows}
    assert {(min(r), max(r)) for rows in seen for r in rows} == {(0, 90)}
