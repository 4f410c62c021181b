"""Cost-bounded splitting against all splits."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagemill.functions.text import token_count
from passagemill.operators.boundaries import cheapest_cuts, split_at_boundaries

SCHEMA = "doc_id int, pos int, headings array<string>, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=9), st.integers(1, 6), st.integers(0, 6))
def test_no_split_is_cheaper(costs, room, piece):
    n = len(costs)

    def price(starts):
        return piece * len(starts) + sum(costs[s - 1] for s in starts if s)

    splits = [[0, *c] for k in range(n) for c in itertools.combinations(range(1, n), k)]
    fitting = [s for s in splits if all(b - a <= room for a, b in zip(s, [*s[1:], n]))]
    cheapest = min(map(price, fitting))
    got = cheapest_cuts(np.array(costs), room, piece)
    assert got in fitting and price(got) == cheapest
    # ties: pieces as long as can be, the last one first
    assert got[::-1] == min(s[::-1] for s in fitting if price(s) == cheapest)


def pieces(spark, rows, cap, **options):
    out = split_at_boundaries(spark.createDataFrame(rows, SCHEMA), cap, **options)
    return {(r.doc_id, r.piece): (r.headings, r.text) for r in out.collect()}


def test_strong_boundaries_are_preferred(spark):
    text = "One two three. Four five six, seven eight.\n\nNine ten eleven twelve\nthirteen fourteen. Fifteen"
    got = pieces(spark, [(1, 0, None, text)], 8)
    assert [got[1, i][1] for i in range(2)] == ["One two three. Four five six, seven eight.\n\n", "Nine ten eleven twelve\nthirteen fourteen. Fifteen"]
    got = pieces(spark, [(1, 0, None, text)], 4, piece_cost=1)
    assert [t for _, (_, t) in sorted(got.items())] == ["One two three. ", "Four five six, ", "seven eight.\n\n", "Nine ten eleven twelve\n", "thirteen fourteen. Fifteen"]


def test_edges(spark):
    long = "wörd, " * 30_000
    rows = [(1, 0, ["h one"], "a b c d"), (2, 0, ["one two three four five"], "x. y. z. w"), (3, 0, None, None), (4, 0, None, ""), (5, 0, None, "... ?"), (6, 0, None, "  «lead word» tail.  "), (7, 0, None, long), (1, 0, ["h one"], "a b c d")]
    got = split_at_boundaries(spark.createDataFrame(rows, SCHEMA), 4)
    whole = got.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"]), "").alias("t"), F.max(token_count("text")).alias("n"))
    found = {r.doc_id: (r.t, r.n) for r in whole.collect()}
    assert found[2] == ("x. y. z. w", 4) and found[4] == ("", 0) and found[5] == ("... ?", 0) and found[6] == ("  «lead word» tail.  ", 3)
    assert found[7] == (long, 4) and 3 not in found
    one = got.where("doc_id = 1").collect()
    assert sorted((r.piece, r.text) for r in one) == [(0, "a b "), (0, "a b "), (1, "c d"), (1, "c d")]  # beside two words of headings
    assert all(r.headings == ["h one"] for r in one)
    assert got.where("doc_id = 2").first().headings is None  # headings that fill the limit alone
    for bad in ({"max_tokens": 0}, {"costs": {"page": 1}}, {"piece_cost": -1}):
        with pytest.raises(ValueError):
            split_at_boundaries(spark.createDataFrame(rows, SCHEMA), **bad)
    assert split_at_boundaries(spark.createDataFrame([], SCHEMA)).collect() == []
