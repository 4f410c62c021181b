"""Repair of conversations against exhaustive search and a plain shortest path."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm import turn_repair as tr

GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_faults(rows):
    """Kind of each (role, text) row by the rules."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        if not body:
            out.append(tr.BLANK)
        elif (role, text) in seen:
            out.append(tr.COPY)
        else:
            out.append(tr.SOUND if body[-1] in ".!?" else tr.CUT)
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, letters, repaired) by comparing tuples from the end; up to two insertions anywhere."""
    memo = {}

    def after(i, state, inserted):
        key = i, state, inserted
        if key in memo:
            return memo[key]
        options = []
        name = {1: "user", 2: "assistant"}
        step = {0: 1, 3: 1, 1: 2, 2: 1}  # 0 nothing, 3 after s, 1 after u, 2 after a
        if inserted < 2:
            c, a, t = after(i, step[state], inserted + 1)
            options.append((c + 2, "I" + a, [(name[step[state]], "")] + t))
        if i == len(rows):
            if state in (0, 2):
                options.append((0, "", []))
        else:
            (role, text), kind = rows[i], kinds[i]
            c, a, t = after(i + 1, state, 0)
            options.append((c + 3, "D" + a, t))
            if kind in (tr.SOUND, tr.CUT):
                late = kind == tr.CUT
                c, a, t = after(i + 1, step[state], 0)
                options.append((c + 2 + late, "R" + a, [(name[step[state]], text)] + t))
                if role[:1] == name[step[state]][0]:
                    options.append((c + late, "K" + a, [(role, text)] + t))
                if role[:1] == "s" and state == 0:
                    c, a, t = after(i + 1, 3, 0)
                    options.append((c + late, "K" + a, [(role, text)] + t))
        memo[key] = min(options, default=(10**9, "", []), key=lambda o: o[:2])
        return memo[key]

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for state in (0, 1, 2, 3):
            after(i, state, 0)
    return after(0, 0, 0)


def ours(rows, kinds):
    whole = [tr.Row(r, t, k, 1) for (r, t), k in zip(rows, kinds)]
    digits = tr.width(whole) + 2
    cost, octal = tr.split(tr.finish(tr.solve(whole, tr.START, 2), digits), digits)
    audit = tr.letters(octal)
    return cost, audit, [(t["role"], t["text"]) for t in tr.apply(whole, audit)]


texts = st.sampled_from(["a.", "b!", "c", "", " \n", "d?  ", "e. f"])
roles = st.sampled_from(["user", "assistant", "system", "tool", "", " ", "used", "sage"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=9))
def test_like_a_plain_search(rows):
    kinds = plain_faults(rows)
    assert ours(rows, kinds) == cheapest(rows, kinds)
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in ours(rows, kinds)[2]))


def test_every_edit_sequence_of_short_conversations():
    """No sequence with up to three insertions in every gap is cheaper, or as cheap and less."""
    for initials in itertools.chain(*(itertools.product("sua", repeat=n) for n in range(4))):
        rows = [({"s": "system", "u": "user", "a": "assistant"}[c], f"{i}.") for i, c in enumerate(initials)]
        best = None
        choices = [("K", "Ru", "Ra", "D")] * len(rows)
        for edits in itertools.product(*choices):
            for gaps in itertools.product(("", "u", "a", "ua", "au", "uau"), repeat=len(rows) + 1):
                made = letters = ""
                cost = 0
                for gap, edit, c in itertools.zip_longest(gaps, edits, initials, fillvalue=""):
                    made, letters, cost = made + gap, letters + "I" * len(gap), cost + 2 * len(gap)
                    made += c if edit == "K" else edit[1:]
                    letters += edit[:1]
                    cost += {"K": 0, "R": 2, "D": 3, "": 0}[edit[:1]]
                if GRAMMAR.fullmatch(made) and (best is None or (cost, letters) < best):
                    best = cost, letters
        assert ours(rows, [tr.SOUND] * len(rows))[:2] == best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=14), st.lists(st.integers(1, 5), min_size=1, max_size=6))
def test_stretches_multiply_to_the_whole(rows, sizes):
    kinds = plain_faults(rows)
    whole = [tr.Row(r, t, k, 1) for (r, t), k in zip(rows, kinds)]
    product, at = tr.Product(), 0
    for size in itertools.cycle(sizes):
        part = whole[at:at + size]
        product.add(tr.width(part), [tr.solve(part, q) for q in range(4)])
        at += size
        if at >= len(whole):
            break
    digits, best = product.total()
    assert digits == tr.width(whole) and best == tr.solve(whole, tr.START)


def expected(rows):
    """The report of each conversation by the rules; rows are (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv for _ in range(r[4])]
        mine.sort(key=lambda r: ((r[1] is not None, r[1] or 0), r[2].encode(), r[3].encode()))
        said = [(r[2], r[3]) for r in mine]
        kinds = plain_faults(said)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, made = cheapest(said, kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, kinds.count(tr.BLANK), kinds.count(tr.COPY), kinds.count(tr.CUT), illegal, cost, audit, digest)
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report(df):
    rows = tr.digests(df).select(*COLUMNS).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


EDGES = [
    (1, 0, "user", "hi.", 1), (1, 1, "assistant", "yes.", 1), (1, 1, "assistant", "yes.", 2), (1, 4, "user", "hi.", 1),
    (2, None, "system", "s.", 1), (2, None, "user", "é", 1), (2, -3, "assistant", "　", 1), (2, 9, "assistant", "ok. \t\n", 1),
    (None, 0, "user", "x!", 1), (None, 1, "tool", "y?", 1),
    (3, 0, " ", " ", 0), (4, 0, "system", "only", 1), (5, 0, "assistant", "", 1), (5, 1, " ", " ", 1),
]


def make(spark, rows):
    """With columns whose names clash with those made inside."""
    wide = [(*r, 1, "x", "y", "z") for r in rows]
    return spark.createDataFrame(wide, "conv_id bigint, turn bigint, role string, text string, copies int, part int, late string, place string, s string")


@pytest.mark.parametrize("block", [1, 2, 256])
def test_edges(spark, monkeypatch, block):
    monkeypatch.setattr(tr, "BLOCK", block)
    df = make(spark, EDGES)
    found = tr.repair(df, copies="copies")
    assert report(found) == expected(EDGES)
    out = {}
    for r in sorted(tr.repaired_turns(found).collect(), key=lambda r: (r.conv_id or 0, r.place, r.number)):
        out.setdefault(r.conv_id, []).append(r.role[:1])
    assert all(GRAMMAR.fullmatch("".join(v)) for v in out.values())
    assert tr.digests(tr.repair(df.limit(0))).collect() == []


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(tr, "BLOCK", 16)
    monkeypatch.setattr(tr, "OUT_ROWS", 7)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = ("user", "assistant", "user", "system", "assistant")
        rows = [(7, i // 2, names[i * 7 % 5], f"t {i % 97}" + "." * (i % 3), 1) for i in range(300)]
        rows += [(i, j, names[(i + j) % 2], f"{i} {j}!", 1) for i in range(20, 60) for j in range(4)]
        rows += [(7, 5, "user", "again.", 150)]
        assert report(tr.repair(make(spark, rows), copies="copies")) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)


def test_damage(spark):
    rows = [(i, t, r, x) for i in [None, *range(30)] for t, r, x in [(0, "system", "a. b"), (1, None, "c?"), (None, "user", None)]]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    want = []
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        if f == 0:
            want.append((conv, None, " ", " ", 0))
        else:
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            want.append((conv, turn, "user" if f == 4 else role, text, 2 if f == 3 else 1))
    got = [tuple(r) for r in tr.damaged(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert report(tr.repair(tr.damaged(df), copies="copies")) == expected(want)
