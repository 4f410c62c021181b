"""Byte-level BPE against the library, and back."""

import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
OURS = byte_bpe.ByteBpe(RANKS, P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_perfect_hash():
    assert sorted(OURS.whole.place) == list(range(len(RANKS)))
    assert all(OURS.tokens[OURS.whole(t)] == t for t in RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab '\n\tsé　\x1c\x85́١½", max_size=80))
def test_like_the_library(text):
    (ids,) = OURS.encode([text])
    assert ids.tolist() == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


def test_rows(spark, data):
    long = "éa" * 100_000 + " " * 5000 + "<|endoftext|>"
    rows = [(1, "Hello world, hello", 1), (2, None, 1), (3, "", 1), (4, long, 1), (4, long, 1), (None, "\n \n", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = byte_bpe.encode(df, PATH, P.PATTERN, decoded=True)
    got = byte_bpe.digests(out).collect()
    want = [THEIRS.encode_ordinary(t or "") for _, t, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr((d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        for (d, t, _), i in zip(rows, want, strict=True)
    )
    again = byte_bpe.decode(out.drop("decoded"), PATH).select("text", "decoded").collect()
    assert all((r.text or "").encode() == bytes(r.decoded) for r in again)
    assert byte_bpe.digests(byte_bpe.encode(df.limit(0), PATH, P.PATTERN, decoded=True)).collect() == []
