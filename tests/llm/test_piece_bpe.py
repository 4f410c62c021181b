"""SentencePiece BPE against the library, and back."""

import hashlib
import pickle

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm import piece_bpe

PATH = P.path("piece_bpe_32k.model")
OURS = piece_bpe.PieceBpe(piece_bpe.Model(PATH))
THEIRS = sentencepiece.SentencePieceProcessor(model_file=PATH)
piece_bpe._register()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("ab ▁'\n\tsé　\x1c\x85́١½", max_size=80) | st.text(" ▁a", max_size=60))
def test_like_the_library(text):
    (ids,) = OURS.encode([text])
    assert ids.tolist() == THEIRS.encode(text)
    assert OURS.decode(ids) == THEIRS.decode(ids.tolist())


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.integers(259, 31999) | st.integers(3, 258) | st.sampled_from([259, 28705, 1, 2]), max_size=12))
def test_decode_any_ids(ids):
    assert OURS.decode(np.array(ids, np.int64)) == THEIRS.decode(ids)


def test_without_cuts_between_units():
    """Units may be as long as the text: the cuts only save work."""
    whole = pickle.loads(pickle.dumps(OURS))
    letters = "".join(sorted({c for p in whole.ids for c in p} - set("\\]^-")))
    whole.pattern = f"[{letters}]+|(?s:.)"
    text = "the  cat sat on   the mat, " * 2000 + "\n\n" + "ab" * 20_000 + " " * 5000 + "x"
    assert whole.encode([text])[0].tolist() == THEIRS.encode(text) == OURS.encode([text])[0].tolist()


def test_remembered_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED_UNITS", 3)
    monkeypatch.setattr(piece_bpe, "REMEMBERED_PAIRS", 5)
    fresh = pickle.loads(pickle.dumps(OURS))
    for text in ("one two three four five", "six seven eight", "one two nine"):
        assert fresh.encode([text])[0].tolist() == THEIRS.encode(text)
    assert len(fresh.pairs) <= 5


def test_rows(spark):
    long = "éa" * 100_000 + " " * 5000 + "</s><0x41>"
    rows = [(1, "Hello world, hello", 1), (2, None, 1), (3, "", 1), (4, long, 1), (4, long, 1), (None, "\n \n", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int").selectExpr("*", "'x' AS decoded")
    out = piece_bpe.encode(df, PATH, decoded=True)
    again = piece_bpe.decode(piece_bpe.encode(df, PATH), PATH)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    want = []
    for d, t, _ in rows:
        ids = THEIRS.encode(t or "")
        joined = ",".join(map(str, ids)).encode()
        want.append((d, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(THEIRS.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, piece_bpe.digests(out).collect()))) == sorted(map(repr, want))
    assert piece_bpe.digests(piece_bpe.encode(df.limit(0), PATH, decoded=True)).collect() == []
    nulls = piece_bpe.decode(spark.createDataFrame([(1, None)], "doc_id int, ids array<int>"), PATH)
    assert nulls.first().decoded is None


def test_query_on_whole_table(spark, data):
    from passagemill.llm import queries

    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_piece_bpe(spark, data).collect()}
    for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        ids = THEIRS.encode(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id] == (len(ids), digest, hashlib.sha256(THEIRS.decode(ids).encode()).hexdigest())


def test_other_models_are_refused(tmp_path):
    bare = tmp_path / "m.model"
    bare.write_bytes(b"\x0a\x08\x0a\x01a\x15\x00\x00\x80\xbf")
    with pytest.raises(ValueError, match="not supported"):
        piece_bpe.Model(str(bare))
