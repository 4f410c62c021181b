"""Each stage of the pipeline on rows with every kind of gap, and against plain readings."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from passagemill.llm import byte_bpe, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity int, quality_score string"
STAGES = dict(corpus_pipeline.STAGES)
LONG = "one two three four five six seven " * 3000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 1), (2, "the quick brown fox jumps over the lazy dog again", "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog again", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (None, "no id but some words in it", "de", "b", 3), (5, LONG, "en", "c", 9), (6, " \n\t", "fr", None, 2), (7, "é", "fr", "c", 1),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_gaps_and_empty_tables(spark, data, docs, name):
    out = STAGES[name](spark, docs, data)
    if name != "encoding":
        assert out.columns == docs.columns
    out.collect()
    assert STAGES[name](spark, docs.limit(0), data).collect() == []


def test_near_duplicates_keep_the_smallest_id(spark, data, docs):
    got = STAGES["near_duplicates"](spark, docs, data).collect()
    same(got, [r for r in docs.dropDuplicates().collect() if r.doc_id != 2])


def test_without_labels_of_two_classes_nothing_goes(spark, tmp_path, docs):
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("quality", "toxicity"):
        same(STAGES[name](spark, docs, str(tmp_path)).collect(), docs.collect())


def test_rejecting_stages_follow_their_scores(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = {r.doc_id for r in STAGES["toxicity"](spark, docs, data).collect()}
    model = toxicity.train(docs, corpus_pipeline._labels(spark, data))
    assert kept == {r.doc_id for r in toxicity.score(docs, model).collect() if r.toxicity < 0.5}
    learned = corpus_pipeline._labels(spark, data).filter(toxicity.held_out("doc_id")).count()
    assert learned == 0 and 0 < len(kept) <= docs.count()


def test_mixing_repeats_or_leaves_out_whole_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    first = [tuple(r) for r in STAGES["mixing"](spark, docs, data).collect()]
    assert set(first) <= {tuple(r) for r in docs.collect()}
    same(first, STAGES["mixing"](spark, docs, data).collect())
    assert max(first.count(r) for r in set(first)) <= 3


def test_encoding_is_that_of_the_library(spark, data, docs):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    same(STAGES["encoding"](spark, docs, data).collect(), want)
