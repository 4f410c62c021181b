"""Passages, reranking, contexts and answer records."""

import sys

import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from passagemill.functions.batched import batched_apply, text_generator
from passagemill.operators.context import context_rows
from passagemill.operators.index import Index, build_index
from passagemill.operators.qa import RetrievalQA, TwoRouteQA, answer_batch, number_questions
from passagemill.operators.rerank import (
    detect_types,
    plain_passages,
    rerank_passages,
    tag_route,
    union_routes,
)
from passagemill.operators.retrievers import (
    dense_retriever,
    hybrid_retriever,
    reranking_retriever,
    two_route_retriever,
)

register_pickle_by_value(sys.modules[__name__])

FOUND = "qid long, rank int, id long, text string, extra map<string,string>"


@pytest.fixture
def asked(spark):
    return spark.createDataFrame(
        [(1, "alpha beta"), (2, "gamma"), (3, "unknown")], "qid long, question string"
    )


@pytest.fixture
def found(spark):
    rows = [
        (1, 1, 10, "beta", {}),
        (1, 2, 11, "alpha beta 12,5%", {"weight": "0.9", "lang": "en"}),
        (1, 3, 12, "a | b", {"content_type": "special", "numeric_ratio": "0.5"}),
        (2, 1, 11, "alpha beta 12,5%", None),
    ]
    return spark.createDataFrame(rows, FOUND)


def test_row_metadata_wins_over_detected_values(found):
    got = {(r.qid, r.id): r for r in detect_types(found, 0.6, 0.4).collect()}
    assert (got[1, 10].content_type, got[1, 10].weight) == ("narrative", 0.6)
    assert (got[1, 11].content_type, got[1, 11].weight) == ("table", 0.9)
    assert (got[1, 12].content_type, got[1, 12].detected_type) == ("special", "table")
    assert got[1, 12].numeric_ratio == 0.5 and got[2, 11].numeric_ratio == 5 / 16


def test_rerank_by_question_terms(found, asked):
    p = detect_types(found)
    got = [(r.qid, r["rank"], r.id, r.score) for r in rerank_passages(p, asked, 2).collect()]
    assert sorted(got) == [(1, 1, 11, 1.0), (1, 2, 10, 0.5), (2, 1, 11, 0.0)]


def test_without_scorer_the_order_stays(found, asked):
    p = detect_types(found)
    got = rerank_passages(p, asked, 2, scorer=None).collect()
    assert sorted((r.qid, r["rank"], r.id) for r in got) == [(1, 1, 10), (1, 2, 11), (2, 1, 11)]


def test_weights_are_an_option(found, asked):
    p = detect_types(found).withColumn("weight", F.when(F.col("id") == 10, 5.0).otherwise(1.0))
    best = rerank_passages(p, asked, 1, use_weights=True).where("qid = 1").first()
    assert (best.id, best.score) == (10, 2.5)


def scorer_model():
    def score(texts):
        if any("|" in t for t in texts):
            raise RuntimeError("cannot score")
        return [float(len(t)) for t in texts]

    return score


def test_a_failing_scorer_keeps_the_order_of_its_question(found, asked):
    score = batched_apply(scorer_model, 1, lambda: None, "double")
    got = rerank_passages(detect_types(found), asked, 3, scorer=lambda _q, t: score(t)).collect()
    assert sorted((r.qid, r["rank"], r.id) for r in got) == [
        (1, 1, 10),
        (1, 2, 11),
        (1, 3, 12),
        (2, 1, 11),
    ]


def test_routes_keep_duplicates_narrative_first(found):
    both = union_routes(tag_route(found, "narrative", 0.6), tag_route(found, "table", 0.4))
    got = sorted((r.qid, r["rank"], r.id, r.content_type) for r in both.collect())
    assert got[0] == (1, 1, 10, "narrative") and got[3] == (1, 4, 10, "table")
    assert len(got) == 8


def test_contexts(found):
    plain = context_rows(plain_passages(found)).where("qid = 1").first()
    assert plain.context.split("\n\n")[0] == "(Relevance: 0.000): beta"
    assert plain.num_sources == 3 and plain.context_types == ["unknown", "unknown", "special"]
    typed = context_rows(detect_types(found), typed=True).where("qid = 1").first()
    assert typed.context.split("\n\n") == [
        "[NARRATIVE] (Relevance: 0.000): beta",
        "[TABLE] (Numeric: 0.31) (Relevance: 0.000): alpha beta 12,5%",
        "[SPECIAL] (Relevance: 0.000): a | b",
    ]
    assert (typed.narrative, typed.table, typed.num_sources) == (1, 1, 3)


def test_answers_without_passages(found, asked):
    qa = RetrievalQA(lambda _q: plain_passages(found))
    got = {r.qid: r for r in qa(asked).collect()}
    assert got[1].result == "beta" and got[1].num_sources == 3 and not got[1].reranked
    assert got[3].result == "" and got[3].source_documents == [] and got[3].num_sources == 0
    assert got[1].source_documents[1].extra == {"weight": "0.9", "lang": "en"}
    two = {r.qid: r for r in TwoRouteQA(lambda _q: detect_types(found))(asked).collect()}
    assert two[3].context_types == [] and two[3].content_breakdown.total == 0
    assert two[1].context_types == ["narrative", "table", "special"] and two[1].reranked


def test_wrong_setup_is_an_error(found):
    with pytest.raises(ValueError):
        RetrievalQA(lambda q: q, reranking=True)
    with pytest.raises(ValueError):
        RetrievalQA(lambda q: q, template="no placeholders")
    with pytest.raises(ValueError):
        TwoRouteQA(lambda q: q, template="{context} only")


def chat_model():
    def answer(prompts):
        if any("unknown" in p for p in prompts):
            raise RuntimeError("x" * 300)
        return [p.upper() for p in prompts]

    return answer


def test_one_failing_question_does_not_stop_the_rest(found, asked):
    generate = text_generator(chat_model)
    qa = RetrievalQA(
        lambda _q: plain_passages(found),
        template="{question}|{context}",
        generator=lambda prompt, _best: generate(prompt),
    )
    got = {r.qid: r for r in answer_batch(asked, qa).collect()}
    assert got[1].answer.startswith("ALPHA BETA|") and got[1].error is None
    assert got[3].answer is None and got[3].error == "x" * 100
    assert [got[i].ordinal for i in (1, 2, 3)] == [1, 2, 3]


def test_question_numbers_across_ranges(spark):
    rows = spark.createDataFrame([(i,) for i in (5, 1, 99_999, 20_000, 7)], "qid long")
    got = sorted((r.qid, r.ordinal) for r in number_questions(rows).collect())
    assert got == [(1, 1), (5, 2), (7, 3), (20_000, 4), (99_999, 5)]


def test_retrievers_end_to_end(spark):
    texts = [
        (1, "net profit rose in spring", "narrative"),
        (2, "profit | 12 | 13", "table"),
        (3, "branches in the north", "narrative"),
    ]
    rows = spark.createDataFrame(texts, "id long, content string, content_type string")
    index = Index("retriever_test", 64)
    build_index(rows, index)
    asked = spark.createDataFrame([(1, "profit spring", None), (2, "north", 0)],
                                  "qid long, question string, k_override int")
    hybrid = hybrid_retriever(index, rows, 2)(asked).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id) for r in hybrid][0] == (1, 1) and {r.qid for r in hybrid} == {1}
    assert dense_retriever(index, rows, 1)(asked).where("qid = 2").first().id == 3
    reranked = reranking_retriever(index, rows.drop("content_type"), rerank_top_k=1)(asked)
    assert reranked.where("qid = 1").first().id == 1
    routes = two_route_retriever(index, rows)(asked).where("qid = 1").collect()
    assert {(r.id, r.content_type) for r in routes} == {(1, "narrative"), (2, "table"), (3, "narrative")}
