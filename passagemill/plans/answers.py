"""Registered queries: contexts, prompts and answer records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batched import text_generator
from ..operators.context import context_rows
from ..operators.keyword import bm25_topk, forward_index
from ..operators.qa import RetrievalQA, TwoRouteQA, answer_batch, prompt_rows
from ..operators.rerank import attach_passages, plain_passages, tag_route
from ..operators.retrievers import hybrid_retriever, reranking_retriever, two_route_retriever
from ..session import materialize
from . import fixtures as X
from . import search as S

TEMPLATE = "Context:\n{context}\n\nQ: {question}\nA:"


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Windows, tokens, keyword search and one context string per question."""
    rows = materialize(X.passages(spark, sf), "passages")
    asked = X.questions(spark, sf)
    hits = bm25_topk(asked, materialize(forward_index(rows), "forward"), S.TOP)
    found = attach_passages(hits.drop("score"), rows, "content").withColumnRenamed("content", "text")
    contexts = context_rows(plain_passages(found))
    return asked.join(contexts, "qid", "left").select(
        "qid", "question", "context", F.coalesce("num_sources", F.lit(0)).alias("num_sources")
    )


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    """Vector hits as passages: own type, ratio and weight where present, true score."""
    hits = S.dense(spark, sf)
    corpus = S.vector_passages(spark, sf).select("id", "text", "content_type", F.col("meta").alias("extra"))
    p = hits.join(corpus, "id")
    return p.select(
        "qid",
        "rank",
        "id",
        "text",
        "score",
        "content_type",
        F.coalesce(F.col("extra")["weight"].try_cast("double"), F.lit(0.5)).alias("weight"),
        F.col("extra")["numeric_ratio"].try_cast("double").alias("numeric_ratio"),
        F.lit(None).cast("string").alias("detected_type"),
        "extra",
    )


def context_string(spark: SparkSession, sf: str) -> DataFrame:
    return context_rows(_typed(spark, sf), typed=True).select("qid", "context")


def answer_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Nested sources of every question, shown as text and score in order."""
    rows = context_rows(_typed(spark, sf))
    shown = F.transform(
        "source_documents",
        lambda d: F.concat_ws(
            ":",
            d["text"],
            d["score"].cast("decimal(12,6)").cast("string"),
            d["meta"]["weight"].cast("decimal(3,1)").cast("string"),
        ),
    )
    return rows.select("qid", "num_sources", F.array_join(shown, "|").alias("sources"))


def content_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return context_rows(_typed(spark, sf)).select(
        "qid",
        F.array_join("context_types", ",").alias("context_types"),
        "narrative",
        "table",
        F.col("num_sources").alias("total"),
    )


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of all questions; the context is the whole text of the found passages."""
    index, rows = X.passage_index(spark, sf)
    asked = X.questions(spark, sf)
    contexts = context_rows(hybrid_retriever(index, rows, S.K_HYBRID)(asked))
    return prompt_rows(asked, contexts, TEMPLATE).select("qid", "prompt")


def qa_unified(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    qa = RetrievalQA(hybrid_retriever(index, rows, S.K_HYBRID), template=TEMPLATE)
    return qa(X.questions(spark, sf)).select(
        "qid",
        "query",
        "result",
        F.size("source_documents").alias("n_documents"),
        "reranked",
        "num_sources",
        "unified_index",
    )


def qa_reranked(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    source = rows.drop("content_type")
    qa = RetrievalQA(
        None,
        reranking_retriever(index, source, k=S.K_RERANK, rerank_top_k=S.TOP),
        template=TEMPLATE,
        reranking=True,
    )
    return qa(X.questions(spark, sf)).select("qid", "query", "result", "reranked", "num_sources")


def qa_two_route(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    qa = TwoRouteQA(two_route_retriever(index, rows, k=S.K_ROUTE, rerank_top_k=S.TOP))
    return qa(X.questions(spark, sf)).select(
        "qid",
        "result",
        F.array_join("context_types", ",").alias("context_types"),
        F.col("content_breakdown.narrative").alias("narrative"),
        F.col("content_breakdown.table").alias("table"),
        F.col("content_breakdown.total").alias("total"),
        "reranked",
        "num_sources",
    )


def _short_prompt_model():
    """Stand-in model: refuses prompts without any passage."""

    def answer(batch: list[str]) -> list[str]:
        for prompt in batch:
            if "Relevance" not in prompt:
                raise RuntimeError("no passages were found for this question; " * 4)
        return [prompt.rsplit("Q: ", 1)[1] for prompt in batch]

    return answer


def batch_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A failing question keeps its row and a shortened error; the others are answered."""
    index, rows = X.passage_index(spark, sf)
    generate = text_generator(_short_prompt_model)
    qa = RetrievalQA(
        hybrid_retriever(index, rows, S.K_HYBRID),
        template=TEMPLATE,
        generator=lambda prompt, _best: generate(prompt),
    )
    return answer_batch(X.questions(spark, sf), qa)


def route_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts of tagged vector hits without scores: zero relevance, own ratio only."""
    corpus = S.vector_passages(spark, sf).select("id", "text", F.col("meta").alias("extra"))
    tagged = tag_route(S.tables(spark, sf).join(corpus, "id"), "table", 0.4)
    return context_rows(tagged, typed=True).select("qid", "context", "num_sources")


QUERIES = {
    "flagship_contexts": flagship,
    "context_string": context_string,
    "route_contexts": route_contexts,
    "answer_sources": answer_sources,
    "content_breakdown": content_breakdown,
    "prompt_rows": prompts,
    "qa_unified": qa_unified,
    "qa_reranked": qa_reranked,
    "qa_two_route": qa_two_route,
    "batch_answers": batch_answers,
}

_TOP = f"{S._V}, {S._nearest_sql('top', S.K_DENSE)}"
_PART = "'(Relevance: ' || {score} || '): ' || {text}"
_JOINED = "string_agg(part, chr(10) || chr(10) ORDER BY rank)"
_RATIO = "CASE WHEN label > 4 THEN 0.25 END"

_HYBRID = f"""{X.hybrid_sql(S.K_HYBRID, own=True)},
parts AS (SELECT h.qid, h.rank, content, {_PART.format(score="'0.000'", text='content')} AS part
  FROM hits h JOIN passages USING (id)),
contexts AS (SELECT qid, {_JOINED} AS context, count(*)::INTEGER AS n,
  min_by(content, rank) AS best FROM parts GROUP BY qid)"""

ORACLES = {
    "flagship_contexts": f"""WITH {X.PASSAGES_SQL}, {X.BM25_SQL}, {X.ranked_sql('top', 'bm25', S.TOP)},
parts AS (SELECT qid, rank, {_PART.format(score="'0.000'", text='content')} AS part
  FROM top JOIN passages USING (id))
SELECT q.qid, any_value(question) AS question, {_JOINED} AS context, count(part)::INTEGER AS num_sources
FROM questions q LEFT JOIN parts USING (qid) GROUP BY q.qid""",
    "context_string": f"""WITH {_TOP}, parts AS (
  SELECT qid, rank, '[' || upper(coalesce(content_type, 'unknown')) || ']'
    || CASE WHEN content_type = 'table' THEN ' (Numeric: ' || {X.fixed_sql(_RATIO, 2)} || ')' ELSE '' END
    || ' ' || {_PART.format(score=X.fixed_sql('score', 3), text='text')} AS part FROM top)
SELECT qid, {_JOINED} AS context FROM parts GROUP BY qid""",
    "route_contexts": f"""WITH {S._V}, {S._nearest_sql('top', S.K_ROUTE, 'table')}, parts AS (
  SELECT qid, rank, '[TABLE] (Numeric: ' || {X.fixed_sql(_RATIO, 2)} || ') '
    || {_PART.format(score="'0.000'", text='text')} AS part FROM top)
SELECT qid, {_JOINED} AS context, count(*)::INTEGER AS num_sources FROM parts GROUP BY qid""",
    "answer_sources": f"""WITH {_TOP}
SELECT qid, count(*)::INTEGER AS num_sources, string_agg(text || ':' || score::DECIMAL(12,6)::VARCHAR || ':'
  || CASE WHEN label = 2 THEN '0.9' ELSE '0.5' END, '|' ORDER BY rank) AS sources FROM top GROUP BY qid""",
    "content_breakdown": f"""WITH {_TOP}
SELECT qid, string_agg(coalesce(content_type, 'unknown'), ',' ORDER BY rank) AS context_types,
  (count(*) FILTER (content_type = 'narrative'))::INTEGER AS narrative,
  (count(*) FILTER (content_type = 'table'))::INTEGER AS "table", count(*)::INTEGER AS total
FROM top GROUP BY qid""",
    "prompt_rows": f"""WITH {_HYBRID}
SELECT q.qid, 'Context:' || chr(10) || coalesce(context, '') || chr(10) || chr(10) || 'Q: ' || question
  || chr(10) || 'A:' AS prompt FROM questions q LEFT JOIN contexts USING (qid)""",
    "qa_unified": f"""WITH {_HYBRID}
SELECT q.qid, question AS query, coalesce(best, '') AS result, coalesce(n, 0) AS n_documents,
  false AS reranked, coalesce(n, 0) AS num_sources, true AS unified_index
FROM questions q LEFT JOIN contexts USING (qid)""",
    "qa_reranked": f"""WITH {S.detect_sql()}
SELECT q.qid, any_value(q.question) AS query, coalesce(min_by(content, rank), '') AS result,
  true AS reranked, count(p.id)::INTEGER AS num_sources
FROM questions q LEFT JOIN picked p USING (qid) GROUP BY q.qid""",
    "qa_two_route": f"""WITH {S.two_route_sql()}
SELECT q.qid, coalesce(min_by(content, rank), '') AS result,
  coalesce(string_agg(content_type, ',' ORDER BY rank), '') AS context_types,
  (count(*) FILTER (content_type = 'narrative'))::INTEGER AS narrative,
  (count(*) FILTER (content_type = 'table'))::INTEGER AS "table", count(p.id)::INTEGER AS total,
  true AS reranked, count(p.id)::INTEGER AS num_sources
FROM questions q LEFT JOIN picked p USING (qid) GROUP BY q.qid""",
    "batch_answers": f"""WITH {_HYBRID}
SELECT row_number() OVER (ORDER BY q.qid) AS ordinal, q.qid, question,
  CASE WHEN n > 0 THEN question || chr(10) || 'A:' END AS answer,
  CASE WHEN n IS NULL THEN substr(repeat('no passages were found for this question; ', 4), 1, 100) END AS error
FROM questions q LEFT JOIN contexts USING (qid)""",
}
