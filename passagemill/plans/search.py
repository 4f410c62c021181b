"""Registered queries: dense, keyword, fused and approximate ranking; reranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ann import search_cells
from ..operators.dense import dense_topk
from ..operators.fusion import reciprocal_rank_fusion, take_top
from ..operators.keyword import bm25_topk, forward_index
from ..operators.postings import postings_topk
from ..operators.rerank import detect_types, rerank_passages, tag_route, union_routes
from ..operators.retrievers import (
    dense_retriever,
    hybrid_hits,
    hybrid_retriever,
    narrative_retriever,
    reranking_retriever,
    table_retriever,
    two_route_retriever,
)
from ..session import materialize
from . import fixtures as X

K_DENSE, K_HYBRID, K_RERANK, K_ROUTE, TOP = 12, 15, 6, 3, 5


def vector_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every given vector asks for its neighbours."""
    return X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def vector_passages(spark: SparkSession, sf: str) -> DataFrame:
    """The given vectors as passages, with a type and partial metadata by label."""
    label = F.col("label")
    kind = F.when(label == 5, F.lit(None)).when(label.isin(0, 3, 6, 9), "table").otherwise("narrative")
    meta = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(
                    F.lit("numeric_ratio").alias("key"),
                    F.when(label > 4, F.lit("0.25")).alias("value"),
                ),
                F.struct(
                    F.lit("weight").alias("key"), F.when(label == 2, F.lit("0.9")).alias("value")
                ),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    return X.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        "embedding",
        kind.alias("content_type"),
        F.concat(F.lit("passage "), F.col("vec_id").cast("string")).alias("text"),
        meta.alias("meta"),
    )


def _nearest(spark: SparkSession, sf: str, k: int, kind: str | None = None) -> DataFrame:
    corpus = vector_passages(spark, sf)
    if kind:
        corpus = corpus.where(F.col("content_type") == kind)
    return dense_topk(vector_questions(spark, sf), corpus, k, dim=64)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return _nearest(spark, sf, K_DENSE)


def narrative(spark: SparkSession, sf: str) -> DataFrame:
    return _nearest(spark, sf, K_ROUTE, "narrative")


def tables(spark: SparkSession, sf: str) -> DataFrame:
    return _nearest(spark, sf, K_ROUTE, "table")


def keyword(spark: SparkSession, sf: str) -> DataFrame:
    """BM25 over whole documents, tokenised once."""
    docs = X.table(spark, sf, "documents")
    index = materialize(forward_index(docs, id_column="doc_id", text="text"), "forward")
    return bm25_topk(X.questions(spark, sf), index, TOP)


def keyword_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """BM25 over passages, from the stored index."""
    index, _ = X.passage_index(spark, sf)
    return bm25_topk(
        X.questions(spark, sf),
        index.postings(spark),
        K_HYBRID,
        index.terms(spark),
    )


def keyword_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The same ranking from stored postings: only blocks of asked terms are read."""
    return postings_topk(X.questions(spark, sf), X.passage_postings(spark, sf), K_HYBRID)


def fusion(spark: SparkSession, sf: str) -> DataFrame:
    index, _ = X.passage_index(spark, sf)
    asked = X.questions(spark, sf).drop("k_override")
    return hybrid_hits(asked, index, K_HYBRID)


def two_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Fusion of the narrative and the table neighbours of every vector."""
    return reciprocal_rank_fusion(
        _nearest(spark, sf, K_DENSE, "narrative"), _nearest(spark, sf, K_DENSE), K_RERANK
    )


def hybrid(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    hits = hybrid_retriever(index, rows, K_HYBRID)(X.questions(spark, sf))
    header = F.col("extra")["chunk_header"]
    return hits.select("qid", "rank", "id", header.alias("chunk_header"), "text")


def hybrid_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Questions found verbatim in a passage, and how many of those are retrieved."""
    index, rows = X.passage_index(spark, sf)
    asked = X.questions(spark, sf).drop("k_override")
    hits = hybrid_retriever(index, rows, K_HYBRID)(asked)
    found = hits.join(asked, "qid").where(F.contains("text", F.col("question")))
    return found.agg(
        F.count_distinct("qid").alias("n_questions"), F.min("rank").alias("best_rank")
    )


def indexed_dense(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    hits = dense_retriever(index, rows, K_DENSE)(X.questions(spark, sf))
    return hits.select("qid", "rank", "id", "hit_score")


def routed_dense(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    asked = X.questions(spark, sf)
    both = union_routes(
        narrative_retriever(index, rows, K_ROUTE)(asked), table_retriever(index, rows, K_ROUTE)(asked)
    )
    return both.select("qid", "rank", "id", F.col("extra")["content_type"].alias("content_type"))


def vector_hits(spark: SparkSession, sf: str, k: int = K_RERANK) -> DataFrame:
    hits = _nearest(spark, sf, k)
    corpus = vector_passages(spark, sf).select("id", "text", "content_type", "meta")
    return hits.join(corpus, "id").select(
        "qid", "rank", "id", "text", F.col("meta").alias("extra"), "content_type"
    )


def detected(spark: SparkSession, sf: str) -> DataFrame:
    """Detected types and weights of vector hits, replaced by the rows' own metadata."""
    found = detect_types(vector_hits(spark, sf).drop("content_type"))
    return found.select(
        "qid", "rank", "id", "content_type", "weight", F.round("numeric_ratio", 6).alias("numeric_ratio")
    )


def reranked(spark: SparkSession, sf: str) -> DataFrame:
    """Fused hits reranked by the share of question terms."""
    index, rows = X.passage_index(spark, sf)
    asked = X.questions(spark, sf).drop("k_override")
    hits = hybrid_retriever(index, rows, K_HYBRID)(asked)
    return rerank_passages(hits, asked, TOP).select("qid", "rank", "id", "score")


def kept_order(spark: SparkSession, sf: str) -> DataFrame:
    """Without a scorer the first passages stay in their order."""
    hits = take_top(vector_hits(spark, sf), K_RERANK)
    asked = vector_questions(spark, sf)
    return rerank_passages(hits, asked, TOP, scorer=None).select("qid", "rank", "id")


def detect_and_rerank(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    source = rows.drop("content_type")
    hits = reranking_retriever(index, source, k=K_RERANK, rerank_top_k=TOP)(X.questions(spark, sf))
    return hits.select("qid", "rank", "id", "score", "content_type", "weight")


def two_route(spark: SparkSession, sf: str) -> DataFrame:
    index, rows = X.passage_index(spark, sf)
    hits = two_route_retriever(index, rows, k=K_ROUTE, rerank_top_k=TOP)(X.questions(spark, sf))
    return hits.select("qid", "rank", "id", "score", "content_type", "weight")


def route_union(spark: SparkSession, sf: str) -> DataFrame:
    """Narrative and table neighbours in one list, duplicates kept."""
    corpus = vector_passages(spark, sf).select("id", "text", F.col("meta").alias("extra"))
    left = tag_route(narrative(spark, sf).join(corpus, "id"), "narrative", 0.6)
    right = tag_route(dense(spark, sf).join(corpus, "id"), "table", 0.4)
    return union_routes(left, right).select("qid", "rank", "id", "content_type", "weight")


def approximate(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours from the nearest cells, with as many probes as nine of ten neighbours need."""
    return search_cells(vector_questions(spark, sf), X.cell_index(spark, sf, K_DENSE), K_DENSE)


def all_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell is probed and every code scored again: the exact neighbours."""
    index = X.cell_index(spark, sf, K_DENSE)
    questions = vector_questions(spark, sf).where("qid % 10 = 0")
    return search_cells(questions, index, K_DENSE, n_probes=len(index.centres), rerank=1 << 20)


QUERIES = {
    "dense_topk": dense,
    "narrative_topk": narrative,
    "table_topk": tables,
    "bm25_topk": keyword,
    "bm25_indexed": keyword_indexed,
    "bm25_postings": keyword_postings,
    "rrf_fusion": fusion,
    "rrf_two_lists": two_lists,
    "hybrid_topk": hybrid,
    "hybrid_recall": hybrid_recall,
    "hash_dense_topk": indexed_dense,
    "routed_dense_topk": routed_dense,
    "detected_metadata": detected,
    "rerank_topk": reranked,
    "rerank_fallback": kept_order,
    "detect_and_rerank": detect_and_rerank,
    "two_route_rerank": two_route,
    "route_union": route_union,
    "ann_topk": approximate,
    "ann_all_cells": all_cells,
}

_V = """corpus AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v, label, 'passage ' || vec_id AS text,
    CASE WHEN label = 5 THEN NULL WHEN label IN (0, 3, 6, 9) THEN 'table' ELSE 'narrative' END AS content_type
  FROM embeddings),
pairs AS (
  SELECT q.id AS qid, p.id, p.label, p.text, p.content_type,
    round(list_dot_product(q.v, p.v), 6) + 0.0 AS score FROM corpus q, corpus p)"""


def _nearest_sql(name: str, k: int, kind: str | None = None) -> str:
    source = "pairs" if kind is None else f"(SELECT * FROM pairs WHERE content_type = '{kind}')"
    return X.ranked_sql(name, source, k)


def term_share_sql(question: str, text: str) -> str:
    asked, found = X.tokens_sql(question), X.tokens_sql(text)
    return (
        f"round(len(list_intersect(list_distinct({asked}), {found}))::DOUBLE"
        f" / len(list_distinct({asked})), 6)"
    )


def reranked_sql(name: str, source: str, top: int) -> str:
    """``source(qid, rank, id, content, question, ...)`` reranked by term share."""
    return f"""{name} AS (SELECT * REPLACE (rank2 AS rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rank) AS rank2
  FROM (SELECT *, {term_share_sql('question', 'content')} AS score FROM {source})) WHERE rank2 <= {top})"""


DENSE_PASSAGES = f"""{X.PASSAGES_SQL},
{X.DENSE_SQL}"""


def two_route_sql(k: int = K_ROUTE, top: int = TOP) -> str:
    return f"""{DENSE_PASSAGES},
typed AS (SELECT d.*, content, content_type, question FROM dense d JOIN passages USING (id) JOIN questions USING (qid)),
{X.ranked_sql('nar', "(SELECT * FROM typed WHERE content_type = 'narrative')", k)},
{X.ranked_sql('tab', "(SELECT * FROM typed WHERE content_type = 'table')", k)},
routes AS (SELECT qid, id, content, content_type, question,
    row_number() OVER (PARTITION BY qid ORDER BY route, r, id) AS rank
  FROM (SELECT *, 0 AS route, rank AS r FROM nar UNION ALL SELECT *, 1, rank FROM tab)),
{reranked_sql('picked', 'routes', top)}"""


def detect_sql(k: int = K_RERANK, top: int = TOP) -> str:
    return f"""{DENSE_PASSAGES},
{X.ranked_sql('near', 'dense', k)},
found AS (SELECT n.qid, n.rank, n.id, content, content_type, question
  FROM near n JOIN passages USING (id) JOIN questions USING (qid)),
{reranked_sql('picked', 'found', top)}"""


_BM25_PASSAGES = f"""WITH {X.PASSAGES_SQL}, {X.BM25_SQL}, {X.ranked_sql('top', 'bm25', K_HYBRID)}
SELECT qid, id, score, rank FROM top"""
_WEIGHTED = "CASE WHEN content_type = 'table' THEN {t}::DOUBLE ELSE {n}::DOUBLE END AS weight"

ORACLES = {
    "dense_topk": f"WITH {_V}, {_nearest_sql('top', K_DENSE)} SELECT qid, id, score, rank FROM top",
    "ann_all_cells": f"WITH {_V}, {_nearest_sql('top', K_DENSE)} SELECT qid, id, score, rank FROM top WHERE qid % 10 = 0",
    "narrative_topk": f"WITH {_V}, {_nearest_sql('top', K_ROUTE, 'narrative')} SELECT qid, id, score, rank FROM top",
    "table_topk": f"WITH {_V}, {_nearest_sql('top', K_ROUTE, 'table')} SELECT qid, id, score, rank FROM top",
    "bm25_topk": f"""WITH passages AS (SELECT doc_id AS id, text AS content FROM documents),
questions AS (SELECT item_id AS qid, text AS question FROM benchmark),
{X.BM25_SQL}, {X.ranked_sql('top', 'bm25', TOP)} SELECT qid, id, score, rank FROM top""",
    "bm25_indexed": _BM25_PASSAGES,
    "bm25_postings": _BM25_PASSAGES,
    "rrf_fusion": f"WITH {X.hybrid_sql(K_HYBRID)} SELECT qid, id, score, rank FROM fused_top",
    "rrf_two_lists": f"""WITH {_V}, {_nearest_sql('a', K_DENSE, 'narrative')}, {_nearest_sql('b', K_DENSE)},
fused AS (SELECT qid, id, round(sum(part), 6)::DOUBLE AS score FROM (
    SELECT qid, id, (1.0::DOUBLE / (60 + rank))::DECIMAL(20,12) AS part FROM a
    UNION ALL SELECT qid, id, (1.0::DOUBLE / (60 + rank))::DECIMAL(20,12) FROM b) GROUP BY qid, id),
{X.ranked_sql('top', 'fused', K_RERANK)} SELECT qid, id, score, rank FROM top""",
    "hybrid_topk": f"""WITH {X.hybrid_sql(K_HYBRID, own=True)}
SELECT h.qid, h.rank, h.id, chunk_header, content AS text FROM hits h JOIN passages USING (id)""",
    "hybrid_recall": f"""WITH {X.hybrid_sql(K_HYBRID)}
SELECT count(DISTINCT qid) AS n_questions, min(rank)::INTEGER AS best_rank
FROM fused_top JOIN passages USING (id) JOIN questions USING (qid) WHERE contains(content, question)""",
    "hash_dense_topk": f"""WITH {DENSE_PASSAGES}, {X.ranked_sql('top', 'dense', K_DENSE)}
SELECT qid, rank, id, score AS hit_score FROM top""",
    "routed_dense_topk": f"WITH {two_route_sql()} SELECT qid, rank, id, content_type FROM routes",
    "detected_metadata": f"""WITH {_V}, {_nearest_sql('top', K_RERANK)},
typed AS (SELECT *, {X.ratio_sql('text')} AS ratio, {X.table_like_sql('text')} AS tab FROM top)
SELECT qid, rank, id, CASE WHEN tab THEN 'table' ELSE 'narrative' END AS content_type,
  CASE WHEN label = 2 THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS weight,
  CASE WHEN label > 4 THEN 0.25::DOUBLE ELSE round(ratio, 6) END AS numeric_ratio FROM typed""",
    "rerank_topk": f"""WITH {X.hybrid_sql(K_HYBRID)},
found AS (SELECT f.qid, f.rank, f.id, content, question FROM fused_top f JOIN passages USING (id) JOIN questions USING (qid)),
{reranked_sql('picked', 'found', TOP)} SELECT qid, rank, id, score FROM picked""",
    "rerank_fallback": f"WITH {_V}, {_nearest_sql('top', TOP)} SELECT qid, rank, id FROM top",
    "detect_and_rerank": f"""WITH {detect_sql()}
SELECT qid, rank, id, score, content_type, 0.5::DOUBLE AS weight FROM picked""",
    "two_route_rerank": f"""WITH {two_route_sql()}
SELECT qid, rank, id, score, content_type, {_WEIGHTED.format(t=0.4, n=0.6)} FROM picked""",
    "route_union": f"""WITH {_V}, {_nearest_sql('a', K_ROUTE, 'narrative')}, {_nearest_sql('b', K_DENSE)}
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY route, rank, id) AS rank, id, content_type,
  CASE WHEN label = 2 THEN 0.9::DOUBLE WHEN route = 0 THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS weight
FROM (SELECT qid, id, rank, label, 0 AS route, 'narrative' AS content_type FROM a
      UNION ALL SELECT qid, id, rank, label, 1, 'table' FROM b)""",
}
