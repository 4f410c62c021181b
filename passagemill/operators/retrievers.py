"""Retrievers: configured once, then applied to a whole table of questions.

Each factory returns a function from ``questions(qid, question[, embedding,
k_override])`` to ranked passages. ``source`` is the passage table with ``id``,
the text column and, where present, ``content_type`` and a ``meta`` map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import hash_embedding
from .dense import dense_topk
from .fusion import apply_k_override, largest_k, reciprocal_rank_fusion
from .index import Index
from .keyword import bm25_topk
from .rerank import (
    Scorer,
    attach_passages,
    detect_types,
    plain_passages,
    rerank_passages,
    tag_route,
    term_share,
    union_routes,
)

Retriever = Callable[[DataFrame], DataFrame]
Embedder = Callable[[Column], Column]
HIT_COLUMNS = ("qid", "rank", "id", "text", "hit_score", "extra")


def _embedded(questions: DataFrame, dim: int, embed: Embedder | None) -> DataFrame:
    if "embedding" in questions.columns:
        return questions
    make = embed or (lambda t: hash_embedding(t, dim))
    return questions.withColumn("embedding", make(F.col("question")))


def _passages(hits: DataFrame, source: DataFrame, text: str) -> DataFrame:
    """Hits with text and metadata, fetched after ranking."""
    own = [c for c in ("meta", "content_type", "chunk_header") if c in source.columns]
    joined = attach_passages(hits.withColumnRenamed("score", "hit_score"), source, text, *own)
    known = [
        F.map_from_entries(
            F.filter(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                        for c in own
                        if c != "meta"
                    ]
                ),
                lambda e: e["value"].isNotNull(),
            )
        )
        if any(c != "meta" for c in own)
        else F.create_map().cast("map<string,string>")
    ]
    extra = known[0]
    if "meta" in own:
        fixed = F.map_filter(extra, lambda k, _v: ~F.coalesce(F.map_contains_key("meta", k), F.lit(False)))
        extra = F.map_concat(fixed, F.coalesce("meta", F.create_map().cast("map<string,string>")))
    return joined.select(
        "qid", "rank", "id", F.col(text).alias("text"), "hit_score", extra.alias("extra")
    )


def dense_retriever(
    index: Index,
    source: DataFrame,
    k: int = 12,
    *,
    text: str = "content",
    content_type: str | None = None,
    embed: Embedder | None = None,
) -> Retriever:
    """The k nearest passages; ``content_type`` restricts the rows before ranking."""

    def retrieve(questions: DataFrame) -> DataFrame:
        vectors = index.vectors(questions.sparkSession)
        if content_type is not None:
            vectors = vectors.where(F.col("content_type") == content_type)
        hits = dense_topk(_embedded(questions, index.dim, embed), vectors, k, dim=index.dim)
        return _passages(hits, source, text)

    return retrieve


def narrative_retriever(index: Index, source: DataFrame, k: int = 3, **options) -> Retriever:
    return dense_retriever(index, source, k, content_type="narrative", **options)


def table_retriever(index: Index, source: DataFrame, k: int = 3, **options) -> Retriever:
    return dense_retriever(index, source, k, content_type="table", **options)


def hybrid_hits(
    questions: DataFrame, index: Index, k: int, *, embed: Embedder | None = None
) -> DataFrame:
    """``qid, id, score, rank``: keyword and dense ranking fused, cut at each question's k.

    Both lists are cut at the question's own k before they are fused, so the other
    questions of a batch change nothing.
    """
    spark = questions.sparkSession
    depth = largest_k(questions, k)
    keyword = bm25_topk(
        questions, index.postings(spark), depth, index.terms(spark)
    )
    dense = dense_topk(
        _embedded(questions, index.dim, embed), index.vectors(spark), depth, dim=index.dim
    )
    own = [apply_k_override(ranked, questions, k) for ranked in (keyword, dense)]
    return apply_k_override(reciprocal_rank_fusion(*own, depth), questions, k)


def hybrid_retriever(
    index: Index,
    source: DataFrame,
    k: int = 15,
    *,
    text: str = "content",
    embed: Embedder | None = None,
) -> Retriever:
    """Keyword and dense ranking fused; a question's ``k_override`` replaces ``k``."""

    def retrieve(questions: DataFrame) -> DataFrame:
        hits = hybrid_hits(questions, index, k, embed=embed)
        return plain_passages(_passages(hits, source, text))

    return retrieve


def reranking_retriever(
    index: Index,
    source: DataFrame,
    *,
    narrative_weight: float = 0.5,
    table_weight: float = 0.5,
    k: int = 6,
    rerank_top_k: int = 5,
    text: str = "content",
    scorer: Scorer | None = term_share,
    use_weights: bool = False,
    embed: Embedder | None = None,
) -> Retriever:
    """Dense retrieval, type detection, reranking."""
    base = dense_retriever(index, source, k, text=text, embed=embed)

    def retrieve(questions: DataFrame) -> DataFrame:
        found = detect_types(base(questions), narrative_weight, table_weight)
        return rerank_passages(
            found, questions, rerank_top_k, scorer=scorer, use_weights=use_weights
        )

    return retrieve


def two_route_retriever(
    index: Index,
    source: DataFrame,
    *,
    narrative_weight: float = 0.6,
    table_weight: float = 0.4,
    k: int = 3,
    rerank_top_k: int = 5,
    text: str = "content",
    scorer: Scorer | None = term_share,
    use_weights: bool = False,
    compute_ratio: bool = False,
    embed: Embedder | None = None,
) -> Retriever:
    """k narrative and k table passages, tagged by route, reranked together."""
    narrative = narrative_retriever(index, source, k, text=text, embed=embed)
    table = table_retriever(index, source, k, text=text, embed=embed)

    def retrieve(questions: DataFrame) -> DataFrame:
        both = union_routes(
            tag_route(
                narrative(questions), "narrative", narrative_weight, compute_ratio=compute_ratio
            ),
            tag_route(table(questions), "table", table_weight, compute_ratio=compute_ratio),
        )
        return rerank_passages(
            both, questions, rerank_top_k, scorer=scorer, use_weights=use_weights
        )

    return retrieve
