"""Passages: metadata, detected types, routes and reranking.

A passage row has ``qid, rank, id, text, score, content_type, weight,
numeric_ratio, detected_type, extra``; ``extra`` is the row's own metadata map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import detected_type, numeric_ratio, tokens, type_weight
from ..session import broadcast_if_small, materialize

PASSAGE_COLUMNS = (
    "qid",
    "rank",
    "id",
    "text",
    "score",
    "content_type",
    "weight",
    "numeric_ratio",
    "detected_type",
    "extra",
)
Scorer = Callable[[Column, Column], Column]


def attach_passages(hits: DataFrame, source: DataFrame, *columns: str) -> DataFrame:
    """Source columns joined to ranked hits by ``id``.

    Ranking runs on ids alone; only here do k rows per question meet the text.
    """
    wanted = source.select("id", *columns)
    # k rows per question: ranked once, written, then broadcast behind a size check.
    return wanted.join(broadcast_if_small(materialize(hits, "hits")), "id")


def _meta(name: str, computed: Column, kind: str) -> Column:
    """A metadata value: the row's own entry when it has one, else the computed value."""
    own = F.col("extra")[name]
    typed = own if kind == "string" else own.try_cast(kind)
    return F.coalesce(typed, computed)


def _with_extra(passages: DataFrame) -> DataFrame:
    if "extra" in passages.columns:
        return passages
    return passages.withColumn("extra", F.lit(None).cast("map<string,string>"))


def plain_passages(passages: DataFrame) -> DataFrame:
    """Passages with nothing but the row's own metadata and no score."""
    p = _with_extra(passages)
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    return p.select(
        "qid",
        "rank",
        "id",
        "text",
        none_d.alias("score"),
        _meta("content_type", none_s, "string").alias("content_type"),
        _meta("weight", none_d, "double").alias("weight"),
        _meta("numeric_ratio", none_d, "double").alias("numeric_ratio"),
        _meta("detected_type", none_s, "string").alias("detected_type"),
        "extra",
    )


def detect_types(
    passages: DataFrame, narrative_weight: float = 0.5, table_weight: float = 0.5
) -> DataFrame:
    """Passages with type, weight and numeric ratio detected from their text.

    The row's own metadata comes last and replaces detected values.
    """
    p = _with_extra(passages).withColumn("_ratio", numeric_ratio("text"))
    kind = detected_type("text", F.col("_ratio"))
    return p.withColumn("_kind", kind).select(
        "qid",
        "rank",
        "id",
        "text",
        F.lit(None).cast("double").alias("score"),
        _meta("content_type", F.col("_kind"), "string").alias("content_type"),
        _meta("weight", type_weight("_kind", narrative_weight, table_weight), "double").alias(
            "weight"
        ),
        _meta("numeric_ratio", F.col("_ratio"), "double").alias("numeric_ratio"),
        _meta("detected_type", F.col("_kind"), "string").alias("detected_type"),
        "extra",
    )


def tag_route(
    passages: DataFrame, route: str, weight: float, *, compute_ratio: bool = False
) -> DataFrame:
    """Passages of one route: its type and weight, unless the row brings its own."""
    p = _with_extra(passages)
    ratio = numeric_ratio("text") if compute_ratio else F.lit(None).cast("double")
    return p.select(
        "qid",
        "rank",
        "id",
        "text",
        F.lit(None).cast("double").alias("score"),
        _meta("content_type", F.lit(route), "string").alias("content_type"),
        _meta("weight", F.lit(float(weight)), "double").alias("weight"),
        _meta("numeric_ratio", ratio, "double").alias("numeric_ratio"),
        _meta("detected_type", F.lit(None).cast("string"), "string").alias("detected_type"),
        "extra",
    )


def union_routes(narrative: DataFrame, table: DataFrame) -> DataFrame:
    """Both routes in one list, narrative first; a passage found twice stays twice."""
    both = narrative.withColumn("_route", F.lit(0)).unionByName(table.withColumn("_route", F.lit(1)))
    order = W.partitionBy("qid").orderBy("_route", "rank", "id")
    return both.withColumn("rank", F.row_number().over(order)).drop("_route")


def term_share(question: Column, text: Column) -> Column:
    """Built-in scorer: share of the question's distinct terms found in the text."""
    asked = F.array_distinct(tokens(question))
    found = F.size(F.array_intersect(asked, tokens(text)))
    return F.when(F.size(asked) > 0, F.round(found / F.size(asked), 6)).otherwise(F.lit(0.0))


def rerank_passages(
    passages: DataFrame,
    questions: DataFrame,
    top_k: int = 5,
    *,
    scorer: Scorer | None = term_share,
    use_weights: bool = False,
) -> DataFrame:
    """The ``top_k`` best passages per question by score, ties in their old order.

    Without a scorer, or for a question whose scorer failed on any passage, the
    old order stays. A scorer returns a number, or ``struct<value, ok>`` as
    ``functions.batched`` makes it. ``use_weights`` multiplies by the passage
    weight.
    """
    if scorer is None:
        order = W.partitionBy("qid").orderBy("rank")
        cut = passages.withColumn("rank", F.row_number().over(order))
        return cut.where(F.col("rank") <= top_k)
    asked = broadcast_if_small(questions.select("qid", "question"), "question")
    scored = passages.join(asked, "qid").withColumn(
        "_s", scorer(F.col("question"), F.col("text"))
    )
    if isinstance(scored.schema["_s"].dataType, T.StructType):
        every = W.partitionBy("qid")
        scored = scored.withColumn("_ok", F.min("_s.ok").over(every)).withColumn(
            "_s", F.when(F.col("_ok"), F.col("_s.value").cast("double"))
        )
    value = F.col("_s").cast("double")
    if use_weights:
        value = value * F.col("weight")
    order = W.partitionBy("qid").orderBy(F.desc_nulls_last("score"), "_old")
    return (
        scored.withColumn("score", value)
        .withColumn("_old", F.col("rank"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_k)
        .select(*passages.columns)
    )
