"""From ranked passages to context strings, breakdowns and prompts, one row per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import effective_type, fixed_decimals

SEPARATOR = "\n\n"


def plain_part(score: Column | str = "score", text: Column | str = "text") -> Column:
    """``(Relevance: 0.000): text``; a missing score shows as zero."""
    text = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit("(Relevance: "), fixed_decimals(score, 3), F.lit("): "), text)


def typed_part(kind: Column | str = "type") -> Column:
    """``[TYPE] (Relevance: 0.000): text``, tables with their numeric ratio."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    ratio = F.concat(F.lit(" (Numeric: "), fixed_decimals("numeric_ratio", 2), F.lit(")"))
    return F.concat(
        F.lit("["),
        F.upper(kind),
        F.lit("]"),
        F.when(kind == "table", ratio).otherwise(F.lit("")),
        F.lit(" "),
        plain_part(),
    )


def in_rank_order(*values: Column) -> Column:
    """Aggregate: structs of the values of a question's passages in rank order.

    The comparison looks at the rank alone, as maps have no order.
    """
    return F.array_sort(
        F.collect_list(F.struct("rank", *values)),
        lambda a, b: (a["rank"] - b["rank"]).cast("int"),
    )


def source_document() -> Column:
    return F.struct(
        "text",
        "score",
        F.struct("content_type", "weight", "numeric_ratio", "detected_type").alias("meta"),
        "extra",
    )


def context_rows(passages: DataFrame, *, typed: bool = False) -> DataFrame:
    """One row per question: context, sources, types and their counts."""
    p = passages.withColumn("type", effective_type("content_type", "detected_type"))
    part = typed_part() if typed else plain_part()
    rows = p.groupBy("qid").agg(
        in_rank_order("type", part.alias("part"), source_document().alias("doc")).alias("r"),
        F.count_if(F.col("type") == "narrative").cast("int").alias("narrative"),
        F.count_if(F.col("type") == "table").cast("int").alias("table"),
    )
    return rows.select(
        "qid",
        F.array_join("r.part", SEPARATOR).alias("context"),
        F.col("r.doc").alias("source_documents"),
        F.col("r.type").alias("context_types"),
        F.size("r").alias("num_sources"),
        "narrative",
        "table",
        F.element_at("r.doc", 1)["text"].alias("best_text"),
    )
