"""Fusing ranked lists, and the hybrid of keyword and dense ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RRF_CONSTANT = 60


def take_top(ranked: DataFrame, k: int | Column, rank: str = "rank") -> DataFrame:
    """Rows of a ranked list up to ``k``, a number or a column."""
    return ranked.where(F.col(rank) <= k)


def reciprocal_rank_fusion(
    first: DataFrame, second: DataFrame, k: int, constant: int = RRF_CONSTANT
) -> DataFrame:
    """``qid, id, score, rank`` from two ranked lists by the sum of 1/(constant + rank).

    Both lists already hold a few rows per question, so the union and the sum
    move little data.
    """
    both = first.select("qid", "id", "rank").unionByName(second.select("qid", "id", "rank"))
    share = (F.lit(1.0) / (constant + F.col("rank"))).cast("decimal(20,12)")
    order = W.partitionBy("qid").orderBy(F.desc("score"), "id")
    return (
        both.groupBy("qid", "id")
        .agg(F.round(F.sum(share), 6).cast("double").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def apply_k_override(ranked: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Cut each question's list at its ``k_override``, or at ``k`` where that is null.

    The list must have been ranked to the largest override.
    """
    if "k_override" not in questions.columns:
        return take_top(ranked, k)
    limits = questions.select("qid", F.coalesce("k_override", F.lit(k)).alias("_k"))
    return take_top(ranked.join(limits, "qid"), F.col("_k")).drop("_k")


def largest_k(questions: DataFrame, k: int) -> int:
    """The most rows any question asks for."""
    if "k_override" not in questions.columns:
        return k
    asked = questions.agg(F.max(F.coalesce("k_override", F.lit(k)))).first()[0]
    return max(int(asked or 0), 1)
