"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the links (a, b): the smallest id it reaches.

    Each round hooks every id to its smallest neighbour, follows the hooks to
    their ends by doubling, and goes on with the links between the ends. Ids
    without links are not listed. Every step is a written table.
    """
    between = materialize(_between(links.select("a", "b")), "links")
    ids = materialize(between.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "ids")
    while not between.isEmpty():
        hooks = materialize(between.groupBy(F.col("b").alias("k")).agg(F.min("a").alias("v")), "hooks")
        moved = True
        while moved:
            ends = hooks.select(F.col("k").alias("_k"), F.col("v").alias("_v"))
            step = hooks.join(ends, hooks["v"] == ends["_k"], "left")
            step = materialize(step.select("k", F.coalesce("_v", "v").alias("v"), F.col("_v").isNotNull().alias("moved")), "hooks")
            moved, hooks = not step.filter("moved").isEmpty(), step.drop("moved")
        ids = materialize(_follow(ids, "component", hooks), "ids")
        between = materialize(_between(_follow(_follow(between, "a", hooks), "b", hooks)), "links")
    return ids


def _between(links: DataFrame) -> DataFrame:
    return links.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _follow(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    joined = df.join(hooks, df[column] == hooks["k"], "left")
    return joined.withColumn(column, F.coalesce("v", column)).drop("k", "v")
