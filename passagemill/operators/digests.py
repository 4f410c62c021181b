"""Digest trees: find the key ranges in which two versions of a table differ.

Keys are dealt to leaves by hash. A leaf holds the number of its rows and two exact
sums of their digests, which do not depend on the order of rows; a node above
holds the sums of ``FANOUT`` children. Two trees are compared from the top, and
only children of nodes that differ are looked at. So versions that are equal cost
one pass over their rows, in which nothing but one row per leaf and task is
shuffled, or no pass at all where the tree of a version is kept beside it; where
they differ, rows of differing leaves alone are joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from .mutation import change_feed

#: Children of a node, and rows a leaf is meant to hold.
FANOUT = 16
LEAF_ROWS = 4096


def leaves_for(rows: int) -> int:
    """A power of ``FANOUT`` that gives leaves of about ``LEAF_ROWS`` rows."""
    wanted = max(1.0, rows / LEAF_ROWS)
    return FANOUT ** math.ceil(round(math.log(wanted, FANOUT), 9))


def leaf_of(key: Sequence[str], leaves: int) -> Column:
    """The leaf of a row; keys of one value meet whatever their integer type."""
    texts = [F.col(k).cast("string") for k in key]
    return F.pmod(F.xxhash64(*texts), F.lit(leaves)).cast("bigint")


def _digest_parts(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 60-bit numbers of the digest of some columns; null and empty text differ."""
    digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")

    return part(1), part(16)


def digest_tree(rows: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, leaves: int | None = None) -> DataFrame:
    """``height, node, n, a, b`` of a table, height 0 being the leaves; stored.

    ``columns`` (all by default) are what a difference is looked for in. Trees can be
    compared if they have equally many leaves.
    """
    leaves = leaves or leaves_for(rows.count())
    a, b = _digest_parts(list(dict.fromkeys([*key, *(columns or rows.columns)])))
    level = materialize(
        rows.select(leaf_of(key, leaves).alias("node"), a.alias("a"), b.alias("b"))
        .groupBy("node").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")),
        "leaves",
    )
    tree, height = None, 0
    while True:
        shown = level.select(F.lit(height).alias("height"), "node", "n", *[F.col(c).cast("decimal(38,0)").alias(c) for c in "ab"])
        tree = shown if tree is None else tree.unionByName(shown)
        if FANOUT**height >= leaves:
            return materialize(tree, "tree")
        level = level.groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")])
        height += 1


def tree_leaves(tree: DataFrame) -> int:
    return FANOUT ** tree.agg(F.max("height")).first()[0]


def _level(tree: DataFrame, height: int, parents: DataFrame | None) -> DataFrame:
    """Nodes of a height, of given parents only."""
    nodes = tree.where(F.col("height") == height).drop("height")
    if parents is None:
        return nodes
    parent = F.floor(F.col("node") / FANOUT)
    return nodes.withColumn("up", parent).join(parents.withColumnRenamed("node", "up"), "up", "left_semi").drop("up")


def differing_leaves(old: DataFrame, new: DataFrame) -> DataFrame:
    """``node``: leaves in which two trees differ, found from the top downwards."""
    tops = [t.agg(F.max("height")).first()[0] for t in (old, new)]
    known = [h for h in tops if h is not None]
    if len(set(known)) > 1:
        raise ValueError("the trees have different numbers of leaves")
    parents = None
    for height in range(max(known, default=0), -1, -1):
        left = _level(old, height, parents).select("node", F.struct("n", "a", "b").alias("old"))
        right = _level(new, height, parents).select("node", F.struct("n", "a", "b").alias("new"))
        differ = left.join(right, "node", "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select("node")
        parents = materialize(differ, "nodes")
        if parents.isEmpty():
            return parents if height == 0 else parents.limit(0)
        parents = broadcast_if_small(parents)
    return parents


def in_leaves(rows: DataFrame, key: Sequence[str], nodes: DataFrame, leaves: int) -> DataFrame:
    """Rows whose key lies in one of the leaves."""
    return rows.withColumn("node", leaf_of(key, leaves)).join(nodes, "node", "left_semi").drop("node")


def change_feed_by_tree(
    old: DataFrame, new: DataFrame, key: Sequence[str], *, old_tree: DataFrame | None = None, new_tree: DataFrame | None = None
) -> DataFrame:
    """The rows of ``change_feed``; only rows of differing leaves are joined.

    Trees that were stored with a version spare the pass over it. They must have been
    made over all columns. Both versions have the same columns.
    """
    columns = new.columns
    kept = old_tree if old_tree is not None else new_tree
    leaves = tree_leaves(kept) if kept is not None and not kept.isEmpty() else leaves_for(new.count())
    old_tree = old_tree if old_tree is not None else digest_tree(old, key, columns, leaves)
    new_tree = new_tree if new_tree is not None else digest_tree(new, key, columns, leaves)
    nodes = differing_leaves(old_tree, new_tree)
    if nodes.isEmpty():
        return change_feed(old.limit(0), new.limit(0), key)
    return change_feed(in_leaves(old.select(*columns), key, nodes, leaves), in_leaves(new, key, nodes, leaves), key)
