"""Search index of a passage table: one entry per passage, and term frequencies.

An entry holds the vector, the token count and the distinct terms of a passage;
a search reads only the columns it needs, scores entries where they lie and
shuffles the best k per question and task. Both tables are swapped in whole when
the index is rebuilt or synced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..functions.vectors import has_dimension, hashed_words
from ..session import broadcast_if_small, materialize
from ..sources.tables import swap_table
from .digests import differing_leaves, digest_tree, in_leaves, tree_leaves
from .keyword import document_frequencies, index_columns

Embedder = Callable[[Column], Column]


#: Source columns copied beside the vectors, so that a search can filter on them
#: in the scan instead of joining the source.
KEPT = ("content_type",)


@dataclass(frozen=True)
class Provider:
    """Where an index takes its vectors from, and how large they are."""

    dim: int
    vector_column: str | None = None
    text_column: str = "content"


#: Embedding providers by name; more are given to ``provider`` as ``known``.
PROVIDERS = {
    "model_endpoint": Provider(1024, "embedding"),
    "hash": Provider(256),
}


def provider(name: str, known: dict[str, Provider] | None = None) -> Provider:
    known = PROVIDERS if known is None else known
    if name not in known:
        raise ValueError(f"unknown embedding provider: {name}")
    return known[name]


def split_by_dimension(df: DataFrame, vector: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector has the dimension, and the others."""
    fits = has_dimension(vector, dim)
    return df.where(fits), df.where(~fits)


@dataclass(frozen=True)
class Index:
    """Handle of a built index; ``dim`` is the vector dimension."""

    name: str
    dim: int

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(f"{self.name}_entries")

    def vectors(self, spark: SparkSession) -> DataFrame:
        return self.entries(spark).drop("dl", "terms")

    def postings(self, spark: SparkSession) -> DataFrame:
        return self.entries(spark).select("id", "dl", "terms")

    def terms(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(f"{self.name}_terms")

    def tree(self, spark: SparkSession) -> DataFrame:
        """Digest tree of the entries' ids and fingerprints; made anew where it is not stored."""
        name = f"{self.name}_tree"
        if spark.catalog.tableExists(name):
            return spark.read.table(name)
        tree = digest_tree(self.entries(spark).select("id", "fp"), ["id"])
        swap_table(tree.coalesce(1), name)
        return spark.read.table(name)

    def exists(self, spark: SparkSession) -> bool:
        return all(
            spark.catalog.tableExists(f"{self.name}_{part}") for part in ("entries", "terms")
        )


def _fingerprint(columns: list[str]) -> Column:
    """Digest of the indexed columns, nulls kept apart from empty strings."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _indexed_columns(rows: DataFrame, text: str, vector: str | None) -> list[str]:
    """The columns an index depends on; a change in any of them changes the entry."""
    kept = [c for c in KEPT if c in rows.columns]
    return [text, *([vector] if vector else []), *kept]


def index_entries(
    rows: DataFrame, index: Index, text: str = "content", vector: str | None = None, embed: Embedder | None = None
) -> DataFrame:
    """``id, fp, embedding, ok, dl, terms`` and the kept columns of each row.

    A vector of another dimension, or one without any weight, is not ``ok`` and
    stays out of dense search.
    """
    inputs = _indexed_columns(rows, text, vector)
    kept = [c for c in KEPT if c in rows.columns]
    ok = has_dimension("embedding", index.dim) & F.exists("embedding", lambda x: x != 0)
    given = [F.col(vector)] if vector else [embed(F.col(text))] if embed else []
    made = rows.select(
        "id",
        _fingerprint(inputs).alias("fp"),
        *[value.cast("array<float>").alias("embedding") for value in given],
        *kept,
        tokens(F.col(text)).alias("w"),
    )
    if not given:  # the built-in embedding takes the tokens, which are found once
        made = made.withColumn("embedding", hashed_words("w", index.dim))
    return made.select(
        "id",
        "fp",
        *kept,
        "embedding",
        F.coalesce(ok, F.lit(False)).alias("ok"),
        *index_columns("w"),
    )


def build_index(
    rows: DataFrame,
    index: Index,
    *,
    text: str = "content",
    vector: str | None = None,
    embed: Embedder | None = None,
    force_rebuild: bool = True,
) -> bool:
    """Build the index of ``rows(id, text[, vector])`` anew; tells whether it exists.

    Vectors come from the stored column ``vector``, or from the text through
    ``embed`` (by default the hashed words). With ``force_rebuild=False`` nothing
    is ever created.
    """
    spark = rows.sparkSession
    if not force_rebuild:
        return index.exists(spark)
    spark.sql(f"DROP TABLE IF EXISTS {index.name}_tree")
    swap_table(index_entries(rows, index, text, vector, embed), f"{index.name}_entries")
    swap_table(document_frequencies(index.postings(spark)), f"{index.name}_terms")
    return True


def sync_index(
    rows: DataFrame,
    index: Index,
    *,
    text: str = "content",
    vector: str | None = None,
    embed: Embedder | None = None,
) -> dict[str, int]:
    """Bring an index up to date with its source; returns counts of changes.

    Source and index are compared by the trees of their ids and digests; rows are
    joined in differing leaves only, so an unchanged source costs one pass over it.
    Only new and changed rows are embedded and tokenised again; the result equals a
    rebuild.
    """
    spark = rows.sparkSession
    inputs = _indexed_columns(rows, text, vector)
    prints = rows.select("id", _fingerprint(inputs).alias("fp"))
    kept = index.tree(spark)
    leaves = 1 if kept.isEmpty() else tree_leaves(kept)
    tree = digest_tree(prints, ["id"], leaves=leaves)
    nodes = differing_leaves(kept, tree)
    if nodes.isEmpty():
        return {"inserted": 0, "deleted": 0, "updated": 0}
    source = in_leaves(prints, ["id"], nodes, leaves)
    held = in_leaves(index.vectors(spark).select("id", F.col("fp").alias("old")), ["id"], nodes, leaves)
    state = source.join(held, "id", "full_outer").where(~F.col("fp").eqNullSafe(F.col("old")))
    changes = materialize(
        state.select("id", F.col("fp").isNull().alias("gone"), F.col("old").isNull().alias("new")),
        "changes",
    )
    counts = changes.agg(
        F.count_if("new").alias("inserted"),
        F.count_if("gone").alias("deleted"),
        F.count_if(~F.col("new") & ~F.col("gone")).alias("updated"),
    ).first()
    if sum(counts) == 0:
        return counts.asDict()
    changed = broadcast_if_small(changes.where(~F.col("gone")).select("id"))
    fresh = materialize(
        index_entries(rows.join(changed, "id", "left_semi"), index, text, vector, embed), "entries"
    )
    touched = broadcast_if_small(changes.select("id"))
    removed = document_frequencies(index.postings(spark).join(touched, "id", "left_semi"))
    terms = (
        index.terms(spark)
        .unionByName(removed.select("term", (-F.col("df")).alias("df")))
        .unionByName(document_frequencies(fresh))
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
        .where(F.col("df") > 0)
    )
    # A tree must never be older than the entries: it is dropped before they change.
    spark.sql(f"DROP TABLE IF EXISTS {index.name}_tree")
    # Terms first: their removals are counted from the entries still in place.
    swap_table(terms, f"{index.name}_terms")
    kept = index.entries(spark).join(touched, "id", "left_anti")
    swap_table(kept.unionByName(fresh), f"{index.name}_entries")
    swap_table(tree.coalesce(1), f"{index.name}_tree")
    return counts.asDict()


def create_or_sync_index(
    spark: SparkSession,
    source_table: str,
    index: Index,
    valid_tables: list[str],
    **options,
) -> bool:
    """Create a missing index or sync it; a source not in ``valid_tables`` is skipped."""
    if source_table.split(".")[-1] not in valid_tables:
        return False
    rows = spark.read.table(source_table)
    if index.exists(spark):
        sync_index(rows, index, **options)
    else:
        build_index(rows, index, **options)
    return True

