"""From elements to the stored chunk table with its embedding columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import CHANGE_FEED, run_stage, set_table_property
from .chunk_table import chunk_table
from .headings import hierarchical_chunks
from .hybrid import MAX_TOKENS, hybrid_chunks, with_items

Embedder = Callable[[Column], Column]


def embed_chunks(chunks: DataFrame, embedders: Mapping[str, Embedder]) -> DataFrame:
    """Add one vector column per embedder, all in the same pass.

    An embedder made with ``functions.batched`` also gives ``<name>_ok``: a
    failed slice holds zero vectors and is told apart by it.
    """
    made = chunks.select("*", *[e(F.col("content")).alias(f"_{n}") for n, e in embedders.items()])
    columns = [F.col(c) for c in chunks.columns]
    for name in embedders:
        if isinstance(made.schema[f"_{name}"].dataType, T.StructType):
            columns += [F.col(f"_{name}.value").alias(name), F.col(f"_{name}.ok").alias(f"{name}_ok")]
        else:
            columns.append(F.col(f"_{name}").alias(name))
    return made.select(*columns)


def store_chunks(
    elements: DataFrame,
    table: str,
    embedders: Mapping[str, Embedder],
    *,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Chunk, embed and save; an existing table is returned without any work."""
    spark = elements.sparkSession

    def build() -> DataFrame:
        chunks = hybrid_chunks(with_items(hierarchical_chunks(elements)), max_tokens)
        return embed_chunks(chunk_table(chunks), embedders)

    stored = run_stage(spark, table, build)
    set_table_property(spark, table, CHANGE_FEED, "true")
    return stored
