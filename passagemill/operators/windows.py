"""Overlapping character windows, and routing of tables past the windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import detected_type

CHUNK_SIZE = 1024
CHUNK_OVERLAP = 100
#: Longer texts are cut into step-sized pieces first, so that the cost stays
#: linear; cutting by position walks the text from its start for every window.
_LONG_TEXT = 100_000


def _windows(text: str, chunk_size: int, chunk_overlap: int) -> Column:
    """Array of the windows of a non-empty text."""
    if chunk_size < 1 or chunk_overlap < 0:
        raise ValueError("chunk_size must be positive and chunk_overlap not negative")
    if chunk_overlap >= chunk_size:
        raise ValueError("chunk_overlap must be smaller than chunk_size")
    step = chunk_size - chunk_overlap
    t, n = F.col(text), F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(n - chunk_overlap - 1, F.lit(0)), F.lit(step))
    span = math.ceil(chunk_size / step)
    pieces = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    def from_pieces(cut: Column) -> Column:
        return F.transform(
            starts,
            lambda s: F.substring(
                F.array_join(F.slice(cut, F.floor(s / step).cast("int") + 1, F.lit(span)), ""),
                1,
                chunk_size,
            ),
        )

    return F.when(
        n <= _LONG_TEXT, F.transform(starts, lambda s: F.substring(t, s + 1, F.lit(chunk_size)))
    ).otherwise(F.element_at(F.transform(F.array(pieces), from_pieces), 1))


def char_windows(
    docs: DataFrame,
    chunk_size: int = CHUNK_SIZE,
    chunk_overlap: int = CHUNK_OVERLAP,
    *,
    text: str = "text",
) -> DataFrame:
    """Windows ``[start, start + chunk_size)`` of every text, ``chunk_no`` from 0.

    Consecutive windows share ``chunk_overlap`` characters and the last one ends
    with the text; an empty or missing text gives none. All other columns are
    copied to each window. Runs inside the row: no shuffle.
    """
    windows = _windows(text, chunk_size, chunk_overlap)
    kept = [c for c in docs.columns if c != text]
    return (
        docs.where(F.length(text) > 0)
        .select(*kept, F.posexplode(windows).alias("chunk_no", text))
        .withColumn("start", F.col("chunk_no") * (chunk_size - chunk_overlap))
    )


def routed_chunks(
    docs: DataFrame, chunk_size: int = CHUNK_SIZE, chunk_overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Table-like texts as one whole chunk, all others cut into windows.

    One pass: the type is found once per text and decides how it is cut.
    """
    cut = F.when(F.col("content_type") == "table", F.array("text")).otherwise(
        _windows("text", chunk_size, chunk_overlap)
    )
    kept = [c for c in docs.columns if c != "text"]
    return (
        docs.where(F.length("text") > 0)
        .withColumn("content_type", detected_type("text"))
        .select(*kept, "content_type", F.posexplode(cut).alias("chunk_no", "text"))
        .withColumn("start", F.col("chunk_no") * (chunk_size - chunk_overlap))
    )
