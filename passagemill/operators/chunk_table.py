"""The chunk table: ids, token counts, item numbers, pages, header and content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contextualize, join_headings, token_count, trailing_number
from ..session import materialize
from .scan import number_rows

CHUNK_COLUMNS = (
    "id",
    "num_tokens",
    "table_ids",
    "text_ids",
    "page_numbers",
    "chunk_header",
    "content",
    "doc_id",
    "chunk_no",
)


def item_numbers(items: Column | str, label: str) -> Column:
    """Trailing numbers of the references of items with this label, in order."""
    chosen = F.filter(items, lambda x: x["label"] == label)
    return F.transform(chosen, lambda x: trailing_number(x["self_ref"]))


def item_pages(items: Column | str) -> Column:
    """Distinct page numbers, ascending; items without a page are left out."""
    pages = F.transform(items, lambda x: x["page_no"].cast("bigint"))
    return F.sort_array(F.array_distinct(F.filter(pages, lambda p: p.isNotNull())))


def chunk_table(chunks: DataFrame) -> DataFrame:
    """Chunk rows from ``doc_id, pos, headings, text, items``.

    ``id`` is dense from 0 over all documents, ``chunk_no`` within a document.
    """
    content = contextualize("headings", "text")
    tie = "first_no" if "first_no" in chunks.columns else "pos"
    rows = chunks.select(
        "doc_id",
        "pos",
        F.col(tie).alias("tie"),
        token_count(content).alias("num_tokens"),
        item_numbers("items", "TABLE").alias("table_ids"),
        item_numbers("items", "TEXT").alias("text_ids"),
        item_pages("items").alias("page_numbers"),
        join_headings("headings").alias("chunk_header"),
        content.alias("content"),
    )
    # Numbering counts the rows before it numbers them: written once, read twice.
    rows = materialize(rows, "chunk-rows")
    numbered = number_rows(rows, "doc_id", "pos", global_id="id", tie="tie")
    return numbered.select(*CHUNK_COLUMNS)
