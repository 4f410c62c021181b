"""Registered queries: windows, heading scopes, structured and hybrid chunks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import token_count
from ..functions.vectors import hash_embedding, vector_norm
from ..operators.boundaries import split_at_boundaries
from ..operators.chunk_table import chunk_table, item_pages
from ..operators.headings import heading_scopes, hierarchical_chunks
from ..operators.hybrid import hybrid_chunks, merge_peers, split_long_chunks, with_items
from ..operators.ingest import store_chunks
from ..operators.markdown import markdown_tables
from ..operators.windows import char_windows, routed_chunks
from ..session import materialize
from ..sources.elements import collapse_groups, line_elements, page_elements, turn_elements
from . import fixtures as X

#: A cap that both splits and merges on the given texts.
SMALL_CAP = 64


def _joined(column: str, separator: str = "|"):
    """An array as one string; null stays null."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), separator).alias(column)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return line_elements(X.table(spark, sf, "documents"))


def windows(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    return char_windows(docs).select("doc_id", "chunk_no", "start", "text")


def routed(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    return routed_chunks(docs).select("doc_id", "chunk_no", "content_type", "text")


def scopes(spark: SparkSession, sf: str) -> DataFrame:
    return heading_scopes(_lines(spark, sf)).select("doc_id", "pos", "level", "text", "die")


def hierarchical(spark: SparkSession, sf: str) -> DataFrame:
    chunks = hierarchical_chunks(_lines(spark, sf))
    return chunks.select("doc_id", "pos", "text", _joined("headings"))


def turn_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns with the system and user turns in scope as headings."""
    chunks = hierarchical_chunks(turn_elements(X.table(spark, sf, "conversations")))
    return chunks.select("doc_id", "pos", "text", _joined("headings"))


def page_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Page text with title and heading, navigation and footer left out."""
    # both are read more than once: a page is parsed once, and lists are collapsed once
    elements = materialize(page_elements(X.table(spark, sf, "pages")), "elements")
    items = materialize(collapse_groups(elements), "items")
    return hierarchical_chunks(items).select("doc_id", "pos", "text", _joined("headings"))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return with_items(hierarchical_chunks(_lines(spark, sf)))


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours under equal headings merged; the default cap never binds here."""
    out = merge_peers(_chunks(spark, sf))
    return out.select(
        "doc_id", "pos", "text", _joined("headings"), F.size("items").alias("n_items")
    )


def split(spark: SparkSession, sf: str) -> DataFrame:
    out = split_long_chunks(_chunks(spark, sf), SMALL_CAP)
    return out.select("doc_id", "pos", "piece", "text", _joined("headings"))


def _boundary_pieces(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents").select(
        "doc_id", F.lit(0).alias("pos"), F.lit(None).cast("array<string>").alias("headings"), "text"
    )
    return split_at_boundaries(docs, SMALL_CAP)


def boundary_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents in pieces of at most 64 words, cut at the strongest boundaries."""
    return _boundary_pieces(spark, sf).select("doc_id", "piece", token_count("text").alias("num_tokens"), "text")


def rejoined_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """The pieces put together again, and whether all of them keep the cap."""
    pieces = _boundary_pieces(spark, sf)
    ordered = F.array_sort(F.collect_list(F.struct("piece", "text")))
    return pieces.groupBy("doc_id").agg(
        F.sha2(F.array_join(F.transform(ordered, lambda p: p["text"]), ""), 256).alias("text_sha256"),
        F.bool_and(token_count("text") <= SMALL_CAP).alias("within_cap"),
    )


def capped(spark: SparkSession, sf: str) -> DataFrame:
    """Split and merged under a cap that binds."""
    out = hybrid_chunks(_chunks(spark, sf), SMALL_CAP)
    return out.select("doc_id", "first_no", "text", _joined("headings"))


def chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = chunk_table(hybrid_chunks(_chunks(spark, sf)))
    return out.select(
        "id",
        "num_tokens",
        _joined("table_ids"),
        _joined("text_ids"),
        _joined("page_numbers"),
        "chunk_header",
        "content",
        "doc_id",
        "chunk_no",
    )


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """Documents chunked, embedded twice in one pass, saved and read back."""
    table = f"chunks_{uuid4().hex}"
    sizes = {"embedding": 64, "other_embedding": 128}
    embedders = {n: (lambda t, d=d: hash_embedding(t, d)) for n, d in sizes.items()}
    rows = store_chunks(_lines(spark, sf), table, embedders)
    again = store_chunks(_lines(spark, sf), table, embedders)
    return rows.join(again.select("id"), "id").select(
        "id",
        "doc_id",
        "num_tokens",
        F.size("embedding").alias("dim"),
        F.size("other_embedding").alias("other_dim"),
        F.round(vector_norm("embedding"), 4).alias("norm"),
        F.round(vector_norm("other_embedding"), 4).alias("other_norm"),
    )


def page_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct pages per document, from element rows and from the items of chunks."""
    rows = _lines(spark, sf).where(F.col("level").isNull())
    from_rows = rows.groupBy("doc_id").agg(F.sort_array(F.collect_set("page_no")).alias("pages"))
    items = with_items(rows.withColumn("headings", F.lit(None).cast("array<string>")))
    from_items = (
        items.select("doc_id", F.explode(item_pages("items")).alias("page"))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("page")).alias("of_items"))
    )
    both = from_rows.join(from_items, "doc_id")
    return both.select("doc_id", _joined("pages"), _joined("of_items"))


def markdown(spark: SparkSession, sf: str) -> DataFrame:
    nations = X.table(spark, sf, "nation")
    regions = X.table(spark, sf, "region")
    rows = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return markdown_tables(
        rows, "r_name", "n_nationkey", {"nation": "n_name", "key": "n_nationkey"}
    )


QUERIES = {
    "char_window_chunks": windows,
    "routed_chunks": routed,
    "heading_scopes": scopes,
    "hierarchical_chunks": hierarchical,
    "turn_chunks": turn_chunks,
    "page_chunks": page_chunks,
    "merged_peer_chunks": merged,
    "split_long_chunks": split,
    "boundary_pieces": boundary_pieces,
    "boundary_pieces_rejoined": rejoined_pieces,
    "hybrid_chunks": capped,
    "chunk_table": chunk_rows,
    "stored_chunk_table": stored,
    "page_sets": page_sets,
    "markdown_tables": markdown,
}

_E1 = f"{X.LINES_SQL},\n{X.scopes_sql('e1')}"
_JOIN = "array_to_string(headings, '|') AS headings"
_N = f"len({X.tokens_sql('text')})"
_HEAD_TOKENS = X.tokens_sql("coalesce(array_to_string(headings, chr(10)), '')")

#: Runs of equal headings over chunk rows ``src(doc_id, no, headings, text, ...)``.
_RUNS = """marked AS (
  SELECT *, CASE WHEN row_number() OVER w > 1 AND headings IS NOT DISTINCT FROM lag(headings) OVER w
    THEN 0 ELSE 1 END AS first FROM src WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
runs AS (
  SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY no) AS run FROM marked)"""

_MERGED = f"""{_E1},
src AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS no FROM hier),
{_RUNS},
merged AS (
  SELECT doc_id, run, min(pos) AS pos, any_value(headings) AS headings,
    string_agg(text, chr(10) ORDER BY no) AS text, count(*)::INTEGER AS n_items,
    list(pos ORDER BY no) FILTER (label = 'TABLE') AS table_ids,
    list(pos ORDER BY no) FILTER (label = 'TEXT') AS text_ids,
    list_sort(list(DISTINCT page_no)) AS page_numbers
  FROM runs GROUP BY doc_id, run)"""

_WORD = r"[^\p{L}\p{N}]*[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+\z)?"
_SPLIT = f"""{_E1},
sized AS (SELECT *, {_N} AS n, {SMALL_CAP} - len({_HEAD_TOKENS}) AS room0 FROM hier),
roomy AS (
  SELECT doc_id, pos, text, n, CASE WHEN room0 > 0 THEN headings END AS headings,
    CASE WHEN room0 > 0 THEN room0 ELSE {SMALL_CAP} END AS room FROM sized),
pieces AS (
  SELECT doc_id, pos, headings, 0 AS piece, text FROM roomy WHERE n <= room
  UNION ALL
  SELECT doc_id, pos, headings, i::INTEGER AS piece, array_to_string(w[i * room + 1 : (i + 1) * room], '') AS text
  FROM (SELECT *, unnest(range(0, (len(w) + room - 1) // room)) AS i
        FROM (SELECT *, regexp_extract_all(text, '{_WORD}') AS w FROM roomy WHERE n > room)))"""

_CAPPED = f"""{_SPLIT},
src AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, piece) - 1 AS no, {_N} AS n,
    {SMALL_CAP} - len({_HEAD_TOKENS}) AS room FROM pieces),
{_RUNS},
fold(doc_id, run, no, total, grp) AS (
  SELECT doc_id, run, no, n, no FROM runs WHERE first = 1
  UNION ALL
  SELECT r.doc_id, r.run, r.no, CASE WHEN f.total + r.n <= r.room THEN f.total + r.n ELSE r.n END,
    CASE WHEN f.total + r.n <= r.room THEN f.grp ELSE r.no END
  FROM fold f JOIN runs r ON r.doc_id = f.doc_id AND r.run = f.run AND r.no = f.no + 1)"""

ORACLES = {
    "char_window_chunks": f"WITH {X.WINDOWS_SQL} SELECT doc_id, chunk_no, start, text FROM windows",
    "routed_chunks": f"""WITH typed AS (SELECT doc_id, text, length(text) AS n, {X.table_like_sql('text')} AS tab
  FROM documents WHERE length(text) > 0)
SELECT doc_id, 0 AS chunk_no, 'table' AS content_type, text FROM typed WHERE tab
UNION ALL
SELECT doc_id, (s // 924)::INTEGER, 'narrative', substring(text, s + 1, 1024)
FROM (SELECT *, unnest(range(0, greatest(n - 101, 0) + 1, 924)) AS s FROM typed WHERE NOT tab)""",
    "heading_scopes": f"WITH {_E1} SELECT doc_id, pos, level, text, die FROM scopes",
    "hierarchical_chunks": f"WITH {_E1} SELECT doc_id, pos, text, {_JOIN} FROM hier",
    "turn_chunks": f"""WITH e AS (SELECT conv_id AS doc_id, turn AS pos, text, 'TEXT' AS label, 1 AS page_no,
  CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 END AS level FROM conversations),
{X.scopes_sql('e')} SELECT doc_id, pos, text, {_JOIN} FROM hier""",
    "merged_peer_chunks": f"WITH {_MERGED} SELECT doc_id, pos, text, {_JOIN}, n_items FROM merged",
    "boundary_pieces_rejoined": "SELECT doc_id, sha256(text) AS text_sha256, true AS within_cap FROM documents",
    "split_long_chunks": f"WITH {_SPLIT} SELECT doc_id, pos, piece, text, {_JOIN} FROM pieces",
    "hybrid_chunks": f"""WITH RECURSIVE {_CAPPED}
SELECT r.doc_id, f.grp AS first_no, string_agg(r.text, chr(10) ORDER BY r.no) AS text,
  array_to_string(any_value(r.headings), '|') AS headings
FROM fold f JOIN runs r ON r.doc_id = f.doc_id AND r.no = f.no GROUP BY r.doc_id, f.grp""",
    "chunk_table": f"""WITH {_MERGED},
shown AS (
  SELECT *, CASE WHEN headings IS NULL THEN text ELSE array_to_string(headings, chr(10)) || chr(10) || text END
    AS content FROM merged)
SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS id, len({X.tokens_sql('content')})::BIGINT AS num_tokens,
  coalesce(array_to_string(table_ids, '|'), '') AS table_ids,
  coalesce(array_to_string(text_ids, '|'), '') AS text_ids,
  array_to_string(page_numbers, '|') AS page_numbers,
  coalesce(array_to_string(headings, ', '), '') AS chunk_header, content, doc_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS chunk_no
FROM shown""",
    "stored_chunk_table": f"""WITH {_MERGED},
shown AS (
  SELECT *, CASE WHEN headings IS NULL THEN text ELSE array_to_string(headings, chr(10)) || chr(10) || text END
    AS content FROM merged),
counted AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS id, doc_id,
  len({X.tokens_sql('content')})::BIGINT AS num_tokens FROM shown)
SELECT id, doc_id, num_tokens, 64 AS dim, 128 AS other_dim,
  CASE WHEN num_tokens > 0 THEN 1.0::DOUBLE ELSE 0 END AS norm,
  CASE WHEN num_tokens > 0 THEN 1.0::DOUBLE ELSE 0 END AS other_norm FROM counted""",
    "page_sets": f"""WITH {X.LINES_SQL}
SELECT doc_id, array_to_string(list_sort(list(DISTINCT page_no)), '|') AS pages,
  array_to_string(list_sort(list(DISTINCT page_no)), '|') AS of_items
FROM e1 WHERE level IS NULL GROUP BY doc_id""",
    "markdown_tables": """SELECT r_name, '| nation | key |' || chr(10) || '| --- | --- |' || chr(10)
  || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS markdown,
  count(*) AS n_rows FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
}


def _page_chunks_sql() -> str:
    from .basics import page_items_sql

    lists = """joined AS (
  SELECT doc_id, pos, level, text, excluded, 'TEXT' AS label, 1 AS page_no FROM items WHERE group_ref IS NULL
  UNION ALL
  SELECT doc_id, min(pos), NULL, string_agg(text, chr(10) ORDER BY pos), bool_or(excluded), 'LIST', 1
  FROM items WHERE group_ref IS NOT NULL GROUP BY doc_id, group_ref),
shown AS (SELECT * FROM joined WHERE NOT excluded)"""
    return (
        f"WITH {page_items_sql()},\n{lists},\n{X.scopes_sql('shown')} "
        f"SELECT doc_id, pos, text, {_JOIN} FROM hier"
    )


ORACLES["page_chunks"] = _page_chunks_sql()
