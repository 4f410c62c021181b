"""Registered queries: upserts, change feed, index build and sync, streamed refresh."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.digests import change_feed_by_tree
from ..operators.index import Index, build_index, create_or_sync_index, sync_index
from ..operators.keyed import create_keyed, upsert_keyed
from ..operators.mutation import append_rows, change_feed, upsert, upsert_rows
from ..operators.windows import char_windows
from ..session import delete_paths, work_path
from ..sources.tables import append_table, create_table
from ..streaming.chain import open_chain, refresh_chain
from ..streaming.refresh import refresh
from . import fixtures as X

KEY = ["doc_id"]


def upserted(spark: SparkSession, sf: str) -> DataFrame:
    old, new = X.versions(spark, sf)
    return upsert_rows(old, new, KEY)


def upserted_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a catalog table, with the number of source rows it reports."""
    old, new = X.versions(spark, sf)
    name = f"docs_{uuid4().hex}"
    append_table(old, name)
    count = upsert(spark, name, new, KEY)
    return spark.read.table(name).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.endswith("text", F.lit("!"))).alias("n_marked"),
        F.sum("n_chars").alias("n_chars"),
    ).withColumn("n_source", F.lit(count).cast("bigint"))


def appended(spark: SparkSession, sf: str) -> DataFrame:
    """The fallback of a failed upsert: rows of equal key are then there twice."""
    old, new = X.versions(spark, sf)
    return append_rows(old, new).groupBy("doc_id").agg(F.count("*").alias("n_rows"))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    old, new = X.versions(spark, sf)
    return change_feed(old, new, KEY)


def feed_by_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes, rows being joined in differing key ranges only."""
    old, new = X.versions(spark, sf)
    return change_feed_by_tree(old, new, KEY)


def _docs_index(spark: SparkSession) -> Index:
    return Index(f"docs_{uuid4().hex}", X.DIM)


def _rows(frame: DataFrame) -> DataFrame:
    return frame.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def _index_rows(spark: SparkSession, index: Index) -> DataFrame:
    """Index entries as scalars: length, distinct terms, vector weight and usability."""
    norm = F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return index.entries(spark).select(
        "id",
        "dl",
        F.coalesce(F.size("terms"), F.lit(0)).alias("n_terms"),
        F.round(norm, 4).alias("weight"),
        "ok",
    )


def index_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Index of all documents, built from their text."""
    index = _docs_index(spark)
    build_index(_rows(X.table(spark, sf, "documents")), index)
    return _index_rows(spark, index)


def index_terms(spark: SparkSession, sf: str) -> DataFrame:
    index, _ = X.passage_index(spark, sf)
    return index.terms(spark)


def stored_vector_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index of the given vectors, taken from their stored column."""
    vectors = X.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("content"),
        "embedding",
    )
    index = Index(f"vectors_{uuid4().hex}", 64)
    build_index(vectors, index, vector="embedding")
    return _index_rows(spark, index)


def incremental_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Built on the old version, synced to the new one; equals a rebuild of the new one."""
    old, new = X.versions(spark, sf)
    index = _docs_index(spark)
    build_index(_rows(old), index)
    counts = sync_index(_rows(new), index)
    return _index_rows(spark, index).select(
        "*", *[F.lit(counts[c]).cast("bigint").alias(c) for c in ("inserted", "deleted", "updated")]
    )


def guarded_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Create-or-sync from a table by name: first call creates, a second one syncs."""
    old, new = X.versions(spark, sf)
    name = f"src_{uuid4().hex}"
    append_table(_rows(old), name)
    index = _docs_index(spark)
    skipped = create_or_sync_index(spark, name, index, ["other"])
    created = create_or_sync_index(spark, name, index, [name])
    upsert(spark, name, _rows(new), ["id"])
    create_or_sync_index(spark, name, index, [name])
    frequencies = index.terms(spark)
    return frequencies.select(
        "term", "df", F.lit(skipped).alias("skipped"), F.lit(created).alias("created")
    )


def stream_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of files refreshed into one table; the second brings changed rows."""
    old, new = X.versions(spark, sf)
    drop, checkpoint = work_path(spark, "drop"), work_path(spark, "refresh")
    name = f"refreshed_{uuid4().hex}"
    create_table(spark, name, "doc_id bigint, text string, n_chars bigint")
    for version in (old, new):
        version.write.mode("append").parquet(drop)
        refresh(
            spark,
            drop,
            version.schema,
            name,
            KEY,
            checkpoint,
            transform=lambda rows: rows.select("doc_id", "text", "n_chars"),
            order="text",
        )
    return spark.read.table(name)


def upserted_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert through a table of key buckets, of which only touched ones are rewritten."""
    old, new = X.versions(spark, sf)
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    table = create_keyed(spark, f"keyed_{uuid4().hex}", columns, KEY, 16)
    upsert_keyed(table, old)
    upsert_keyed(table, new)
    return table.read(spark)


def failed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A source that brings some keys twice cannot be merged; all its rows are appended."""
    old, new = X.versions(spark, sf)
    name = f"docs_{uuid4().hex}"
    append_table(old, name)
    count = upsert(spark, name, new.unionByName(new.where("source = 'src3'")), KEY, on_error="append")
    rows = spark.read.table(name).groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    return rows.withColumn("n_source", F.lit(count).cast("bigint"))


def _drops(spark: SparkSession, versions: tuple[DataFrame, ...], drop: str, refresh: Callable[[DataFrame], None]) -> None:
    """Every version as a drop of files, taken in by ``refresh``; files that were taken in are not kept beside the tables."""
    for version in versions:
        version.write.mode("append").option("compression", "zstd").parquet(drop)
        refresh(version)
        delete_paths(spark, [drop])


def stream_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Files through elements, chunks, embedding and index: two drops, the second one delivered twice."""
    old, new = X.versions(spark, sf)
    drop, checkpoint = work_path(spark, "drop"), work_path(spark, "chain")
    chain = open_chain(spark, f"chain_{uuid4().hex}", X.DIM, buckets=16)
    _drops(
        spark, (old, new, new), drop,
        lambda version: refresh_chain(spark, chain, drop, version.schema, checkpoint, order="n_chars"),
    )
    chunks = chain.chunks.read(spark).select("id", "doc_id", "chunk_no", "chunk_header", "content", "content_type")
    return chunks.join(_index_rows(spark, chain.index), "id")


def stream_chain_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Term counts of the maintained index after the same drops, in small batches."""
    old, new = X.versions(spark, sf)
    drop, checkpoint = work_path(spark, "drop"), work_path(spark, "chain")
    chain = open_chain(spark, f"chain_{uuid4().hex}", X.DIM, buckets=16)
    _drops(
        spark, (old, new, new), drop,
        lambda version: refresh_chain(
            spark, chain, drop, version.schema, checkpoint, order="n_chars", files_per_batch=4,
            chunker=lambda docs: char_windows(docs).select("doc_id", "chunk_no", F.col("text").alias("content")),
        ),
    )
    return chain.terms.read(spark).where("df > 0").select("term", "df")


QUERIES = {
    "upsert_partitions": upserted_partitions,
    "upsert_failed_append": failed_upsert,
    "stream_chain": stream_chain,
    "stream_chain_terms": stream_chain_terms,
    "upsert": upserted,
    "upsert_table": upserted_table,
    "upsert_append_fallback": appended,
    "change_feed": feed,
    "change_feed_tree": feed_by_tree,
    "index_rebuild": index_rebuild,
    "index_terms": index_terms,
    "stored_vector_index": stored_vector_index,
    "incremental_sync": incremental_sync,
    "guarded_sync": guarded_sync,
    "stream_refresh": stream_refresh,
}

_V = f"v1 AS ({X.OLD_SQL}), v2 AS ({X.NEW_SQL})"
_UP = f"{_V}, up AS (SELECT * FROM v2 UNION ALL SELECT * FROM v1 WHERE doc_id NOT IN (SELECT doc_id FROM v2))"


def _entries_sql(source: str) -> str:
    return f"""w AS (SELECT doc_id AS id, {X.tokens_sql('text')} AS t FROM {source})
SELECT id, len(t)::BIGINT AS dl, len(list_distinct(t))::INTEGER AS n_terms,
  CASE WHEN len(t) > 0 THEN 1.0::DOUBLE ELSE 0 END AS weight, len(t) > 0 AS ok"""


_CHANGED = "a.text IS DISTINCT FROM b.text"
_FEED = f"""WITH {_V}
SELECT 'insert' AS _change_type, * FROM v2 WHERE doc_id NOT IN (SELECT doc_id FROM v1)
UNION ALL SELECT 'delete', * FROM v1 WHERE doc_id NOT IN (SELECT doc_id FROM v2)
UNION ALL SELECT 'update_preimage', a.* FROM v1 a JOIN v2 b USING (doc_id) WHERE {_CHANGED}
UNION ALL SELECT 'update_postimage', b.* FROM v1 a JOIN v2 b USING (doc_id) WHERE {_CHANGED}"""

ORACLES = {
    "upsert": f"WITH {_UP} SELECT * FROM up",
    "upsert_partitions": f"WITH {_UP} SELECT * FROM up",
    "upsert_failed_append": f"""WITH {_V}, source AS (SELECT doc_id FROM v2 UNION ALL SELECT doc_id FROM v2 WHERE doc_id IN
    (SELECT doc_id FROM documents WHERE source = 'src3'))
SELECT doc_id, count(*) AS n_rows, (SELECT count(*) FROM source) AS n_source
FROM (SELECT doc_id FROM v1 UNION ALL SELECT doc_id FROM source) GROUP BY doc_id""",
    "stream_chain": f"""WITH {_UP}, documents AS (SELECT * FROM up), {X.LINES_SQL},
{X.scopes_sql('e1')},
c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS chunk_no,
    coalesce(array_to_string(headings, ', '), '') AS chunk_header,
    coalesce(array_to_string(headings, chr(10)) || chr(10), '') || text AS content FROM hier),
w AS (SELECT *, {X.tokens_sql('content')} AS t FROM c)
SELECT doc_id * {X.ID_STRIDE} + chunk_no AS id, doc_id, chunk_no, chunk_header, content,
  CASE WHEN {X.table_like_sql('content')} THEN 'table' ELSE 'narrative' END AS content_type,
  len(t)::BIGINT AS dl, len(list_distinct(t))::INTEGER AS n_terms,
  CASE WHEN len(t) > 0 THEN 1.0::DOUBLE ELSE 0 END AS weight, len(t) > 0 AS ok FROM w""",
    "stream_chain_terms": f"""WITH {_UP}, documents AS (SELECT * FROM up), {X.PASSAGES_SQL}
SELECT term, count(*) AS df FROM (SELECT DISTINCT id, unnest({X.tokens_sql('content')}) AS term FROM passages)
GROUP BY term""",
    "upsert_table": f"""WITH {_UP} SELECT count(*) AS n_rows, count(*) FILTER (text LIKE '%!') AS n_marked,
  sum(n_chars)::BIGINT AS n_chars, (SELECT count(*) FROM v2) AS n_source FROM up""",
    "upsert_append_fallback": f"""WITH {_V} SELECT doc_id, count(*) AS n_rows
FROM (SELECT doc_id FROM v1 UNION ALL SELECT doc_id FROM v2) GROUP BY doc_id""",
    "change_feed": _FEED,
    "change_feed_tree": _FEED,
    "index_rebuild": f"WITH {_entries_sql('documents')} FROM w",
    "index_terms": f"""WITH {X.PASSAGES_SQL}
SELECT term, count(*) AS df FROM (SELECT DISTINCT id, unnest({X.tokens_sql('content')}) AS term FROM passages)
GROUP BY term""",
    "stored_vector_index": """SELECT vec_id AS id, 2::BIGINT AS dl, 2 AS n_terms,
  round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) AS weight, true AS ok FROM embeddings""",
    "incremental_sync": f"""WITH {_V}, {_entries_sql('v2')},
  (SELECT count(*) FROM v2 WHERE doc_id NOT IN (SELECT doc_id FROM v1)) AS inserted,
  (SELECT count(*) FROM v1 WHERE doc_id NOT IN (SELECT doc_id FROM v2)) AS deleted,
  (SELECT count(*) FROM v1 a JOIN v2 b USING (doc_id) WHERE {_CHANGED}) AS updated FROM w""",
    "guarded_sync": f"""WITH {_UP}
SELECT term, count(*) AS df, false AS skipped, true AS created
FROM (SELECT DISTINCT doc_id, unnest({X.tokens_sql('text')}) AS term FROM up) GROUP BY term""",
    "stream_refresh": f"WITH {_UP} SELECT doc_id, text, n_chars FROM up",
}
