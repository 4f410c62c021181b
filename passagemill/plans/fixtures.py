"""Inputs of the registered queries, derived from the given tables as a whole."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import detected_type
from ..operators.ann import CellIndex, build_cells
from ..operators.index import Index, build_index
from ..operators.postings import Postings, build_postings
from ..operators.windows import char_windows
from ..session import materialize, spread

DIM = 256
ID_STRIDE = 10_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; small single-file ones are spread over all cores."""
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """One question per benchmark item; long ones ask for no rows, short ones for two."""
    size = F.length("text")
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qid"),
        F.col("text").alias("question"),
        F.when(size > 350, 0).when(size < 150, 2).alias("k_override"),
    )


def passages(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of all documents with their header and detected type.

    The id is made of document and window number, so no numbering pass is needed;
    a text has far fewer than ``ID_STRIDE`` windows, as it is shorter than 2 GB.
    """
    windows = char_windows(table(spark, sf, "documents"), text="text")
    return windows.select(
        (F.col("doc_id") * ID_STRIDE + F.col("chunk_no")).alias("id"),
        "doc_id",
        "chunk_no",
        F.concat_ws(", ", "lang", "source").alias("chunk_header"),
        F.col("text").alias("content"),
        detected_type("text").alias("content_type"),
    )


_built: dict[tuple[str, str, str], tuple[Index, DataFrame]] = {}
_postings: dict[tuple[str, str], Postings] = {}
_cells: dict[tuple[str, str], CellIndex] = {}


def passage_index(spark: SparkSession, sf: str) -> tuple[Index, DataFrame]:
    """The passage table and its index, built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf, "passages")
    if key not in _built:
        rows = materialize(passages(spark, sf), "passages")
        index = Index(f"passages_{uuid4().hex}", DIM)
        build_index(rows, index)
        _built[key] = (index, rows)
    return _built[key]


def passage_postings(spark: SparkSession, sf: str) -> Postings:
    """Postings of the passage index, built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _postings:
        index, _ = passage_index(spark, sf)
        _postings[key] = build_postings(index.postings(spark), f"postings_{uuid4().hex}")
    return _postings[key]


def cell_index(spark: SparkSession, sf: str, k: int = 12) -> CellIndex:
    """The inverted file over all given vectors, built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _cells:
        vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
        _cells[key] = build_cells(vectors, f"cells_{uuid4().hex}", dim=64, k=k)
    return _cells[key]


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the documents: some rows gone, some new, some changed."""
    docs = table(spark, sf, "documents")
    changed = F.when(
        F.col("source").isin("src3", "src7"), F.concat("text", F.lit("!"))
    ).otherwise(F.col("text"))
    old = docs.where("lang <> 'de'")
    new = docs.where("lang <> 'fr'").withColumn("text", changed)
    return old, new


# The same inputs in SQL -----------------------------------------------------

OLD_SQL = "SELECT * FROM documents WHERE lang <> 'de'"
NEW_SQL = """SELECT doc_id, CASE WHEN source IN ('src3','src7') THEN text || '!' ELSE text END AS text,
  lang, source, n_chars FROM documents WHERE lang <> 'fr'"""

TOKENS_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def tokens_sql(column: str) -> str:
    return TOKENS_SQL.format(column)


def table_like_sql(column: str) -> str:
    from ..functions.text import NON_NUMERIC_PATTERN

    kept = f"length(regexp_replace({column}, '{NON_NUMERIC_PATTERN}', '', 'g'))"
    ratio = f"(CASE WHEN length({column}) > 0 THEN {kept}::DOUBLE / length({column}) ELSE 0 END)"
    marks = f"contains({column}, '|') OR contains({column}, chr(9)) OR contains({column}, '  ')"
    return f"({ratio} > 0.1 OR {marks})"


def ratio_sql(column: str) -> str:
    from ..functions.text import NON_NUMERIC_PATTERN

    kept = f"length(regexp_replace({column}, '{NON_NUMERIC_PATTERN}', '', 'g'))"
    return f"(CASE WHEN length({column}) > 0 THEN {kept}::DOUBLE / length({column}) ELSE 0 END)"


WINDOWS_SQL = """windows AS (
  SELECT doc_id, lang, source, (s // 924)::INTEGER AS chunk_no, s::INTEGER AS start,
         substring(text, s + 1, 1024) AS text
  FROM (SELECT *, unnest(range(0, greatest(length(text) - 101, 0) + 1, 924)) AS s
        FROM documents WHERE length(text) > 0))"""

LINES_SQL = f"""lines AS (
  SELECT doc_id, pos - 1 AS pos, list_extract(l, pos) AS text
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
  WHERE length(list_extract(l, pos)) > 0),
e1 AS (
  SELECT doc_id, pos, text, CASE WHEN length(text) < 40 THEN 1 + length(text) % 3 END AS level,
    CASE WHEN length(text) < 40 THEN 'SECTION_HEADER'
         WHEN {table_like_sql('text')} THEN 'TABLE' ELSE 'TEXT' END AS label,
    (pos // 20 + 1)::INTEGER AS page_no
  FROM lines)"""


def scopes_sql(elements: str) -> str:
    """Heading scopes over elements (doc_id, pos, level, text) by correlated lookups."""
    return f"""heads AS (SELECT doc_id, pos, level, text FROM {elements} WHERE level IS NOT NULL),
body AS (SELECT * FROM {elements} WHERE level IS NULL AND length(text) > 0),
marks AS (
  SELECT h.*,
    (SELECT min(s.pos) FROM heads s WHERE s.doc_id = h.doc_id AND s.pos > h.pos AND s.level < h.level) AS ns,
    (SELECT min(c.pos) FROM body c WHERE c.doc_id = h.doc_id AND c.pos > h.pos) AS nc
  FROM heads h),
fates AS (
  SELECT m.*,
    (SELECT min(s.pos) FROM heads s WHERE s.doc_id = m.doc_id AND s.level = m.level AND s.pos > m.nc) AS nx,
    lag(text) OVER (PARTITION BY doc_id, level, coalesce(ns, -1), coalesce(nc, -1) ORDER BY pos) AS before
  FROM marks m),
scopes AS (
  SELECT doc_id, pos, level, text, nullif(least(coalesce(ns, 4611686018427387904),
    coalesce(nx, 4611686018427387904)), 4611686018427387904) AS die
  FROM fates WHERE text IS DISTINCT FROM before),
hier AS (
  SELECT c.doc_id, c.pos, c.label, c.text, c.page_no,
    list(s.text ORDER BY s.level, s.pos) FILTER (s.text IS NOT NULL) AS headings
  FROM body c LEFT JOIN scopes s
    ON s.doc_id = c.doc_id AND s.pos < c.pos AND c.pos < coalesce(s.die, 4611686018427387904)
  GROUP BY ALL)"""


PASSAGES_SQL = f"""{WINDOWS_SQL},
passages AS (
  SELECT doc_id * {ID_STRIDE} + chunk_no AS id, text AS content, lang || ', ' || source AS chunk_header,
    CASE WHEN {table_like_sql('text')} THEN 'table' ELSE 'narrative' END AS content_type
  FROM windows),
questions AS (
  SELECT item_id AS qid, text AS question,
    CASE WHEN length(text) > 350 THEN 0 WHEN length(text) < 150 THEN 2 END AS k_override
  FROM benchmark)"""

BM25_SQL = f"""words AS (SELECT id, {tokens_sql('content')} AS w FROM passages),
lens AS (SELECT id, len(w)::BIGINT AS dl FROM words),
size AS (SELECT count(*) AS n, sum(dl)::DOUBLE / count(*) AS mean FROM lens),
tf AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(w) AS t FROM words) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
qt AS (SELECT DISTINCT qid, unnest({tokens_sql('question')}) AS t FROM questions),
bm25 AS (
  SELECT qid, id, round(sum(part), 6)::DOUBLE AS score FROM (
    SELECT qid, tf.id, (ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf.tf::DOUBLE * 2.2)
        / (tf.tf::DOUBLE + 1.2 * (1 - 0.75 + 0.75 * dl / mean)))::DECIMAL(20,10) AS part
    FROM qt JOIN tf USING (t) JOIN df USING (t) JOIN lens ON lens.id = tf.id, size)
  GROUP BY qid, id)"""


def hash_weights_sql(source: str, key: str, column: str) -> str:
    """``key, bucket, n, weight`` of the hashed-word embedding."""
    return f"""SELECT {key}, bucket, n, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})::DOUBLE))::FLOAT AS weight
  FROM (SELECT {key}, bucket, count(*) AS n FROM (
    SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS bucket
    FROM (SELECT {key}, unnest({tokens_sql(column)}) AS t FROM {source})) GROUP BY ALL)"""


DENSE_SQL = f"""pvec AS ({hash_weights_sql('passages', 'id', 'content')}),
qvec AS ({hash_weights_sql('questions', 'qid', 'question')}),
dots AS (
  SELECT qid, id, sum(p.weight::DOUBLE * q.weight::DOUBLE) AS s
  FROM qvec q JOIN pvec p USING (bucket) GROUP BY qid, id),
dense AS (
  SELECT q.qid, p.id, round(coalesce(s, 0), 6) AS score
  FROM (SELECT DISTINCT qid FROM qvec) q CROSS JOIN (SELECT DISTINCT id FROM pvec) p
  LEFT JOIN dots d ON d.qid = q.qid AND d.id = p.id)"""


def ranked_sql(name: str, source: str, k: int) -> str:
    return f"""{name} AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM {source})
  WHERE rank <= {k})"""


def hybrid_sql(k: int, depth: int | None = None, own: bool = False) -> str:
    """``own``: both lists are cut at each question's own k before they are fused."""
    depth = depth or k
    cut = f" JOIN questions USING (qid) WHERE rank <= coalesce(k_override, {k})" if own else ""
    return f"""{PASSAGES_SQL},
{BM25_SQL},
{DENSE_SQL},
{ranked_sql('kw', 'bm25', depth)},
{ranked_sql('dn', 'dense', depth)},
fused AS (
  SELECT qid, id, round(sum(part), 6)::DOUBLE AS score FROM (
    SELECT qid, id, (1.0::DOUBLE / (60 + rank))::DECIMAL(20,12) AS part
    FROM kw{cut}
    UNION ALL SELECT qid, id, (1.0::DOUBLE / (60 + rank))::DECIMAL(20,12)
    FROM dn{cut})
  GROUP BY qid, id),
{ranked_sql('fused_top', 'fused', depth)},
hits AS (
  SELECT f.* FROM fused_top f JOIN questions USING (qid) WHERE rank <= coalesce(k_override, {k}))"""


def fixed_sql(value: str, places: int) -> str:
    return f"round(coalesce({value}, 0), {places})::DECIMAL(20,{places})::VARCHAR"
