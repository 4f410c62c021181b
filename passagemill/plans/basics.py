"""Registered queries: sources, projections, tables, guards and pluggable models."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batched import embedding_provider
from ..functions.text import (
    detected_type,
    effective_type,
    has_extension,
    last_segment,
    merge_maps,
    numeric_ratio,
    token_count,
    trim_trailing_slash,
    type_weight,
)
from ..functions.vectors import has_dimension, weighted_counts
from ..operators.index import provider, split_by_dimension
from ..session import work_path
from ..sources import elements as E
from ..sources.dead_letters import open_parse, run_parse
from ..sources.files import file_metadata, file_texts, in_few_tasks, scan_files
from ..sources.isolation import check_isolated, parse_isolated, quarantined, succeeded
from ..sources.tables import (
    append_table,
    create_table,
    is_table_empty,
    known_sources,
    run_stage,
    set_table_property,
    table_exists,
    table_property,
)
from . import fixtures as X


def page_files(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.table(spark, sf, "pages")
    return pages.select(
        last_segment("url").alias("file_name"),
        F.col("url").alias("file_path"),
        F.octet_length("html").cast("bigint").alias("file_size"),
    ).where(has_extension("file_name", ".html"))


def pages_elements(spark: SparkSession, sf: str) -> DataFrame:
    items = E.page_elements(X.table(spark, sf, "pages"))
    return items.where(~F.col("excluded")).select(
        "doc_id", "pos", "kind", "label", "level", "text", "self_ref"
    )


def collapsed_lists(spark: SparkSession, sf: str) -> DataFrame:
    items = E.page_elements(X.table(spark, sf, "pages"))
    return E.collapse_groups(items).select("doc_id", "pos", "label", "text", "self_ref")


def excluded_items(spark: SparkSession, sf: str) -> DataFrame:
    items = E.page_elements(X.table(spark, sf, "pages"))
    refs = items.where("excluded").select("doc_id", "self_ref")
    kept = E.exclude_refs(items, refs)
    return kept.groupBy("doc_id", "label").agg(F.count("*").alias("n_items"))


def listed_files(spark: SparkSession, sf: str) -> DataFrame:
    return file_metadata(scan_files(spark, sf, ".parquet"), ".PARQUET").select(
        "file_name", "file_size"
    )


def trimmed_urls(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "pages").select("page_id", trim_trailing_slash("url").alias("url"))


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "documents").select("doc_id", token_count("text").alias("num_tokens"))


def content_type(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents").select("doc_id", "text", numeric_ratio("text").alias("r"))
    kind = detected_type("text", F.col("r"))
    return docs.select(
        "doc_id",
        F.round("r", 6).alias("numeric_ratio"),
        kind.alias("detected_type"),
        type_weight(kind, 0.6, 0.4).alias("weight"),
    )


def type_fallback(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents")
    own = F.when(F.col("lang") == "de", "table").when(F.col("lang") == "fr", "narrative")
    seen = F.when(F.col("lang") != "es", detected_type("text"))
    return docs.select("doc_id", effective_type(own, seen).alias("type"))


def merged_metadata(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents")
    computed = F.create_map(
        F.lit("content_type"), detected_type("text"), F.lit("lang"), F.lit("unknown")
    )
    own = F.when(
        F.col("lang") != "es", F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    )
    entries = F.array_sort(F.map_entries(merge_maps(computed, own)))
    shown = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return docs.select("doc_id", F.array_join(shown, ";").alias("meta"))


def hash_embedding_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Non-zero weights of every document's vector."""
    counted = X.table(spark, sf, "documents").select(
        "doc_id", F.inline(F.array(weighted_counts("text", X.DIM)))
    )
    return counted.select("doc_id", "norm", F.explode("counts").alias("p")).select(
        "doc_id",
        F.col("p.value").alias("bucket"),
        F.round(F.col("p.n") / F.col("norm"), 6).alias("weight"),
    )


def vector_dim_check(spark: SparkSession, sf: str) -> DataFrame:
    chosen = provider("local", {"local": provider("hash"), "hash": provider("hash")})
    vectors = X.table(spark, sf, "embeddings")
    good, bad = split_by_dimension(vectors, "embedding", 64)
    wrong = vectors.where(has_dimension("embedding", chosen.dim))
    counted = [
        frame.agg(F.count("*").alias("n_rows")).withColumn("part", F.lit(name))
        for name, frame in (("fits", good), ("other", bad), ("fits_provider", wrong))
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def micro_batches(spark: SparkSession, sf: str, size: int = 16) -> DataFrame:
    """Batch number of every document inside its source, batches of fixed size."""
    from ..operators.scan import number_rows

    docs = X.table(spark, sf, "documents").select("source", "doc_id")
    rows = number_rows(docs, "source", "doc_id", index="i")
    return rows.select(
        "doc_id", "source", F.floor(F.col("i") / size).cast("bigint").alias("batch")
    )


def source_guard(spark: SparkSession, sf: str) -> DataFrame:
    nations = X.table(spark, sf, "nation").select(F.concat(F.lit("geo.db."), "n_name").alias("name"))
    regions = X.table(spark, sf, "region")
    listed = (
        X.table(spark, sf, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name").isin("ASIA", "EUROPE"))
        .select(F.col("n_name").alias("name"))
    )
    return known_sources(nations, listed).select("name", "known")


def table_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """Create with declared columns, set a property, append, read back by name."""
    from uuid import uuid4

    name = f"files_{uuid4().hex}"
    create_table(
        spark, name, "file_name string, file_path string, file_size bigint"
    )
    before = is_table_empty(spark, name)
    append_table(page_files(spark, sf), name)
    set_table_property(spark, name, "reviewed", "yes")
    return spark.read.table(name).select(
        "file_name",
        "file_path",
        "file_size",
        F.lit(before).alias("was_empty"),
        F.lit(table_property(spark, name, "reviewed")).alias("reviewed"),
    )


def stage_guard(spark: SparkSession, sf: str) -> DataFrame:
    """A stage run twice: the second run returns the stored rows, nothing is added."""
    from uuid import uuid4

    name = f"stage_{uuid4().hex}"
    empty_before = is_table_empty(spark, name)
    run_stage(spark, name, lambda: token_counts(spark, sf))
    stored = run_stage(spark, name, lambda: token_counts(spark, sf))
    return stored.agg(
        F.count("*").alias("n_rows"), F.sum("num_tokens").alias("num_tokens")
    ).select(
        "n_rows",
        "num_tokens",
        F.lit(empty_before).alias("empty_before"),
        F.lit(table_exists(spark, name)).alias("exists_after"),
    )


def quarantined_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages split by checks that stay in the JVM: an unclosed bold is an error."""
    html = F.col("html")
    checked = check_isolated(
        X.table(spark, sf, "pages"),
        {
            "no title": F.contains(html, F.lit("</title>")),
            "unclosed bold": F.regexp_count(html, F.lit("<b>")) == F.regexp_count(html, F.lit("</b>")),
        },
    )
    return (
        succeeded(checked)
        .select("page_id", F.lit("ok").alias("outcome"))
        .unionByName(quarantined(checked).select("page_id", F.col("error").alias("outcome")))
    )


def scanned_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as one file each, found, read and decoded again, and parsed to elements."""
    folder = work_path(spark, "pages")
    pages = X.table(spark, sf, "pages")
    # one folder for all: a folder of its own per page would make listing cost more than reading.
    # The id is the last line of a file. Tasks move their files themselves, as the folder is fresh.
    line = F.concat_ws("\x03", F.coalesce("html", F.lit("")), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    writer = pages.select(line.alias("value")).write.option("lineSep", "\x03").option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
    texts = file_texts(in_few_tasks(scan_files(spark, folder, ".txt"))).where(F.col("error").isNull())
    page = F.regexp_extract("text", "\x03(-?[0-9]*)\x03$", 1).try_cast("bigint")
    html = F.rtrim(F.regexp_replace("text", "\x03-?[0-9]*\x03$", ""), F.lit("\x03"))
    pages = texts.select(page.alias("page_id"), html.alias("html"))
    return E.page_elements(pages).where(~F.col("excluded")).select(
        "doc_id", "pos", "kind", "label", "level", "text", "self_ref"
    )


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Pages parsed in three runs, the last one with a mended parser; only failures are taken up again."""
    pages = X.table(spark, sf, "pages").select("page_id", "html")
    tables = open_parse(spark, f"letters_{uuid4().hex}", {"page_id": "bigint"}, {"title": "string"}, 8)
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)

    def parse(mended: bool):
        bold = F.regexp_count("html", F.lit("<b>")) == F.regexp_count("html", F.lit("</b>"))
        checks = {"entity in the title": ~F.contains(title, F.lit("&"))}
        return lambda rows: check_isolated(rows.withColumn("title", title), checks if mended else checks | {"unclosed bold": bold})

    counts = [run_parse(pages, tables, parse(mended), max_attempts=3) for mended in (False, False, True)]
    good = tables.parsed.read(spark).select("page_id", "title", F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"))
    bad = tables.failed.read(spark).select("page_id", F.lit(None).cast("string").alias("title"), "error", "attempts")
    first, last = counts[0], counts[-1]
    return good.unionByName(bad).select(
        "*", F.lit(first["failed"]).cast("bigint").alias("failed_first"), F.lit(last["parsed"]).cast("bigint").alias("parsed_last")
    )


def _title_of(html: str) -> str:
    found = re.search(r"<title>(.*?)</title>", html, re.S)
    if not found or "&" in found.group(1):
        raise ValueError("title holds an entity")
    return found.group(1)


def isolated_parse(spark: SparkSession, sf: str) -> DataFrame:
    """A Python parser that fails on some pages; the others go on."""
    parsed = parse_isolated(X.table(spark, sf, "pages"), _title_of, "html", "string")
    return parsed.select("page_id", F.col("parsed").alias("title"), "error")


def _length_model():
    """Stand-in model: refuses a slice that holds a text without any letter a."""

    def embed(texts: list[str]) -> list[list[float]]:
        if any("a" not in t for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0, 0.0, 0.0] for t in texts]

    return embed


def batched_apply_status(spark: SparkSession, sf: str) -> DataFrame:
    """A failing model in slices of one row, and a second one in the same pass."""
    one = embedding_provider(_length_model, 4, 1)
    other = embedding_provider(_length_model, 4, 1)
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    both = docs.select("doc_id", one("text").alias("a"), other("text").alias("b"))
    return both.select(
        "doc_id",
        F.col("a.ok").alias("ok"),
        F.size("a.value").alias("dim"),
        F.element_at("a.value", 1).cast("double").alias("first"),
        F.col("b.error").alias("error"),
    )


QUERIES = {
    "file_metadata": page_files,
    "pages_elements": pages_elements,
    "collapsed_lists": collapsed_lists,
    "excluded_items": excluded_items,
    "scan_files": listed_files,
    "trimmed_urls": trimmed_urls,
    "token_counts": token_counts,
    "content_type": content_type,
    "type_fallback": type_fallback,
    "merge_metadata": merged_metadata,
    "hash_embedding": hash_embedding_weights,
    "vector_dim_check": vector_dim_check,
    "micro_batches": micro_batches,
    "source_guard": source_guard,
    "table_ddl": table_ddl,
    "stage_guard": stage_guard,
    "quarantine_pages": quarantined_pages,
    "scanned_pages": scanned_pages,
    "dead_letters": dead_letters,
    "isolated_parse": isolated_parse,
    "batched_apply_status": batched_apply_status,
}

_TYPE = f"CASE WHEN {X.table_like_sql('text')} THEN 'table' ELSE 'narrative' END"


def page_items_sql() -> str:
    """Items of pages by window sums: depths are running sums above their lowest value."""
    dropped = "html"
    for pattern in E.DROPPED_MARKUP:
        dropped = f"regexp_replace({dropped}, '{pattern}', '', 'g')"
    marked = (
        f"chr(2) || chr(2) || regexp_replace({dropped}, '(?i)<(/?(?:{E.BLOCK_TAGS}))\\b([^>]*)>',"
        " chr(1) || '\\1' || chr(2) || '\\2' || chr(2), 'g')"
    )
    text = "regexp_replace(raw, '<[^>]*>', ' ', 'g')"
    for entity, sign in E.ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, entity, sign.replace("'", "''"))
    text = f"trim(regexp_replace({text}, '[ \\t\\r\\n]+', ' ', 'g'))"
    turns = {name: (f"'{name}'", f"'/{name}'") for name in ("nav", "footer", "div")}
    turns["list"] = ("'ul', 'ol'", "'/ul', '/ol'")
    sums = ", ".join(
        f"sum(CASE WHEN tag IN ({up}) THEN 1 WHEN tag IN ({down}) THEN -1 ELSE 0 END) OVER w AS {name}_sum"
        for name, (up, down) in turns.items()
    )
    depths = ", ".join(f"{name}_sum - least(0, min({name}_sum) OVER w) AS {name}_depth" for name in turns)
    return f"""blocks AS (
  SELECT page_id, i, lower(split_part(piece, chr(2), 1)) AS tag, split_part(piece, chr(2), 2) AS attributes,
    list_extract(string_split(piece, chr(2)), -1) AS raw
  FROM (SELECT page_id, i, list_extract(p, i + 1) AS piece
        FROM (SELECT page_id, p, unnest(range(0, len(p))) AS i
              FROM (SELECT page_id, string_split({marked}, chr(1)) AS p FROM pages)))),
sums AS (
  SELECT *, {sums}, count(*) FILTER (tag IN ('ul', 'ol')) OVER w AS lists_seen
  FROM blocks WINDOW w AS (PARTITION BY page_id ORDER BY i)),
depths AS (SELECT *, {depths} FROM sums WINDOW w AS (PARTITION BY page_id ORDER BY i)),
adverts AS (
  SELECT page_id, i AS first, div_depth AS depth FROM depths
  WHERE tag = 'div' AND regexp_matches(attributes, '{E.ADVERTISEMENT}')),
inside AS (
  SELECT DISTINCT page_id, i FROM (
    SELECT d.page_id, d.i, a.depth, min(d.div_depth) OVER (PARTITION BY d.page_id, a.first ORDER BY d.i) AS lowest
    FROM depths d JOIN adverts a ON a.page_id = d.page_id AND d.i >= a.first)
  WHERE lowest >= depth),
cells AS (
  SELECT d.page_id AS doc_id, d.i AS pos, tag, raw,
    nav_depth > 0 OR footer_depth > 0 OR n.i IS NOT NULL AS excluded,
    CASE WHEN list_depth > 0 THEN max(CASE WHEN tag IN ('ul', 'ol') THEN lists_seen END)
      OVER (PARTITION BY d.page_id, list_depth ORDER BY d.i) END AS group_no
  FROM depths d LEFT JOIN inside n ON n.page_id = d.page_id AND n.i = d.i),
levels AS (
  SELECT *, {text} AS text, CASE WHEN tag = 'title' THEN 0
    WHEN regexp_full_match(tag, 'h[1-6]') THEN substr(tag, 2, 1)::INTEGER END AS level FROM cells),
items AS (
  SELECT doc_id, pos, CASE WHEN level IS NULL THEN 'content' ELSE 'heading' END AS kind,
    CASE WHEN level = 0 THEN 'TITLE' WHEN level > 0 THEN 'SECTION_HEADER'
         WHEN tag = 'li' THEN 'LIST_ITEM' ELSE 'TEXT' END AS label,
    level, text, '#/texts/' || pos AS self_ref, excluded,
    CASE WHEN tag = 'li' THEN '#/groups/' || group_no END AS group_ref
  FROM levels WHERE length(text) > 0)"""


_ITEMS = page_items_sql()

_PAGES = f"""WITH {_ITEMS}
SELECT doc_id, pos, kind, label, level, text, self_ref FROM items WHERE NOT excluded"""

ORACLES = {
    "file_metadata": r"""SELECT list_extract(string_split(url, '/'), -1) AS file_name, url AS file_path,
  octet_length(encode(html))::BIGINT AS file_size FROM pages
  WHERE lower(list_extract(string_split(url, '/'), -1)) LIKE '%.html'""",
    "pages_elements": _PAGES,
    "scanned_pages": _PAGES,
    "dead_letters": """WITH t AS (
  SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
    len(regexp_extract_all(html, '<b>')) <> len(regexp_extract_all(html, '</b>')) AS bold FROM pages)
SELECT page_id, CASE WHEN NOT contains(title, '&') THEN title END AS title,
  CASE WHEN contains(title, '&') THEN 'entity in the title' END AS error,
  CASE WHEN contains(title, '&') THEN 3 ELSE 0 END AS attempts,
  (SELECT count(*) FROM t WHERE contains(title, '&') OR bold) AS failed_first,
  (SELECT count(*) FROM t WHERE bold AND NOT contains(title, '&')) AS parsed_last FROM t""",
    "collapsed_lists": f"""WITH {_ITEMS}
SELECT doc_id, pos, label, text, self_ref FROM items WHERE group_ref IS NULL
UNION ALL
SELECT doc_id, min(pos), 'LIST', string_agg(text, chr(10) ORDER BY pos), group_ref
FROM items WHERE group_ref IS NOT NULL GROUP BY doc_id, group_ref""",
    "excluded_items": f"""WITH {_ITEMS}
SELECT doc_id, label, count(*) AS n_items FROM items WHERE NOT excluded GROUP BY ALL""",
    "trimmed_urls": "SELECT page_id, regexp_replace(url, '/+$', '') AS url FROM pages",
    "token_counts": f"SELECT doc_id, len({X.tokens_sql('text')})::BIGINT AS num_tokens FROM documents",
    "content_type": f"""SELECT doc_id, round({X.ratio_sql('text')}, 6) AS numeric_ratio,
  {_TYPE} AS detected_type, CASE WHEN {X.table_like_sql('text')} THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END AS weight
FROM documents""",
    "type_fallback": f"""SELECT doc_id, coalesce(CASE lang WHEN 'de' THEN 'table' WHEN 'fr' THEN 'narrative' END,
  CASE WHEN lang <> 'es' THEN {_TYPE} END, 'unknown') AS type FROM documents""",
    "merge_metadata": f"""SELECT doc_id, CASE WHEN lang <> 'es'
  THEN 'content_type=' || {_TYPE} || ';lang=' || lang || ';source=' || source
  ELSE 'content_type=' || {_TYPE} || ';lang=unknown' END AS meta FROM documents""",
    "hash_embedding": f"""SELECT doc_id, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)::DOUBLE), 6) AS weight
FROM (SELECT doc_id, bucket, count(*) AS n FROM (
  SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {X.DIM} AS bucket
  FROM (SELECT doc_id, unnest({X.tokens_sql('text')}) AS t FROM documents)) GROUP BY ALL)""",
    "vector_dim_check": f"""SELECT 'fits' AS part, count(*) FILTER (len(embedding) = 64) AS n_rows FROM embeddings
UNION ALL SELECT 'other', count(*) FILTER (len(embedding) <> 64) FROM embeddings
UNION ALL SELECT 'fits_provider', count(*) FILTER (len(embedding) = {X.DIM}) FROM embeddings""",
    "micro_batches": """SELECT doc_id, source,
  ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16)::BIGINT AS batch FROM documents""",
    "source_guard": """SELECT 'geo.db.' || n_name AS name, r_name IN ('ASIA','EUROPE') AS known
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "table_ddl": r"""SELECT list_extract(string_split(url, '/'), -1) AS file_name, url AS file_path,
  octet_length(encode(html))::BIGINT AS file_size, true AS was_empty, 'yes' AS reviewed FROM pages
  WHERE lower(list_extract(string_split(url, '/'), -1)) LIKE '%.html'""",
    "stage_guard": f"""SELECT count(*) AS n_rows, sum(len({X.tokens_sql('text')}))::BIGINT AS num_tokens,
  true AS empty_before, true AS exists_after FROM documents""",
    "quarantine_pages": """SELECT page_id, CASE WHEN NOT contains(html, '</title>') THEN 'no title'
  WHEN len(regexp_extract_all(html, '<b>')) <> len(regexp_extract_all(html, '</b>')) THEN 'unclosed bold'
  ELSE 'ok' END AS outcome FROM pages""",
    "isolated_parse": """SELECT page_id, CASE WHEN NOT contains(t, '&') THEN t END AS title,
  CASE WHEN contains(t, '&') THEN 'ValueError: title holds an entity' END AS error
FROM (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages)""",
    "batched_apply_status": """SELECT doc_id, contains(text, 'a') AS ok, 4 AS dim,
  CASE WHEN contains(text, 'a') THEN length(text)::FLOAT::DOUBLE ELSE 0 END AS first,
  CASE WHEN NOT contains(text, 'a') THEN 'refused' END AS error FROM documents""",
}

