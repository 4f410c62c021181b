"""Registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.session import spread, work_path

from . import byte_bpe, chat, exact_search, hnsw, jaccard_join, masked_lm, mixing, piece_bpe, quality, token_files, toxicity, turn_repair, whitening

QUERIES = {}
ORACLES = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").filter(exact_search.usable("embedding"))
    whole = vectors.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x)).alias("vector"))
    return exact_search.exact_topk(whole, whole.filter(F.col("vec_id") % 20 == 0), 20)


ORACLES["op8_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@_query
def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    index = hnsw.build_index(vectors, 10)
    return hnsw.search_index(index, vectors.filter(F.col("vec_id") % 100 == 0), 10)


@_query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conflict = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(conflict).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(turns.unionByName(planted)))


_TURN_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_matches(text, '<<SYS>>|<</SYS>>|\\[INST\\]|\\[/INST\\]|<s>|</s>|\\[ROLE\\]|\\[TEXT\\]|\\[/ROLE\\]') AS hit,
    regexp_replace(text, '(<<SYS>>|<</SYS>>|\\[INST\\]|\\[/INST\\]|<s>|</s>|\\[ROLE\\]|\\[TEXT\\]|\\[/ROLE\\])', '\\\\\\1', 'g') AS safe
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length(CASE WHEN hit THEN safe ELSE text END)
      + CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 WHEN 'system' THEN 18 ELSE length(role) + 24 END) AS BIGINT) AS formatted_chars,
    CAST(max(CASE WHEN hit THEN 1 ELSE 0 END) AS INTEGER) AS passes
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars, passes
FROM g
"""
ORACLES["op1_chat_format"] = _TURN_SQL


@_query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels.filter(~toxicity.held_out("doc_id")))
    return toxicity.score(documents, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"), "offending",
    )


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = quality.train(documents, _table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id")))
    return quality.score(documents, model).select(
        "doc_id", "quality_score", F.when(F.col("quality_score") >= 0.5, 1).otherwise(0).alias("keep"), "text_view", "page_view"
    )


@_query
def op6_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    ranks, pattern = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.encode(documents, ranks, pattern, decoded=True))


@_query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op4_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT r.doc_id, any_value(coalesce(n.n, 0)) AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@_query
def op9_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return masked_lm.score(documents, masked_lm.train(documents)).drop("text")


@_query
def op2_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    path = work_path(spark, "token-ids")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_ids(documents, path, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_ids(spark, path, digest=True)


@_query
def op12_piece_bpe(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    import public_tokenizers

    model = model or public_tokenizers.path("piece_bpe_32k.model")
    documents = spread(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return piece_bpe.digests(piece_bpe.encode(documents, model, decoded=True))


@_query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), 32)


@_query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return turn_repair.digests(turn_repair.repair(turn_repair.damaged(turns), copies="copies"))


ORACLES["op13_turn_repair"] = """
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), c AS (
  SELECT *, xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda s, b: list_reduce(list_prepend(xor(s, b), [CAST(0 AS BIGINT) FOR x IN range(8)]),
        lambda x, y: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1))))) % 20 AS f
  FROM k
), d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), o AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS previous,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS is_cut
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), e AS (
  SELECT *, i > min(i) OVER (PARTITION BY conv_id, role, text) AS is_copy, is_blank OR is_copy AS must_go,
    CASE WHEN is_cut THEN 1 ELSE 0 END AS late
  FROM o
), n AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_copy AND NOT is_blank) AS duplicate,
    count(*) FILTER (is_cut AND NOT is_copy AND NOT is_blank) AS truncated,
    count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM e GROUP BY conv_id
), p AS (
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': '', 't': ''} AS none, {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s,
    {'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'} AS u, {'c': 0, 'a': '', 't': ''} AS a
  FROM n
  UNION ALL
  SELECT conv_id, i,
    least(none, {'c': 2 + u.c, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}),
    least(s, {'c': 2 + u.c, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}),
    least(u, {'c': 2 + a.c, 'a': 'I' || a.a, 't': chr(10) || 'assistant:' || a.t}),
    least(a, {'c': 2 + u.c, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t})
  FROM (
    SELECT e.conv_id, e.i,
      least({'c': none.c + 3, 'a': 'D' || none.a, 't': none.t},
        CASE WHEN NOT must_go THEN {'c': u.c + 2 + late, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t} END,
        CASE WHEN NOT must_go AND initial = 'u' THEN {'c': u.c + late, 'a': 'K' || u.a, 't': chr(10) || role || ':' || text || u.t} END,
        CASE WHEN NOT must_go AND initial = 's' THEN {'c': s.c + late, 'a': 'K' || s.a, 't': chr(10) || role || ':' || text || s.t} END) AS none,
      least({'c': s.c + 3, 'a': 'D' || s.a, 't': s.t},
        CASE WHEN NOT must_go THEN {'c': u.c + 2 + late, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t} END,
        CASE WHEN NOT must_go AND initial = 'u' THEN {'c': u.c + late, 'a': 'K' || u.a, 't': chr(10) || role || ':' || text || u.t} END) AS s,
      least({'c': u.c + 3, 'a': 'D' || u.a, 't': u.t},
        CASE WHEN NOT must_go THEN {'c': a.c + 2 + late, 'a': 'R' || a.a, 't': chr(10) || 'assistant:' || text || a.t} END,
        CASE WHEN NOT must_go AND initial = 'a' THEN {'c': a.c + late, 'a': 'K' || a.a, 't': chr(10) || role || ':' || text || a.t} END) AS u,
      least({'c': a.c + 3, 'a': 'D' || a.a, 't': a.t},
        CASE WHEN NOT must_go THEN {'c': u.c + 2 + late, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t} END,
        CASE WHEN NOT must_go AND initial = 'u' THEN {'c': u.c + late, 'a': 'K' || u.a, 't': chr(10) || role || ':' || text || u.t} END) AS a
    FROM p JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i - 1
  )
)
SELECT x.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, CAST(coalesce(p.none.c, 0) AS BIGINT) AS cost,
  coalesce(p.none.a, '') AS audit, sha256(coalesce(substr(p.none.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM x.conv_id
LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM x.conv_id AND p.i = 1
"""
