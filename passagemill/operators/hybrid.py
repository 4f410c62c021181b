"""Token-aware chunks: long ones split, neighbours under the same headings merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import join_headings, token_count
from ..session import materialize
from .scan import block_of, running_max

MAX_TOKENS = 1_000_000
#: Largest run of neighbours folded as one array; longer runs are linked by joins.
FOLD_ROWS = 4096

#: A word with the separators before it; the last word keeps those after it too.
_WORD = r"[^\p{L}\p{N}]*[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+\z)?"


def with_items(chunks: DataFrame) -> DataFrame:
    """Chunks of single elements with their element as the one-entry ``items``."""
    item = F.struct("self_ref", "label", "page_no")
    return chunks.select("doc_id", "pos", "headings", "text", F.array(item).alias("items"))


def split_long_chunks(chunks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Split chunks whose headings and text exceed ``max_tokens``; adds ``piece``.

    Pieces hold as many words as fit beside the headings, which are repeated;
    headings that fill the limit alone are dropped. The pieces of a text put
    together give the text again. Runs inside the row: no shuffle.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be at least 1")
    room = F.lit(max_tokens) - token_count(join_headings("headings", "\n"))
    sized = chunks.withColumns({"_n": token_count("text"), "_room": room}).withColumns(
        {
            "_room": F.when(F.col("_room") > 0, F.col("_room")).otherwise(F.lit(max_tokens)),
            "headings": F.when(F.col("_room") > 0, F.col("headings")),
        }
    )
    words = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))

    def cut(all_words):
        parts = F.ceil(F.size(all_words) / F.col("_room"))
        return F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.greatest(parts - 1, F.lit(0))),
            lambda i: F.array_join(
                F.slice(
                    all_words,
                    (i * F.col("_room") + 1).cast("int"),
                    F.col("_room").cast("int"),
                ),
                "",
            ),
        )

    pieces = F.when(F.col("_n") <= F.col("_room"), F.array("text")).otherwise(
        F.element_at(F.transform(F.array(words), cut), 1)
    )
    kept = [c for c in chunks.columns if c != "text"]
    return sized.select(*kept, F.posexplode(pieces).alias("piece", "text"))


def merge_peers(chunks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Merge neighbouring chunks with equal headings up to ``max_tokens`` in all.

    Greedy from the left: a chunk joins the open group when headings are equal
    and headings plus texts stay within the limit. Input and output have
    ``doc_id, pos, headings, text, items``; an optional ``piece`` orders equal
    positions.
    """
    if "piece" not in chunks.columns:
        chunks = chunks.withColumn("piece", F.lit(0))
    # Several passes follow, most of them over a few narrow columns.
    chunks = materialize(chunks.withColumn("n", token_count("text")), "chunks")
    grouped = _grouped(_islands(chunks, max_tokens))
    ordered = F.sort_array(F.collect_list(F.struct("no", "text", "items")))
    return (
        grouped.groupBy("doc_id", "grp")
        .agg(
            F.min("pos").alias("pos"),
            F.min_by("headings", "no").alias("headings"),
            ordered.alias("m"),
        )
        .select(
            "doc_id",
            "pos",
            "headings",
            F.array_join(F.transform("m", lambda x: x["text"]), "\n").alias("text"),
            F.flatten(F.transform("m", lambda x: x["items"])).alias("items"),
            F.col("grp").alias("first_no"),
        )
    )


def hybrid_chunks(chunks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Split, then merge: no chunk above the limit unless its parts cannot be cut."""
    return merge_peers(split_long_chunks(chunks, max_tokens), max_tokens)


def _islands(chunks: DataFrame, max_tokens: int) -> DataFrame:
    """Chunks with ``no`` (their place in the document), ``room`` and ``island``.

    An island is a run of equal headings, named by its first number. Place and
    predecessor are found inside blocks; one summary row per block carries the
    count and the last headings over to the next block.
    """
    blocked = chunks.withColumns({"_blk": block_of("pos"), "_h": F.struct("headings")})
    place = F.struct("pos", "piece")
    inside = W.partitionBy("doc_id", "_blk").orderBy("pos", "piece")
    across = W.partitionBy("doc_id").orderBy("_blk")
    summary = (
        blocked.groupBy("doc_id", "_blk")
        .agg(F.count("*").alias("rows"), F.max_by("_h", place).alias("tail"))
        .select(
            "doc_id",
            "_blk",
            F.coalesce(
                F.sum("rows").over(across.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("base"),
            F.lag("tail").over(across).alias("tail"),
        )
    )
    room = F.lit(max_tokens) - token_count(join_headings("headings", "\n"))
    before = F.coalesce("_before", "tail")
    marked = (
        blocked.withColumns(
            {"_i": F.row_number().over(inside) - 1, "_before": F.lag("_h").over(inside)}
        )
        .join(summary, ["doc_id", "_blk"])
        .withColumns({"no": F.col("base") + F.col("_i"), "room": room})
        .withColumn("_start", F.when(~F.col("_h").eqNullSafe(before), F.col("no")))
        .drop("_i", "_before", "_h", "base", "tail")
    )
    return running_max(marked, "doc_id", "no", F.col("_start"), "island").drop("_start")


def _grouped(islands: DataFrame) -> DataFrame:
    """Add ``grp``: the number of the first chunk of every chunk's group."""
    narrow = materialize(islands.select("doc_id", "_blk", "no", "n", "room", "island"), "peers")
    sizes = narrow.groupBy("doc_id", "island").agg(
        F.sum("n").alias("total"), F.count("*").alias("rows"), F.min("room").alias("room")
    )
    over = sizes.where(F.col("total") > F.col("room")).select("doc_id", "island", "rows")
    widest = over.agg(F.max("rows")).first()[0]
    if widest is None:  # every run fits: its start is the group
        return islands.withColumn("grp", F.col("island"))
    return islands.join(_group_starts(narrow, over, widest), ["doc_id", "no"])


def _group_starts(islands: DataFrame, over: DataFrame, widest: int) -> DataFrame:
    """``doc_id, no, grp`` where some runs exceed the limit."""
    rows = islands.join(over, ["doc_id", "island"])
    starts = _fold_starts(rows.where(F.col("rows") <= FOLD_ROWS))
    if widest > FOLD_ROWS:
        starts = starts.unionByName(_linked_starts(rows.where(F.col("rows") > FOLD_ROWS)))
    starts = materialize(starts.withColumn("s", F.col("no")), "starts")
    marked = islands.join(starts, ["doc_id", "no"], "left")
    first = F.when(F.col("no") == F.col("island"), F.col("no"))
    return running_max(marked, "doc_id", "no", F.coalesce(F.col("s"), first), "grp").select(
        "doc_id", "no", "grp"
    )


def _fold_starts(rows: DataFrame) -> DataFrame:
    """Group starts of runs of bounded length, folded over one array per run."""
    runs = rows.groupBy("doc_id", "island").agg(
        F.sort_array(F.collect_list(F.struct("no", "n"))).alias("a"), F.min("room").alias("room")
    )
    empty = F.struct(F.lit(-1).cast("bigint").alias("t"), F.array().cast("array<bigint>").alias("s"))

    def step(acc, x):
        fits = (acc["t"] >= 0) & (acc["t"] + x["n"] <= F.col("room"))
        return F.struct(
            F.when(fits, acc["t"] + x["n"]).otherwise(x["n"]).alias("t"),
            F.when(fits, acc["s"]).otherwise(F.concat(acc["s"], F.array(x["no"]))).alias("s"),
        )

    return runs.select(
        "doc_id", F.explode(F.aggregate("a", empty, step, lambda acc: acc["s"])).alias("no")
    )


def _linked_starts(rows: DataFrame) -> DataFrame:
    """Group starts of very long runs, without holding a run in one task.

    Every chunk is linked to the start that would follow if a group began at
    it; the links reachable from the run's first chunk are then found by
    doubling: after i rounds the first 2**i starts are known. Each round joins
    on the chunk number, a unique key, and is written to the shared folder.
    """
    key = ["doc_id", "island"]
    base = _prefix(rows).withColumn("w", F.greatest("room", F.lit(1)))
    low, high, width = F.col("lo"), F.col("hi"), F.col("w")
    # A chunk spans the token buckets it touches; a link looks into one bucket.
    points = base.withColumn(
        "bucket", F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))
    ).select(*key, "bucket", high.alias("at"), F.lit(1).alias("kind"), "no")
    asks = base.select(
        *key,
        F.floor((low + F.col("w")) / width).alias("bucket"),
        (low + F.col("w")).alias("at"),
        F.lit(0).alias("kind"),
        "no",
    )
    above = (
        W.partitionBy(*key, "bucket")
        .orderBy(F.desc("at"), "kind")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    found = F.min(F.when(F.col("kind") == 1, F.col("no"))).over(above)
    links = (
        points.unionByName(asks)
        .withColumn("nxt", found)
        .where((F.col("kind") == 0) & F.col("nxt").isNotNull())
        # A chunk larger than the limit still makes a group of its own.
        .select("doc_id", "no", F.greatest("nxt", F.col("no") + 1).alias("nxt"))
    )
    ends = base.groupBy(*key).agg(F.max("no").alias("stop"))
    spans = base.select(*key, "no").join(ends, key)
    links = links.join(spans, ["doc_id", "no"]).where(F.col("nxt") <= F.col("stop"))
    links = materialize(links.select("doc_id", "no", "nxt"), "links")
    starts = base.where(F.col("no") == F.col("island")).select("doc_id", "no")
    while True:
        reached = starts.join(links, ["doc_id", "no"]).select("doc_id", F.col("nxt").alias("no"))
        reached = materialize(reached.join(starts, ["doc_id", "no"], "left_anti"), "starts")
        if reached.isEmpty():
            return starts
        starts = starts.unionByName(reached)
        far = links.select("doc_id", F.col("no").alias("nxt"), F.col("nxt").alias("far"))
        links = materialize(
            links.join(far, ["doc_id", "nxt"]).select("doc_id", "no", F.col("far").alias("nxt")),
            "links",
        )


def _prefix(rows: DataFrame) -> DataFrame:
    """Tokens before (``lo``) and up to (``hi``) each chunk, over its document's long runs."""
    inside = W.partitionBy("doc_id", "_blk").orderBy("no").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("doc_id").orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("doc_id", "_blk")
        .agg(F.sum("n").alias("bn"))
        .select("doc_id", "_blk", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("base"))
    )
    return (
        rows.withColumn("run", F.sum("n").over(inside))
        .join(blocks, ["doc_id", "_blk"])
        .withColumn("hi", F.col("base") + F.col("run"))
        .withColumn("lo", F.col("hi") - F.col("n"))
        .drop("run", "base")
    )
