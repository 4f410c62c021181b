"""Keyword ranking over stored postings with block maxima.

``build_postings`` turns a forward index around: passages are dealt to shards of
bounded size by their id, the postings of a term in a shard are cut into blocks of
``BLOCK`` passages in id order, and a block keeps the largest BM25 part (without
the term's weight) of its passages. The table lies in a folder per term bucket,
sorted by term, so a search reads the asked terms only; a term that occurs
everywhere is spread over its shards.

A search skips twice, and never a passage that belongs to the answer. The k-th
largest block maximum of a term comes from k different passages, so the k-th best
score of a question is known to be at least that before anything is read; blocks
that cannot reach it even with the largest parts of the question's other terms
stay out of the shuffle. Inside a shard the block maxima of a question's terms
are overlaid over ranges of passages; ranges are scored from the highest bound
(the sum over the terms of the largest maximum of a block that reaches into it)
downwards until no bound reaches the k-th best score so far.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, fits_broadcast, materialize
from ..sources.tables import swap_table
from .keyword import B, K1, PART_SCALE, SCORE_UNIT, SHIP_BYTES, SHIP_WEIGHTS, question_terms
from .topk import SCORE_DECIMALS, Best, hit_schema, numpy_values, rank_top

#: Passages of a shard (about), postings of a block, folders of terms.
SHARD_PASSAGES = 16_384
BLOCK = 128
BUCKETS = 64
#: Tasks that postings are built in at least, and shards of one task beyond that.
BUILD_TASKS = 32
TASK_SHARDS = 4
#: Block maxima that are known per term before a search, and lists merged at a time.
BEST_KEPT = 64
MERGED = 1024
#: Asked terms that are pushed to the scan by name; more are met by a join.
PUSHED_TERMS = 1000
#: Passages of a shard that share one bound, and ranges scored in the first step.
RANGE = 256
FIRST_RANGES = 4
#: Bounds are doubles: one that is short of a score by less than this is not below it.
SLACK = 2.0 / 10**SCORE_DECIMALS


@dataclass(frozen=True)
class Postings:
    """Handle of stored postings; BM25 settings and sizes are those of the build."""

    name: str
    n: int
    mean: float
    k1: float = K1
    b: float = B

    def blocks(self, spark: SparkSession) -> DataFrame:
        """``term, shard, first, last, top, postings(id, tf, dl), bucket``."""
        return spark.read.table(f"{self.name}_postings")

    def terms(self, spark: SparkSession) -> DataFrame:
        """``term, df, best``: the largest block maxima of every term, falling."""
        return spark.read.table(f"{self.name}_maxima")


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _largest(values: Column) -> Column:
    return F.slice(F.sort_array(values, asc=False), 1, BEST_KEPT)


def build_postings(index: DataFrame, name: str, *, k1: float = K1, b: float = B) -> Postings:
    """Write the postings of a forward index ``id, dl, terms(value, n)``."""
    n, total = index.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
    mean = total / n if n and total else 1.0
    shards = max(1, math.ceil(n / SHARD_PASSAGES))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")
    # whole passages move to the task of their shard, once; their postings are made,
    # grouped and written there
    tasks = max(BUILD_TASKS, math.ceil(shards / TASK_SHARDS))
    passages = index.select("id", "dl", "terms", shard).withColumn("task", F.pmod("shard", F.lit(tasks)))
    # more partitions than tasks, so that few of them meet in one
    single = passages.repartition(4 * tasks, "task").select("id", "dl", "shard", "task", F.explode("terms").alias("t")).select(
        F.col("t.value").alias("term"),
        "shard",
        "task",
        F.struct("id", F.col("t.n").cast("int").alias("tf"), F.col("dl").cast("int").alias("dl")).alias("p"),
    )

    def part(p: Column) -> Column:
        tf = p["tf"].cast("double")
        return (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * p["dl"] / F.lit(mean)))

    grouped = single.groupBy("task", "term", "shard").agg(F.sort_array(F.collect_list("p")).alias("all"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(BLOCK))
    cut = grouped.select("term", "shard", F.explode(F.transform(starts, lambda s: F.slice("all", s, BLOCK))).alias("postings"))
    blocks = cut.select(
        "term", "shard",
        F.col("postings")[0]["id"].alias("first"), F.element_at("postings", -1)["id"].alias("last"),
        F.array_max(F.transform("postings", part)).alias("top"), "postings", _bucket(F.col("term")).alias("bucket"),
    )
    # a bucket has a file of each task, so a frequent term is no single one
    swap_table(blocks.sortWithinPartitions("bucket", "term", "shard", "first"), f"{name}_postings", partition_by=["bucket"])
    spark = index.sparkSession
    found = Postings(name, n, mean, k1, b)
    # a group holds one value per block of MERGED shards; tasks merge their own before the shuffle
    lists = found.blocks(spark).groupBy("term", F.floor(F.col("shard") / MERGED).cast("int").alias("g")).agg(
        F.sum(F.size("postings")).alias("df"), _largest(F.collect_list("top")).alias("best")
    )
    shards = math.ceil(shards / MERGED)
    while shards > 1:
        shards = math.ceil(shards / MERGED)
        lists = lists.groupBy("term", F.floor(F.col("g") / MERGED).cast("int").alias("g")).agg(
            F.sum("df").alias("df"), _largest(F.flatten(F.collect_list("best"))).alias("best")
        )
    swap_table(lists.select("term", "df", "best"), f"{name}_maxima")
    return found


def _weights(questions: DataFrame, postings: Postings, k: int) -> DataFrame:
    """``qid, term, idf, known, need``: a question's terms in the index.

    ``known`` is what the k-th best score reaches at least; a block matters to the
    question only if its maximum is at least ``need``.
    """
    asked = question_terms(questions)
    idf = F.log(1 + (F.lit(postings.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    found = broadcast_if_small(asked, "term").join(postings.terms(questions.sparkSession), "term").select(
        "qid", "term", idf.alias("idf"), (idf * F.col("best")[0]).alias("most"),
        (F.coalesce(idf * F.get("best", F.lit(k - 1)), F.lit(0.0)) if k <= BEST_KEPT else F.lit(0.0)).alias("kth"),
    )
    bounds = found.groupBy("qid").agg(F.max("kth").alias("known"), F.sum("most").alias("sum"))
    others = F.col("sum") - F.col("most")
    return found.join(bounds, "qid").select(
        "qid", "term", "idf", "known", ((F.col("known") - SLACK - others) / F.col("idf")).alias("need")
    )


def read_blocks(spark: SparkSession, postings: Postings, weights: DataFrame) -> DataFrame:
    """The blocks of the asked terms that can matter to a question."""
    needed = weights.groupBy("term").agg(F.min("need").alias("need"))
    buckets = [r.bucket for r in needed.select(_bucket(F.col("term")).alias("bucket")).distinct().collect()]
    blocks = postings.blocks(spark).where(F.col("bucket").isin(buckets))
    named = [r.term for r in needed.select("term").limit(PUSHED_TERMS + 1).collect()]
    if len(named) <= PUSHED_TERMS:
        blocks = blocks.where(F.col("term").isin(named))
    return blocks.join(broadcast_if_small(needed, "term"), "term").where("top >= need").drop("need", "bucket")


def postings_topk(questions: DataFrame, postings: Postings, k: int) -> DataFrame:
    """``qid, id, score, rank``: the k best passages per question, as ``bm25_topk`` finds them.

    Question weights are shipped to the tasks; a batch that is too large is cut into
    parts by question, each of them searched on its own.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = questions.sparkSession
    weights = materialize(_weights(questions, postings, k), "weights")
    parts = 1
    if not fits_broadcast(weights, "term", max_rows=SHIP_WEIGHTS, max_bytes=SHIP_BYTES):
        rows, size = weights.agg(F.count("*"), F.sum(F.octet_length("term") + 80)).first()
        parts = 2 * math.ceil(max(rows / SHIP_WEIGHTS, size / SHIP_BYTES))
    found = None
    for i in range(parts):
        mine = weights.where(F.pmod(F.xxhash64("qid"), F.lit(parts)) == i) if parts > 1 else weights
        scored = _searched(mine, read_blocks(spark, postings, mine), postings, k)
        found = scored if found is None else found.unionByName(scored)
    return rank_top(found, k)


def _searched(weights: DataFrame, blocks: DataFrame, postings: Postings, k: int) -> DataFrame:
    shipped = weights.select("qid", "term", "idf", "known").toArrow()
    vocabulary = pc.unique(shipped.column("term"))
    term_of = numpy_values(pc.index_in(shipped.column("term"), value_set=vocabulary))
    qids, question_of = np.unique(numpy_values(shipped.column("qid")), return_inverse=True)
    idf_of, known_of = numpy_values(shipped.column("idf")), numpy_values(shipped.column("known"))
    order = np.argsort(question_of, kind="stable")
    ends = np.searchsorted(question_of[order], np.arange(len(qids) + 1))
    asked = [(term_of[o], idf_of[o], known_of[o[0]]) for o in (order[a:z] for a, z in zip(ends, ends[1:]))]
    qid_type = shipped.schema.field("qid").type

    def search(shard: pa.Table) -> pa.Table:
        best = Best(qids, k)
        held = _Shard(shard, vocabulary, postings)
        for q, (terms, idf, known) in enumerate(asked):
            held.search(best, q, terms, idf, known)
        return pa.Table.from_batches([best.batch(qid_type, shard.schema.field("id").type)])

    flat = blocks.select(
        "shard", "term", "first", "last", "top", F.col("postings.id").alias("ids"),
        F.col("postings.tf").alias("tf"), F.col("postings.dl").alias("dl"), F.col("first").alias("id"),
    )
    return flat.groupBy("shard").applyInArrow(search, hit_schema(weights, flat))


class _Shard:
    """The asked blocks of one shard as flat arrays, and bounds per range of its passages."""

    def __init__(self, table: pa.Table, vocabulary: pa.Array, postings: Postings):
        table = table.combine_chunks()
        code = numpy_values(pc.index_in(table.column("term"), value_set=vocabulary))
        order = np.lexsort((numpy_values(table.column("first")), code))
        table, code = table.take(pa.array(order)).combine_chunks(), code[order]
        lists = table.column("ids").combine_chunks()
        size = numpy_values(pc.list_value_length(lists)).astype(np.int64)
        self.ids, place = np.unique(numpy_values(lists.flatten()), return_inverse=True)
        self.place = place
        tf = numpy_values(table.column("tf").combine_chunks().flatten()).astype(np.float64)
        dl = numpy_values(table.column("dl").combine_chunks().flatten()).astype(np.float64)
        k1, b = postings.k1, postings.b
        self.over, self.under = tf * (k1 + 1), tf + k1 * (1 - b + b * dl / postings.mean)
        self.ranges = n = -(-len(self.ids) // RANGE)
        # where the postings of a term that belong to a range begin
        starts = np.r_[0, np.cumsum(size)]
        key = np.repeat(code, size).astype(np.int64) * n + place // RANGE
        self.at = np.searchsorted(key, np.arange(len(vocabulary) * n + 1))
        # the largest block maximum of a term over each range that the block reaches into
        low, high = place[starts[:-1]] // RANGE, place[starts[1:] - 1] // RANGE
        reach = high - low + 1
        within = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        self.top = np.zeros((len(vocabulary), n))
        np.maximum.at(self.top, (np.repeat(code, reach), np.repeat(low, reach) + within), np.repeat(numpy_values(table.column("top")), reach))
        self.scored = 0

    def search(self, best: Best, q: int, terms: np.ndarray, idf: np.ndarray, known: float) -> None:
        """Offer the passages that can be among the k best of one question.

        Ranges are scored from the highest bound downwards, in steps of growing size.
        """
        bound = idf @ self.top[terms]
        left = np.flatnonzero(bound > 0)
        left = left[np.argsort(-bound[left], kind="stable")]
        sums, step = np.zeros(len(self.ids)), FIRST_RANGES
        while len(left):
            held = best.scores[q]
            floor = max(known, held[-1] if len(held) == best.k else 0.0)
            left = left[bound[left] >= floor - SLACK]
            self._offer(best, q, terms, idf, sums, np.sort(left[:step]))
            left, step = left[step:], step * 4

    def _offer(self, best: Best, q: int, terms: np.ndarray, idf: np.ndarray, sums: np.ndarray, chosen: np.ndarray) -> None:
        if not len(chosen):
            return
        breaks = np.flatnonzero(np.diff(chosen) > 1) + 1
        runs = [(r[0], r[-1] + 1) for r in np.split(chosen, breaks)]
        for t, w in zip(terms, idf, strict=True):
            for a, z in runs:
                low, high = self.at[t * self.ranges + a], self.at[t * self.ranges + z]
                if low < high:
                    self.scored += high - low
                    # whole multiples of 1 / PART_SCALE: their sum does not depend on its order
                    parts = np.floor(w * self.over[low:high] / self.under[low:high] * PART_SCALE + 0.5)
                    sums[self.place[low:high]] += parts
        for a, z in runs:
            here = sums[a * RANGE:z * RANGE]
            hit = np.flatnonzero(here > 0)
            scores = np.floor((here[hit] + SCORE_UNIT / 2) / SCORE_UNIT) / 10**SCORE_DECIMALS
            best.offer(q, self.ids[a * RANGE + hit], scores)
