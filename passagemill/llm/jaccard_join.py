"""Jaccard similarity join over word shingles with signature trees.

Documents with equal shingle sets are one node. Two nodes can only link if they
share one of their first shingles (their prefix), in any order that is the same
for all documents; shingles that occur often come last, so what many documents
share hardly brings any together. Nodes meet on prefix shingles in two passes:

1. Each node is held against anchors, one per prefix shingle and size class. A large
   group of near copies becomes one component here, with about as many comparisons
   as nodes, and shingles of two nodes are settled.
2. Shingles whose nodes lie in several components get a signature tree: leaves
   are bounded groups of nodes of similar size; every tree node holds the OR of
   its members' shingle bitmaps, their size range and their range of components.
   Pairs of tree nodes are followed from the leaves' summaries down, and dropped
   when the largest possible overlap is too small for any pair of sizes below
   them, or when everything below them is connected already.

Pairs that survive are held against wide bitmaps, whose size follows that of the sets, and
then compared exactly on their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from passagemill.session import broadcast_if_small, materialize

from .arrays import shingle_sets, text_slices
from .graph import components

#: Words of a shingle and the least similarity in hundredths (production values).
SHINGLE_WORDS = 4
PERCENT = 85
#: 64-bit words of a node's bitmap, members of a leaf on average, of a tree's last level.
SIGNATURE_WORDS = 32
LEAF = 128
LAST = 8
#: Shingles that come last in the order: at most so many, seen so often in one batch of rows.
#: Any choice gives the same links.
FREQUENT = 200_000
OFTEN = 4

#: Bits of a text's wide bitmap for each shingle, at least.
WIDE_BITS = 4

_SETS = "doc_id bigint, n int, key binary, prefix array<bigint>, signature array<bigint>, wide binary"


def frequent_shingles(documents: DataFrame, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the most frequent shingles in all texts, rarest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, _, data, offsets in text_slices(batch.column("text")) for s in shingle_sets(data, offsets, words)]
            if sets:
                values, n = np.unique(np.concatenate(sets), return_counts=True)
                often = n >= OFTEN
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"]
                )

    seen = documents.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    top = seen.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()  # at most FREQUENT numbers
    return top["h"].to_numpy().view(np.uint64)[::-1]


def shingle_table(documents: DataFrame, words: int, percent: int, last: np.ndarray) -> DataFrame:
    """Per row: size and key of its shingle set, its prefix and its bitmaps."""
    sorter = np.argsort(last)
    known = last[sorter]
    bits = np.uint64(64 - int(math.log2(SIGNATURE_WORDS * 64)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                n, keys, prefixes, signatures, wides = [], [], [], [], []
                for s in shingle_sets(data, offsets, words):
                    n.append(len(s))
                    keys.append(blake2b(s.tobytes(), digest_size=16).digest())
                    length = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                    order = s
                    if len(known) and len(s):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        place = np.where(known[at] == s, sorter[at] + 1, 0)
                        if place.any():
                            order = s[np.lexsort((s, place))]
                    prefixes.append(order[:length].view(np.int64))
                    mask = np.zeros(SIGNATURE_WORDS * 64, bool)
                    mask[(s >> bits).astype(np.int64)] = True
                    signatures.append(np.packbits(mask).view(np.int64))
                    wides.append(_wide(s))
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).cast(pa.int64()), pa.array(n, pa.int32()), pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefixes))),
                        pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * SIGNATURE_WORDS, pa.array(np.concatenate(signatures))),
                        pa.array(wides, pa.binary()),
                    ],
                    names=["doc_id", "n", "key", "prefix", "signature", "wide"],
                )

    return documents.select("doc_id", "text").mapInArrow(describe, _SETS)


def _wide(s: np.ndarray) -> bytes:
    """A bitmap of a set whose length is a power of two, ``WIDE_BITS`` to twice as many for each member."""
    if not len(s):
        return b""
    bits = max(8, 1 << (len(s) * WIDE_BITS - 1).bit_length())
    mask = np.zeros(bits, bool)
    mask[(s >> np.uint64(65 - bits.bit_length())).astype(np.int64)] = True
    return np.packbits(mask).tobytes()


def _may_link(n: int, one: bytes, m: int, two: bytes, percent: int) -> bool:
    """Whether two sets of these sizes and wide bitmaps can be similar enough."""
    if 100 * n < percent * m or 100 * m < percent * n:
        return False
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    if len(a) != len(b):
        # neighbouring bits of the longer one stand for one bit of the shorter one
        short = min(len(a), len(b))
        a, b = (x if len(x) == short else np.packbits(np.unpackbits(x).reshape(8 * short, -1).any(1)) for x in (a, b))
    bits = np.bitwise_count(np.stack([a, b, a & b])).sum(1, dtype=np.int64)
    most = int(bits[2]) + min(n - int(bits[0]), m - int(bits[1]))
    return most * (100 + percent) >= percent * (n + m)


def _possible(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that their wide bitmaps do not rule out."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    rows = table.select("doc_id", "n", "wide").join(broadcast_if_small(wanted), "doc_id", "left_semi")
    rows = rows.repartition("doc_id").dropDuplicates()  # dealt once, for both sides of the pairs
    one = rows.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("wide").alias("wide_a"))
    two = rows.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("wide").alias("wide_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "wide_a", "n_b", "wide_b")]
            may = [_may_link(*row, percent) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(may, pa.bool_()))

    met = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "wide_a", "n_b", "wide_b")
    return met.mapInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Each document with the size of its set and its component.

    Input: doc_id, text (more columns are ignored). Result, one row per input
    row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).
    Two documents link if 100 * intersection >= percent * union of their shingle
    sets. Null and empty texts and texts without words have no shingles and link
    with nothing. Rows of one doc_id are one document: its texts share a
    component. A null doc_id takes no part in links and has a null component.
    Without rows the result is empty.
    """
    table = materialize(shingle_table(documents, words, percent, frequent_shingles(documents, words)), "shingle-sets")
    full = table.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # rows of one key have the same set, hence the same size, prefix and bitmap
    same = [F.first(c).alias(c) for c in ("n", "prefix", "signature")]
    node = materialize(full.groupBy("key").agg(F.min("doc_id").alias("id"), *same), "set-nodes")
    # two nodes of one id differ by their keys, all others go without: keys are most of what the tokens would carry
    several = materialize(node.groupBy("id").agg(F.count("*").alias("_c")).filter("_c > 1").select("id", F.lit(True).alias("_several")), "several-nodes")
    marked = node.join(broadcast_if_small(several), "id", "left").withColumn("key", F.when(F.col("_several"), F.col("key")))
    named = full.select("doc_id", "key").join(node.select("id", "key"), "key").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    shared = materialize(_meetings(marked, percent), "meetings")
    # pass 1: every node against the anchors of its own size class and of the one below
    signs = node.select("id", "n", "signature")
    first = materialize(_alike(_anchor_pairs(shared, percent), signs, percent), "candidates")
    first = materialize(verified(_possible(first, table, percent), documents, words, percent), "links")
    known = components(first)
    # pass 2: shingles whose nodes are not connected yet
    second = materialize(_tree_pairs(shared.filter("members > 2"), marked, known, percent), "candidates")
    second = materialize(verified(_possible(second, table, percent), documents, words, percent), "links")
    found = components(named.unionByName(first).unionByName(second))
    out = table.join(found, table["doc_id"] == found["id"], "left")
    return out.select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _meetings(node: DataFrame, percent: int) -> DataFrame:
    """(token, id, key, n, s, members): the nodes of every prefix shingle that several nodes have.

    Of shingles with the same nodes, as in a passage that many documents share, one
    is kept. ``s`` is the size class: nodes that link are of one class or of neighbours.
    """
    # a count over the rows themselves deals them once; a join with the counts would deal the tokens again
    rows = node.select(F.explode("prefix").alias("token"), "id", "key", "n")
    counted = rows.withColumn("_c", F.count("*").over(W.partitionBy("token")))
    met = materialize(counted.filter("_c > 1").drop("_c"), "shared-shingles")
    # 128 bits and the count stand for the set of nodes; two nodes can have one id. The
    # literal comes first: behind the node it would only go on from one and the same hash
    bits = [F.bit_xor(F.xxhash64(F.lit(i), "id", "key")).alias(f"_h{i}") for i in range(2)]
    sets = met.groupBy("token").agg(F.count("*").alias("members"), *bits)
    kept = sets.groupBy("members", "_h0", "_h1").agg(F.min("token").alias("token")).select("token", "members")
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent))).cast("int")
    return met.join(kept, "token").select("token", "id", "key", "n", size_class.alias("s"), "members")


def _anchor_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a node and an anchor; of shingles with two nodes, all pairs."""
    anchors = shared.groupBy("token", "s").agg(F.min(F.struct("id", "n")).alias("anchor"))
    anchors = anchors.select("token", F.explode(F.array("s", F.col("s") + 1)).alias("s"), "anchor")
    pairs = shared.join(anchors, ["token", "s"]).filter(
        (F.col("id") != F.col("anchor.id"))
        & (100 * F.col("n") >= percent * F.col("anchor.n")) & (100 * F.col("anchor.n") >= percent * F.col("n"))
    )
    return pairs.select(F.col("id").alias("a"), F.col("anchor.id").alias("b")).distinct()


def _alike(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs that their bitmaps do not rule out."""
    spare = F.col("n") - F.aggregate("signature", F.lit(0), lambda acc, x: acc + F.bit_count(x))
    one = signs.select(F.col("id").alias("a"), F.col("n").alias("_n"), spare.alias("_spare"), F.col("signature").alias("_bits"))
    two = signs.select(F.col("id").alias("b"), "n", spare.alias("spare"), F.col("signature").alias("bits"))
    common = F.aggregate(F.zip_with("bits", "_bits", lambda x, y: x.bitwiseAND(y)), F.lit(0), lambda acc, x: acc + F.bit_count(x))
    may = (common + F.least("spare", "_spare")) * (100 + percent) >= percent * (F.col("n") + F.col("_n"))
    return pairs.join(one, "a").join(two, "b").filter(may).select("a", "b")


def _tree_pairs(shared: DataFrame, node: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that may link.

    A shingle with few nodes is one leaf, held against itself. The others are cut into
    leaves by size class, and only leaves whose summaries may link are held against each other.
    """
    labelled = shared.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("_all")).filter("lo < hi")
    mixed = labelled.join(open_.select("token", "_all"), "token").select("token", "id", "key", "n", "component", "s", "_all")
    mixed = materialize(mixed, "tree-rows")
    signs = node.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "signature")
    spare = F.col("n") - F.aggregate("signature", F.lit(0), lambda acc, x: acc + F.bit_count(x))

    def signed(rows: DataFrame) -> DataFrame:
        met = rows.join(signs, (rows["id"] == signs["_id"]) & rows["key"].eqNullSafe(signs["_key"]))
        return met.withColumn("spare", spare)

    fields = ["id", "n", "component", "spare", "signature"]
    cell = ["token", "s", "leaf", "_s", "_leaf"]
    # pairs of other sizes are ruled out inside the tree, so classes need not be told apart
    zeros = [F.lit(0).alias(c) for c in (*cell[1:], "side")]
    few = signed(mixed.filter(F.col("_all") <= LEAF)).select("token", *zeros, *fields)
    many = mixed.filter(F.col("_all") > LEAF)
    sizes = many.groupBy("token", "s").agg(F.count("*").alias("_c"))
    placed = many.join(sizes, ["token", "s"]).withColumn("leaf", F.pmod(F.xxhash64("id"), F.ceil(F.col("_c") / LEAF)).cast("int"))
    members = materialize(signed(placed).select("token", "s", "leaf", *fields), "tree-leaves")
    union = [F.bit_or(F.col("signature")[i]).alias(f"_w{i}") for i in range(SIGNATURE_WORDS)]
    leaves = members.groupBy("token", "s", "leaf").agg(
        F.min("n").alias("lo_n"), F.max("n").alias("hi_n"), F.max("spare").alias("spare"),
        F.min("component").alias("lo_c"), F.max("component").alias("hi_c"), *union,
    ).select("token", "s", "leaf", "lo_n", "hi_n", "spare", "lo_c", "hi_c", F.array(*[f"_w{i}" for i in range(SIGNATURE_WORDS)]).alias("bits"))
    leaves = materialize(leaves, "tree-summaries")
    other = leaves.select("token", *[F.col(c).alias("_" + c) for c in leaves.columns if c != "token"])
    other = other.withColumn("s", F.explode(F.array(F.col("_s"), F.col("_s") - 1)))
    common = F.aggregate(F.zip_with("bits", "_bits", lambda x, y: x.bitwiseAND(y)), F.lit(0), lambda acc, x: acc + F.bit_count(x))
    pairs = leaves.join(other, ["token", "s"]).filter(
        ((F.col("s") < F.col("_s")) | (F.col("leaf") <= F.col("_leaf")))
        & ~((F.col("lo_c") == F.col("hi_c")) & (F.col("_lo_c") == F.col("_hi_c")) & (F.col("lo_c") == F.col("_lo_c")))
        & (100 * F.col("hi_n") >= percent * F.col("_lo_n")) & (100 * F.col("_hi_n") >= percent * F.col("lo_n"))
        & ((common + F.least("spare", "_spare")) * (100 + percent) >= percent * (F.col("lo_n") + F.col("_lo_n")))
    ).select("token", "s", "leaf", "_s", "_leaf")
    pairs = materialize(pairs, "tree-pairs")
    left = pairs.join(members, ["token", "s", "leaf"]).select(*cell, F.lit(0).alias("side"), *fields)
    right_members = members.select("token", F.col("s").alias("_s"), F.col("leaf").alias("_leaf"), *fields)
    apart = (F.col("s") != F.col("_s")) | (F.col("leaf") != F.col("_leaf"))
    right = pairs.filter(apart).join(right_members, ["token", "_s", "_leaf"]).select(*cell, F.lit(1).alias("side"), *fields)
    cells = left.unionByName(right).unionByName(few).repartition(*cell).sortWithinPartitions(*cell, "side", "n", "id")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sides in _cells(batches):
            one = _Tree(*sides[0])
            same = key[1:3] == key[3:5]
            two = one if same else _Tree(*sides[1])
            a, b = one.pairs(two, percent)
            keep = a < b if same else a != b
            a, b = a[keep], b[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return cells.mapInArrow(follow, "a bigint, b bigint").distinct()


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[list[np.ndarray]]]]:
    """The members of each pair of leaves; both leaves are of bounded size."""
    names = ("token", "s", "leaf", "_s", "_leaf")
    now, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*names, "side")])
        values = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "n", "component", "spare")]
        signs = batch.column("signature").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, SIGNATURE_WORDS)
        turn = np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1
        for a, b in zip([0, *turn], [*turn, batch.num_rows], strict=True):
            key = tuple(keys[:5, a].tolist())
            if key != now:
                if held:
                    yield now, [_join(h) for h in held]
                now, held = key, [[], []]
            held[keys[5, a]].append([*(v[a:b] for v in values), signs[a:b]])
    if held:
        yield now, [_join(h) for h in held]


def _join(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    empty = [np.zeros(0, np.int64)] * 4 + [np.zeros((0, SIGNATURE_WORDS), np.uint64)]
    return [np.concatenate(column) for column in zip(*parts, strict=True)] if parts else empty


class _Tree:
    """A binary tree over members in order of size; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, ids, n, component, spare, signature):
        order = np.lexsort((ids, n))
        self.ids, self.n, self.component, self.spare = ids[order], n[order], component[order], spare[order]
        self.signature = signature[order]
        self.spans: list[tuple[int, int]] = [(0, len(ids))]
        self.children: list[tuple[int, int] | None] = []
        at = 0
        while at < len(self.spans):
            a, b = self.spans[at]
            if b - a <= LAST:
                self.children.append(None)
            else:
                half = (a + b) // 2
                self.children.append((len(self.spans), len(self.spans) + 1))
                self.spans += [(a, half), (half, b)]
            at += 1
        self.summary = [self._sum(a, b) for a, b in self.spans]

    def _sum(self, a: int, b: int) -> tuple:
        if a == b:
            return None
        c = self.component[a:b]
        return np.bitwise_or.reduce(self.signature[a:b]), self.n[a], self.n[b - 1], self.spare[a:b].max(), c.min(), c.max()

    def pairs(self, other: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of member pairs that no bound rules out."""
        out_a, out_b, waiting = [], [], [(0, 0)]
        while waiting:
            i, j = waiting.pop()
            if self is other and i > j:
                continue
            one, two = self.summary[i], other.summary[j]
            if one is None or two is None or one[4] == one[5] == two[4] == two[5]:
                continue
            if 100 * one[2] < percent * two[1] or 100 * two[2] < percent * one[1]:
                continue
            common = int(np.bitwise_count(one[0] & two[0]).sum()) + min(one[3], two[3])
            if common * (100 + percent) < percent * (one[1] + two[1]):
                continue
            left, right = self.children[i], other.children[j]
            if left or right:
                waiting += [(x, y) for x in (left or (i,)) for y in (right or (j,))]
                continue
            (a, b), (c, d) = self.spans[i], other.spans[j]
            n, m = self.n[a:b, None], other.n[None, c:d]
            bits = np.bitwise_count(self.signature[a:b, None] & other.signature[None, c:d]).sum(-1, dtype=np.int64)
            most = bits + np.minimum(self.spare[a:b, None], other.spare[None, c:d])
            may = (most * (100 + percent) >= percent * (n + m)) & (self.component[a:b, None] != other.component[None, c:d])
            rows, cols = np.nonzero(may)
            out_a.append(self.ids[a:b][rows])
            out_b.append(other.ids[c:d][cols])
            if self is other and i != j:  # both orders, the caller keeps one
                out_a.append(other.ids[c:d][cols])
                out_b.append(self.ids[a:b][rows])
        none = np.zeros(0, np.int64)
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def verified(pairs: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""
    pairs = materialize(pairs, "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # few ids are sent to the texts, so that no other text moves; many meet them by a shuffle
    texts = documents.select("doc_id", "text").join(broadcast_if_small(wanted), "doc_id", "left_semi")
    texts = texts.repartition("doc_id").dropDuplicates()  # dealt once, for both sides of the pairs
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = _sets(batch.column("text_b"), words)
            good = []
            for x, y in zip(_sets(batch.column("text_a"), words), right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint")


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in text_slices(column):
        yield from shingle_sets(data, offsets, words)


def distinct_documents(documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the one with the smallest doc_id; all columns are kept.

    Of several rows of that doc_id the one with the smallest text stays (null first,
    then by a digest of all columns); rows with a null doc_id all stay.
    """
    found = near_duplicates(documents, words, percent)
    heads = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_head")).distinct()
    kept = documents.join(heads, documents["doc_id"] == heads["_head"], "left_semi")
    row, order = F.struct(*documents.columns), F.struct("text", F.xxhash64(*documents.columns))
    kept = kept.groupBy("doc_id").agg(F.min_by(row, order).alias("_row")).select("_row.*")
    return kept.unionByName(documents.filter(F.col("doc_id").isNull()))
