"""Approximate nearest neighbours: one navigable small-world graph per shard.

Rows with equal vectors become one node that carries its smallest ids; nodes are
dealt over shards of bounded size, so one very common vector is one node. A task
builds the graph of its shard: nodes get a top level by a fixed random number and
are inserted one batch after the other, each by a search of the graph built so
far; its links go to found nodes chosen for direction as well as distance and run
both ways, and every node can be reached from the entry. Levels are stored as flat
neighbour arrays (one int32 row of fixed width per node, -1 where empty). A search descends from
the top level and keeps the ``ef`` best on the lowest; all queries of a block
take their steps together. The results of the shards are merged by distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from passagemill.session import materialize

from .arrays import matrix, mix, widened
from .exact_search import usable

#: Nodes of a shard, links of a node (twice as many on the lowest level), breadth of a search.
SHARD_NODES = 16384
LINKS = 16
EF = 96
#: Breadth of the search that inserts a node, nearest nodes of its own batch, largest batch.
BUILD_EF = 48
PEERS = 16
INSERT_STEP = 256
#: Queries that take their steps together.
QUERY_STEP = 512
_LEVEL_KEY, _ORDER_KEY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x5DEECE66D)

INDEX_SCHEMA = (
    "shard int, n int, width int, entry int, ids array<array<bigint>>, vectors binary, "
    "level_nodes array<binary>, level_links array<binary>"
)


def build_index(vectors: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per shard: ids, vectors and flat neighbour arrays of every level.

    Every usable row is indexed. Equal vectors share a node; the node keeps their
    ``k + 1`` smallest ids, which is all that a search for k rows can return of
    them. Null, zero and non-finite vectors and null ids are left out.
    """
    pick = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("v")
    )
    rows = pick.filter(F.col("id").isNotNull() & usable("v") & F.exists("v", lambda x: x != 0)).dropDuplicates()
    smallest = W.partitionBy("v").orderBy("id")
    nodes = materialize(
        rows.withColumn("_r", F.row_number().over(smallest))
        .filter(F.col("_r") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids")),
        "hnsw-nodes",
    )
    shards = max(1, math.ceil(nodes.count() / SHARD_NODES))
    dealt = (
        nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.col("ids")[0])
    )
    return materialize(dealt.mapInArrow(_build_shards, INDEX_SCHEMA), "hnsw-index")


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", ef: int = EF) -> DataFrame:
    """The k nearest rows found for every query, by Euclidean distance.

    Result: query_id, rank (from 1), vec_id, score (the distance of the original
    vectors in double precision); nearest first, ties to the smaller id. Rows of
    the query's own id are no candidates. Queries with null, zero or non-finite
    vectors or null ids get no rows; equal query rows are asked once; without an
    index or queries the result is empty. Missing components count as zero.
    """
    pick = queries.select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("v")
    )
    asked = pick.filter(F.col("id").isNotNull() & usable("v") & F.exists("v", lambda x: x != 0)).dropDuplicates()
    shards = index.count()  # one row each
    here = "shard int, kind int, id bigint, v array<double>, graph struct<%s>" % ", ".join(
        ": ".join(part.split(" ", 1)) for part in INDEX_SCHEMA.split(", ")
    )
    none = F.lit(None).cast(here.rsplit("graph ", 1)[1])
    left = index.select(
        "shard", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("array<double>").alias("v"), F.struct(*index.columns).alias("graph"),
    )
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1)))).select(
        F.col("shard").cast("int").alias("shard"), F.lit(1).alias("kind"), "id", "v", none.alias("graph")
    )
    meet = left.unionByName(right).repartitionById(max(shards, 1), "shard").sortWithinPartitions("shard", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search_shards(batches, k, ef)

    found = meet.mapInArrow(search, "query_id bigint, q_no bigint, vec_id bigint, score double")
    best = W.partitionBy("query_id", "q_no").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def levels_of(ids: np.ndarray) -> np.ndarray:
    """The top level of each node: geometric with mean spacing ``LINKS``, fixed by its id."""
    u = (mix(ids.astype(np.int64).view(np.uint64) ^ _LEVEL_KEY) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-18)) / math.log(LINKS)).astype(np.int64)


def choose(vectors: np.ndarray, near: np.ndarray, dist: np.ndarray, links: int) -> np.ndarray:
    """Which candidates of each row become neighbours; ``near`` is sorted by ``dist``, -1 where empty.

    A candidate is taken if it is nearer to the node than to all neighbours taken
    before it; of the places up to half the links that then are free, the nearest others get them.
    """
    points = vectors[np.maximum(near, 0)]
    lengths = (points * points).sum(-1)
    between = lengths[:, :, None] + lengths[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    closer = between < dist[:, :, None]
    real, taken, count = near >= 0, np.zeros(near.shape, bool), np.zeros(len(near), np.int64)
    for j in range(near.shape[1]):
        taken[:, j] = real[:, j] & ~(taken & closer[:, j]).any(1) & (count < links)
        count += taken[:, j]
    for j in range(near.shape[1]):
        more = real[:, j] & ~taken[:, j] & (count < links // 2)
        taken[:, j] |= more
        count += more
    return taken


def _sorted_by_distance(near: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)


def _packed(near: np.ndarray, taken: np.ndarray, width: int) -> np.ndarray:
    """The taken candidates of each row in order, then -1."""
    out = np.full((len(near), width), -1, np.int32)
    rows, cols = np.nonzero(taken)
    out[rows, (np.cumsum(taken, 1) - 1)[rows, cols]] = near[rows, cols]
    return out


def build_graph(vectors: np.ndarray, top: np.ndarray, order: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Members and their links on every level, by inserting nodes with a search of the graph so far.

    Levels are built from the highest down; ``order`` holds all nodes, those of
    higher levels first. Nodes are inserted in batches that double with the graph up to
    ``INSERT_STEP``: each node searches the nodes inserted before its batch, starting
    from where the levels above lead, and meets the others of its batch directly.
    Links run both ways; a node with too many keeps those that ``choose`` takes.
    At last nodes that no links lead to from the entry get a link from the
    nearest node that is reached, so every node can be found.
    """
    base = vectors.astype(np.float32)
    n, levels = len(base), []
    for level in range(int(top.max()), -1, -1):
        members = order[top[order] >= level]
        width = LINKS * (2 if level == 0 else 1)
        links = np.full((n, width), -1, np.int32)
        inside = np.zeros(n, bool)
        done = 0
        while done < len(members):
            batch = members[done:done + min(max(done, 32), INSERT_STEP)]
            if done:
                at = np.full((len(batch), 1), order[0], np.int64)
                for full in levels:
                    at = _Graph._walk(base, full, base[batch], at, 4)
                at = np.where(inside[at] & (at >= 0) & (at != order[0]), at, -1)
                start = np.concatenate([np.full((len(batch), 1), order[0], np.int64), at], 1)
                near = _Graph._walk(base, links, base[batch], start, BUILD_EF)
            else:
                near = np.full((len(batch), 0), -1, np.int64)
            far = _squared(base[batch], base[batch])
            np.fill_diagonal(far, np.inf)
            some = min(PEERS, len(batch) - 1)
            peers = batch[np.argsort(far, axis=1, kind="stable")[:, :some]]
            near = np.concatenate([near, peers], 1)
            _link(base, links, batch, near)
            inside[batch] = True
            done += len(batch)
        levels.append(_reachable(base, links, members))
    levels.reverse()
    return [(np.sort(m := order[top[order] >= level]).astype(np.int32), full[np.sort(m)]) for level, full in enumerate(levels)]


def _link(base: np.ndarray, links: np.ndarray, batch: np.ndarray, near: np.ndarray) -> None:
    """Link the nodes of a batch with some of their candidates, both ways."""
    width = links.shape[1]
    for a in range(0, len(batch), 128):
        nodes, some = batch[a:a + 128], near[a:a + 128]
        dist = ((base[np.maximum(some, 0)] - base[nodes][:, None, :]) ** 2).sum(2)
        some, dist = _sorted_by_distance(some, np.where(some >= 0, dist, np.inf))
        links[nodes] = _packed(some, choose(base, some, dist, width), width)
    one, at = np.nonzero(links[batch] >= 0)
    to, source = links[batch][one, at].astype(np.int64), batch[one]
    fresh = ~(links[to] == source[:, None]).any(1)
    to, source = to[fresh], source[fresh]
    dist = ((base[to] - base[source]) ** 2).sum(1)
    by = np.lexsort((source, dist, to))
    to, source = to[by], source[by]
    place = np.arange(len(to)) - np.searchsorted(to, to)
    fits = place < 2 * width  # farther ones still have their own link to the node
    to, source, place = to[fits], source[fits], place[fits]
    targets, row = np.unique(to, return_inverse=True)
    for a in range(0, len(targets), 128):
        nodes, here = targets[a:a + 128], (row >= a) & (row < a + 128)
        added = np.full((len(nodes), int(place[here].max()) + 1), -1, np.int64)
        added[row[here] - a, place[here]] = source[here]
        some = np.concatenate([links[nodes], added], 1)
        dist = ((base[np.maximum(some, 0)] - base[nodes][:, None, :]) ** 2).sum(2)
        some, dist = _sorted_by_distance(some, np.where(some >= 0, dist, np.inf))
        few = (some >= 0).sum(1) <= width
        taken = choose(base, some, dist, width)
        taken[few] = some[few] >= 0
        links[nodes] = _packed(some, taken, width)


def _spread(links: np.ndarray, reached: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mark all nodes that links lead to from ``start``; returns the newly marked."""
    fresh, found = start, [start]
    reached[start] = True
    while len(fresh):
        to = np.unique(links[fresh])
        fresh = to[to >= 0]
        fresh = fresh[~reached[fresh]]
        reached[fresh] = True
        found.append(fresh)
    return np.concatenate(found)


def _reachable(base: np.ndarray, links: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The links with further ones where the first member cannot reach all; the array may grow wider."""
    reached = np.zeros(len(base), bool)
    fresh = _spread(links, reached, members[:1])
    left = members[~reached[members]]
    nearest, dist = np.zeros(len(left), np.int64), np.full(len(left), np.inf)
    while len(left):
        for a in range(0, len(fresh), 1024):  # nodes reached since the last turn may be nearer
            far = _squared(base[left], base[fresh[a:a + 1024]])
            best = far.argmin(1)
            least = far[np.arange(len(left)), best]
            nearest, dist = np.where(least < dist, fresh[a + best], nearest), np.minimum(dist, least)
        at = int(dist.argmin())
        for one, two in ((nearest[at], left[at]), (left[at], nearest[at])):
            if two in links[one]:
                continue
            if links[one, -1] >= 0:
                links = np.concatenate([links, np.full((len(links), 4), -1, np.int32)], 1)
            links[one, np.argmax(links[one] < 0)] = two
        fresh = _spread(links, reached, left[at:at + 1])
        keep = ~reached[left]
        left, nearest, dist = left[keep], nearest[keep], dist[keep]
    return links


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, ids, vectors in _by_shard(batches):
        first = np.array([i[0] for i in ids], np.int64)
        top = levels_of(first)
        # a fixed random order, as neighbouring ids may lie near each other
        order = np.lexsort((mix(first.view(np.uint64) ^ _ORDER_KEY), -top))
        levels = build_graph(vectors, top, order)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([vectors.shape[1]], pa.int32()),
                pa.array([int(order[0])], pa.int32()), pa.array([ids], pa.list_(pa.list_(pa.int64()))), pa.array([vectors.tobytes()], pa.binary()),
                pa.array([[m.tobytes() for m, _ in levels]], pa.list_(pa.binary())), pa.array([[x.tobytes() for _, x in levels]], pa.list_(pa.binary())),
            ],
            names=["shard", "n", "width", "entry", "ids", "vectors", "level_nodes", "level_links"],
        )


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray]]:
    """The nodes of each shard; a shard's size is bounded by ``SHARD_NODES`` on average."""
    key, ids, rows = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        turn = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip([0, *turn], [*turn, batch.num_rows], strict=True):
            if shard[a] != key and ids:
                yield int(key), ids, _joined(rows)
                ids, rows = [], []
            key = shard[a]
            ids += batch.column("ids").slice(a, b - a).to_pylist()
            rows.append(matrix(batch.column("v").slice(a, b - a)))
    if ids:
        yield int(key), ids, _joined(rows)


def _joined(rows: list[np.ndarray]) -> np.ndarray:
    width = max(r.shape[1] for r in rows)
    return np.concatenate([widened(r, width) for r in rows])


class _Graph:
    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.vectors = np.frombuffer(row["vectors"]).reshape(row["n"], row["width"])
        self.entry = row["entry"]
        self.levels = []
        for nodes, links in zip(row["level_nodes"], row["level_links"], strict=True):
            nodes = np.frombuffer(nodes, np.int32)
            links = np.frombuffer(links, np.int32).reshape(len(nodes), -1)
            full = np.full((row["n"], links.shape[1]), -1, np.int32)
            full[nodes] = links
            self.levels.append(full)

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Up to ``ef`` nodes for each query, -1 where fewer were found."""
        base = widened(self.vectors, q.shape[1])
        q = widened(q, base.shape[1])
        at = np.full((len(q), 1), self.entry, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            at = self._walk(base, self.levels[level], q, at, ef if level == 0 else 4)
        return at

    @staticmethod
    def _walk(base: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, ef: int) -> np.ndarray:
        """Expand the nearest open node of every query until none of its best ``ef`` is open."""
        m, n = len(q), len(base)
        seen = np.zeros((m, n), bool)
        best = np.full((m, ef), -1, np.int64)
        dist = np.full((m, ef), np.inf)
        open_ = np.zeros((m, ef), bool)
        width = min(start.shape[1], ef)
        best[:, :width] = start[:, :width]
        here = best >= 0
        rows, cols = np.nonzero(here)
        dist[rows, cols] = ((base[best[rows, cols]] - q[rows]) ** 2).sum(1)
        seen[rows, best[rows, cols]] = True
        open_[here] = True
        active = np.arange(m)
        while len(active):
            waiting = np.where(open_[active], dist[active], np.inf)
            pick = waiting.argmin(1)
            more = np.isfinite(waiting[np.arange(len(active)), pick])
            active, pick = active[more], pick[more]
            if not len(active):
                break
            open_[active, pick] = False
            near = links[best[active, pick]].astype(np.int64)
            fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            rows, cols = np.nonzero(fresh)
            far = np.full(near.shape, np.inf)
            nodes = near[rows, cols]
            far[rows, cols] = ((base[nodes] - q[active[rows]]) ** 2).sum(1)
            seen[active[rows], nodes] = True
            all_dist = np.concatenate([dist[active], far], 1)
            all_node = np.concatenate([best[active], np.where(fresh, near, -1)], 1)
            all_open = np.concatenate([open_[active], fresh], 1)
            keep = np.argpartition(all_dist, ef - 1, axis=1)[:, :ef]
            dist[active] = np.take_along_axis(all_dist, keep, 1)
            best[active] = np.take_along_axis(all_node, keep, 1)
            open_[active] = np.take_along_axis(all_open, keep, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(np.where(np.isfinite(dist), best, -1), order, 1)


def _search_shards(batches: Iterator[pa.RecordBatch], k: int, ef: int) -> Iterator[pa.RecordBatch]:
    graph, shard_now = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        turn = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip([0, *turn], [*turn, batch.num_rows], strict=True):
            if kind[a] == 0:
                graph, shard_now = _Graph(batch.column("graph")[int(a)].as_py()), shard[a]
                continue
            if graph is None or shard_now != shard[a]:
                continue  # a shard without nodes
            ids = batch.column("id").slice(a, b - a).to_numpy(zero_copy_only=False)
            rows = matrix(batch.column("v").slice(a, b - a))
            for c in range(0, len(ids), QUERY_STEP):
                yield _answers(graph, ids[c:c + QUERY_STEP], rows[c:c + QUERY_STEP], k, max(ef, k + 1))


def _answers(graph: _Graph, ids: np.ndarray, q: np.ndarray, k: int, ef: int) -> pa.RecordBatch:
    nodes = graph.search(q, ef)
    base = widened(graph.vectors, q.shape[1])
    asked = widened(q, base.shape[1])
    number = _bits(q)
    out: list[list] = [[], [], [], []]
    for i, row in enumerate(nodes):
        row = row[row >= 0]
        score = np.sqrt(((base[row] - asked[i]) ** 2).sum(1))
        rows = sorted(
            (float(s), v) for s, node in zip(score, row, strict=True) for v in graph.ids[node] if v != ids[i]
        )[:k]
        for s, v in rows:
            out[0].append(int(ids[i]))
            out[1].append(int(number[i]))
            out[2].append(v)
            out[3].append(s)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(o, t) for o, t in zip(out, types, strict=True)], names=["query_id", "q_no", "vec_id", "score"]
    )


def _bits(q: np.ndarray) -> np.ndarray:
    """A number that tells different vectors of one id apart."""
    bits = np.ascontiguousarray(q).view(np.uint64)
    weights = np.uint64(0x9E3779B97F4A7C15) * (np.arange(q.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    return (bits * weights).sum(1, dtype=np.uint64).view(np.int64)
