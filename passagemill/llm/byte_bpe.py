"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap.

A pre-token that is a vocabulary entry is found in one probe: a displacement table
maps its hash to one of exactly as many places as the vocabulary has entries, and
the entry stored there is compared. Any other pre-token is merged: its bytes form
a linked list, the ranks of neighbouring pairs wait in a heap, and the lowest
(leftmost among equals) is joined until no pair is in the vocabulary. Pre-tokens
and their ids are remembered in a table of bounded size. The ranks file is read on the driver and sent along.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text in one slice, and pre-tokens (of at most so many characters)
#: that a task remembers between slices.
SLICE_CHARS = 1 << 20
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64
_MASK = (1 << 64) - 1


def _hash(token: bytes) -> int:
    return int.from_bytes(blake2b(token, digest_size=8).digest(), "little")


def _spot(h: int, displacement: int, n: int) -> int:
    x = (h ^ (displacement * 0x9E3779B97F4A7C15)) & _MASK
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return ((x ^ (x >> 29)) >> 8) % n


class PerfectHash:
    """Minimal perfect hash of the keys: as many places as keys, each key in its own."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.width = max(1, n // 4)
        self.displacement = [0] * self.width
        self.place: list[int] = [-1] * n  # the key's index at each place
        buckets: list[list[tuple[int, int]]] = [[] for _ in range(self.width)]
        for i, key in enumerate(keys):
            h = _hash(key)
            buckets[h % self.width].append((i, h))
        order = sorted(range(self.width), key=lambda b: -len(buckets[b]))
        free = 0
        for b in order:
            bucket = buckets[b]
            if len(bucket) == 1:  # the place itself is stored
                while free < n and self.place[free] >= 0:
                    free += 1
                self.place[free] = bucket[0][0]
                self.displacement[b] = -free - 1
                continue
            d = 0
            while bucket:
                spots = [_spot(h, d, n) for _, h in bucket]
                if len(set(spots)) == len(spots) and all(self.place[s] < 0 for s in spots):
                    for (i, _), s in zip(bucket, spots, strict=True):
                        self.place[s] = i
                    self.displacement[b] = d
                    break
                d += 1

    def __call__(self, key: bytes) -> int:
        """The only key index that ``key`` can be; the caller compares."""
        h = _hash(key)
        d = self.displacement[h % self.width]
        return self.place[-d - 1 if d < 0 else _spot(h, d, self.n)]


class _Known(dict):
    """Remembered ids of short pre-tokens; a missing one is encoded."""

    def __init__(self, coder: ByteBpe):
        super().__init__()
        self.coder = coder

    def __missing__(self, text: str) -> bytes:
        ids = self.coder.piece(text)
        if len(text) <= REMEMBERED_LENGTH:
            self[text] = ids
        return ids


class ByteBpe:
    """Encoder and decoder for a table of ranks (token bytes -> id) and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens = sorted(ranks, key=ranks.get)
        self.ids = [ranks[t] for t in self.tokens]
        self.ranks = ranks
        self.pattern = pattern
        self.whole = PerfectHash(self.tokens)
        size = max(self.ids, default=-1) + 1
        lengths = np.zeros(size, np.int64)
        lengths[self.ids] = [len(t) for t in self.tokens]
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(t for _, t in sorted(zip(self.ids, self.tokens, strict=True))), np.uint8)
        self._start()

    def _start(self) -> None:
        self.known, self.split = _Known(self), None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "split")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def piece(self, text: str) -> bytes:
        """The ids of one pre-token as little-endian 32-bit integers."""
        token = text.encode("utf-8", "surrogatepass")
        at = self.whole(token) if self.tokens else -1
        if at >= 0 and self.tokens[at] == token:
            return self.ids[at].to_bytes(4, "little")
        return array("I", self.merge(token)).tobytes()

    def merge(self, token: bytes) -> list[int]:
        n, ranks = len(token), self.ranks
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        stop = list(range(1, n + 1))  # where the part that starts here ends; 0: joined to its left
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(token[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if stop[i] else n
            if j >= n or stop[j] != end:
                continue  # one of the two has changed since
            stop[i], stop[j] = end, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(token[i:stop[k]])) is not None:
                    heapq.heappush(heap, (r, i, stop[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get(token[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i:stop[i]]])
            i = after[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; a remembered pre-token is looked up once."""
        if self.split is None:
            self.split = regex.compile(self.pattern).findall
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known.__getitem__
        return [np.frombuffer(b"".join(map(found, self.split(t))), np.uint32) for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        at = np.repeat(self.starts[ids] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    """A ranks file: one line per token, its bytes in base 64 and its id."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def encode(documents: DataFrame, ranks_path: str, pattern: str, *, decoded: bool = False) -> DataFrame:
    """Every row with ``ids`` (array of int): the ids of its whole text.

    All columns are kept, but one named ids (or decoded) is replaced. Null text is
    empty and has no ids. With ``decoded`` also the bytes that the ids decode to.
    Every pre-token is encoded on its own, without special tokens. Without rows
    the result is empty.
    """
    model = ByteBpe(read_ranks(ranks_path), pattern)
    kept = documents.drop("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE_CHARS):
                    size, b = size + len(texts[b]), b + 1
                ids = model.encode(texts[a:b])
                part = batch.slice(a, b - a)
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                columns = [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(flat))]
                names = [*part.schema.names, "ids"]
                if decoded:
                    columns.append(pa.array([model.decode(i) for i in ids], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                a = b

    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.BinaryType())] * decoded
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Every row with ``decoded``: the bytes of its ids, null where the ids are null."""
    model = ByteBpe(read_ranks(ranks_path), "")
    kept = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            out = [None if i is None else model.decode(np.array(i, np.int64)) for i in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(encoded: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
