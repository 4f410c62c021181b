"""Column expressions over vectors, and the built-in hashed-word embedding."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, tokens

#: Rows of an Arrow batch whose words are handled in one step inside a task.
STEP_ROWS = 1024


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision, inside the JVM."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def vector_norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def has_dimension(vector: Column | str, dim: int) -> Column:
    return F.coalesce(F.size(_col(vector)) == dim, F.lit(False))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_runs(values: Column) -> Column:
    """Distinct values of an array with their counts, ascending; null when empty.

    Sorting and reading off the ends of equal runs costs n log n per row and
    needs no shuffle, unlike explode and group.
    """

    def run_ends(s: Column) -> Column:
        n = F.size(s)
        return F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == n) | (F.get(s, i - 1) != F.get(s, i)),
        )

    def runs(s: Column, ends: Column) -> Column:
        return F.transform(
            ends,
            lambda e, j: F.struct(
                F.get(s, e - 1).alias("value"),
                (e - F.when(j > 0, F.get(ends, j - 1)).otherwise(F.lit(0))).alias("n"),
            ),
        )

    def counted(s: Column) -> Column:
        return F.when(F.size(s) > 0, _let(run_ends(s), lambda ends: runs(s, ends)))

    return _let(F.sort_array(values), counted)


def hashed_word_counts(text: Column | str, dim: int) -> Column:
    """Token counts per hash bucket, ascending by bucket; null without tokens.

    The bucket of a token is the leading 32 bits of its MD5 modulo ``dim``.
    """
    buckets = F.transform(
        tokens(text),
        lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dim,
    )
    return count_runs(buckets)


def counts_norm(counts: Column | str) -> Column:
    squares = F.aggregate(
        _col(counts), F.lit(0).cast("bigint"), lambda s, p: s + p["n"].cast("bigint") * p["n"]
    )
    return F.sqrt(squares.cast("double"))


def weighted_counts(text: Column | str, dim: int) -> Column:
    """``struct<counts, norm>``: bucket counts of a text with their Euclidean norm."""
    return _let(
        hashed_word_counts(text, dim),
        lambda c: F.struct(c.alias("counts"), counts_norm(c).alias("norm")),
    )


def dense_from_counts(counts: Column | str, dim: int) -> Column:
    """Unit vector of the bucket counts; the zero vector for null counts."""
    c = _col(counts)

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def filled(norm: Column) -> Column:
        def stretch(p: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(c, j - 1)["value"]).otherwise(F.lit(-1))
            weight = (p["n"].cast("double") / norm).cast("float")
            return F.concat(zeros(p["value"] - before - 1), F.array(weight))

        tail = zeros(F.lit(dim - 1) - F.element_at(c, -1)["value"])
        return F.concat(F.flatten(F.transform(c, stretch)), tail)

    return F.when(F.size(c) > 0, _let(counts_norm(c), filled)).otherwise(zero_vector(dim))


def _in_steps(make: Callable[[pa.Array], pa.Array], words: pa.Array) -> pa.Array:
    """``make`` over slices of a batch, so that what it holds beside the result is bounded."""
    if not len(words):
        return make(words)
    return pa.concat_arrays([make(words.slice(at, STEP_ROWS)) for at in range(0, len(words), STEP_ROWS)])


def _numbered_words(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a list column, the row of every word, and its place among them."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    encoded = words.flatten().dictionary_encode()
    places = encoded.indices.to_numpy(zero_copy_only=False)
    return encoded.dictionary, np.repeat(np.arange(len(words)), sizes), places


def word_counts(words: Column | str) -> Column:
    """``count_runs`` of an array of words: words are compared once per batch."""

    def counted(part: pa.Array) -> pa.Array:
        distinct, rows, places = _numbered_words(part)
        order = pc.sort_indices(distinct)
        rank = np.empty(len(distinct), np.int64)
        rank[order.to_numpy()] = np.arange(len(distinct))
        entries, n = np.unique(rows * len(distinct) + rank[places], return_counts=True)
        heads, ranks = np.divmod(entries, max(len(distinct), 1))
        offsets = np.searchsorted(heads, np.arange(len(part) + 1))
        empty = np.r_[offsets[1:] == offsets[:-1], False]
        runs = pa.StructArray.from_arrays(
            [distinct.take(order).take(pa.array(ranks)), pa.array(n, pa.int32())], ["value", "n"]
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=empty), runs)

    @F.arrow_udf("array<struct<value: string, n: int>>")
    def counts(batch: pa.Array) -> pa.Array:
        return _in_steps(counted, batch)

    return counts(_col(words))


def hash_embedding(text: Column | str, dim: int) -> Column:
    """Built-in embedding of a text: ``dense_from_counts`` of its ``hashed_word_counts``."""
    return hashed_words(tokens(text), dim)


def hashed_words(words: Column | str, dim: int) -> Column:
    """``hash_embedding`` of a text's tokens: hashed once per batch and counted in a matrix."""

    def embedded(rows: np.ndarray, buckets: np.ndarray, n_rows: int) -> np.ndarray:
        counts = np.bincount(rows * dim + buckets, minlength=n_rows * dim).reshape(-1, dim)
        norms = np.sqrt((counts * counts).sum(axis=1).astype(np.float64))
        norms[norms == 0] = 1.0
        return (counts / norms[:, None]).astype(np.float32).ravel()

    @F.arrow_udf("array<float>")
    def embed(batch: pa.Array) -> pa.Array:
        distinct, rows, places = _numbered_words(batch)
        digests = [hashlib.md5(w, usedforsecurity=False).digest() for w in distinct.cast(pa.binary()).to_pylist()]
        buckets = (np.frombuffer(b"".join(digests), ">u4")[::4].astype(np.int64) % dim)[places]
        values = np.empty(len(batch) * dim, np.float32)
        for low in range(0, len(batch), STEP_ROWS):
            high = min(low + STEP_ROWS, len(batch))
            a, z = np.searchsorted(rows, [low, high])
            values[low * dim:high * dim] = embedded(rows[a:z] - low, buckets[a:z], high - low)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * dim, pa.int32()), pa.array(values))

    return embed(_col(words))
