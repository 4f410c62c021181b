"""Arrow columns as flat numpy arrays: text bytes, word hashes, vectors.

Everything works on slices of bounded size, so the memory of a task does not
depend on the number of rows in an Arrow batch; a single text that is longer
than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes in one slice.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words in lower-cased text: digits, a-z and everything beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[48:58] = LETTER[97:123] = LETTER[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters; no byte moves."""
    data = LOWER.take(data)
    if len(data) > 1:
        tail = data[1:]
        high = (data[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        tail[high] += 0x20
    return data


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets from 0) of consecutive rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a text's border."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    border = offsets[(offsets > 0) & (offsets < n)]
    start[border] = inside[border]
    end[border - 1] = inside[border - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial of its bytes, scrambled with its length."""
    n = len(data)
    if len(_powers[0]) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for at, base in enumerate((_BASE, _INVERSE)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _powers[at] = np.multiply.accumulate(powers)
    sums = np.zeros(n + 1, np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= _powers[0][:n]
    np.cumsum(values, out=sums[1:])
    plain = sums.take(ends)
    plain -= sums.take(starts)
    plain *= _powers[1].take(starts)
    plain ^= mix((ends - starts).astype(np.uint64))
    return mix(plain)


#: Positions in a word whose byte values are looked up; beyond it they are computed.
_PLACES = 64
_place_values = np.zeros((0, 256), np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty byte span: the sum of one scrambled value per (place, byte).

    The values have no algebraic relation to each other, so two different words, of
    whatever structure, get one hash with a probability of about 2^-64.
    """
    global _place_values
    if not len(_place_values):
        _place_values = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(_PLACES, 256)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    byte = data[np.repeat(starts, lengths) + place]
    near = place < _PLACES
    if near.all():
        values = _place_values[place, byte]
    else:
        spot = place.astype(np.uint64) * np.uint64(256) + byte + np.uint64(1)
        values = mix(spot * np.uint64(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(values, first) ^ mix(lengths.astype(np.uint64)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text
    with fewer words than a shingle has its whole word sequence as the only one;
    a text without words has none.
    """
    data = LOWER[data]
    starts, ends = runs(~SPACE[data], offsets)
    hashes = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    rolled = hashes
    for step in range(1, words):
        rolled = mix(rolled[:-1] * np.uint64(3) ^ hashes[step:]) if len(rolled) > 1 else rolled[:0]
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            yield np.unique(rolled[a:b - words + 1])
        elif b > a:
            whole = hashes[a:a + 1]
            for step in range(a + 1, b):
                whole = mix(whole * np.uint64(3) ^ hashes[step:step + 1])
            yield mix(whole + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column without nulls as rows of one matrix; shorter lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    """The matrix with zero columns added up to ``width``."""
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
