"""Token ids in compressed files: a range coder driven by mixed context models.

File format. A file set is a Parquet folder; a row is a segment: consecutive
documents in order, with ``shard`` and ``segment`` giving the order of rows. The
payload of a segment holds, behind a magic word, its documents' ids and token
counts, its starting model, a CRC-32 of both, and then its blocks. Every ``BLOCK_IDS``
ids are a block that is coded from the starting model on and has its own CRC-32 (of its
ids and its code), so a damaged block is noticed and no block needs another one.

Model of a block. Ids are numbered by frequency inside the segment. Order 2 and order
1 each predict one id from the last two ids and the last id; their chance to be
right is learned per level of confidence, and the two are mixed by a weight that
follows whichever predicts better. What they miss is coded by order 0, the frequencies
of all ids. The starting model holds these frequencies and what orders 1 and 2 should
expect at first, learned from blocks spread over the segment. All chances
are integers, so the reader repeats the writer's steps exactly. Blocks of a segment
are coded side by side, one numpy step for one id of each.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import lowered, runs

#: Ids in a block, ids after which a segment ends at the next document.
BLOCK_IDS = 2048
SEGMENT_IDS = 1 << 23
#: Ids from which orders 1 and 2 learn what to expect at first.
START_IDS = 1 << 18
#: Encoded words that a task remembers, characters of text encoded at a time.
REMEMBERED = 600_000
SLICE_CHARS = 1 << 22
#: Words encoded as one text.
LINE_WORDS = 32

_MAGIC = b"TIDS3\0"
_HEAD = "<QQQQI"  # documents, blocks, bytes of the index and of the starting model, checksum
_BLOCK = "<III"  # ids, bytes of the code, checksum
_CELLS = 4096  # contexts of a block and order
_LEVELS = 8  # of confidence, the lowest bits of a cell; a cell of -1 is empty
_TOP, _BOTTOM, _WORD = np.uint64(1 << 48), np.uint64(1 << 44), np.uint64(16)
_SCHEMA = "shard int, segment int, documents bigint, ids bigint, payload binary"


class _Start:
    """The starting model of a segment: ids by frequency, order-0 chances, first cells of orders 2 and 1."""

    def __init__(self, values: np.ndarray, chances: np.ndarray, cells2: np.ndarray, cells1: np.ndarray):
        self.values, self.chances, self.cells2, self.cells1 = values, chances, cells2, cells1
        self.cdf = np.concatenate([[0], np.cumsum(chances, dtype=np.uint64)]).astype(np.uint64)
        self.bits = np.uint64(int(self.cdf[-1]).bit_length() - 1)  # chances sum to a power of two

    @classmethod
    def learn(cls, ids: np.ndarray) -> tuple[_Start, np.ndarray]:
        """The starting model, and the ids as numbers by frequency."""
        if ids.max() < 1 << 22:
            seen = np.bincount(ids)
            values = np.flatnonzero(seen).astype(np.uint32)
            seen, inverse = seen[values], ids
            slot = values
        else:
            values, inverse, seen = np.unique(ids, return_inverse=True, return_counts=True)
            slot = np.arange(len(values))
        order = np.argsort(-seen, kind="stable")
        place = np.empty(int(slot[-1]) + 1, np.int32)
        place[slot[order]] = np.arange(len(order))
        kinds, total = len(values), 1 << max(16, len(values).bit_length() + 2)
        chances = 1 + seen[order] * (total - kinds) // len(ids)
        chances[0] += total - chances.sum()
        numbers = place[inverse]
        step = max(1, len(numbers) // START_IDS)
        some = numbers[:len(numbers) // BLOCK_IDS * BLOCK_IDS].reshape(-1, BLOCK_IDS)[::step].astype(np.int64)
        last, before, now = some[:, 1:-1].ravel(), some[:, :-2].ravel(), some[:, 2:].ravel()
        return cls(values[order], chances, _expected(_context2(last, before), now), _expected(last & (_CELLS - 1), now)), numbers

    def pack(self) -> bytes:
        raw = self.values.astype("<u4").tobytes() + self.chances.astype("<u4").tobytes()
        return struct.pack("<I", len(self.values)) + zlib.compress(raw + self.cells2.tobytes() + self.cells1.tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> _Start:
        kinds, raw = struct.unpack_from("<I", data)[0], zlib.decompress(data[4:])
        values, chances = np.frombuffer(raw, "<u4", kinds), np.frombuffer(raw, "<u4", kinds, 4 * kinds)
        cells = np.frombuffer(raw, "<i4", 2 * _CELLS, 8 * kinds)
        return cls(values, chances, cells[:_CELLS], cells[_CELLS:])


def _context2(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    return (last * 1061 + before * 31) & (_CELLS - 1)


def _expected(context: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Per context the number that most often follows, with its level; -1 where there is too little to learn."""
    cells = np.full(_CELLS, -1, np.int32)
    pairs, seen = np.unique(context << 32 | now, return_counts=True)
    context, now = pairs >> 32, pairs & 0xFFFFFFFF
    all_seen = np.bincount(context, seen, minlength=_CELLS)
    order = np.lexsort((now, -seen, context))
    order = order[np.append(True, np.diff(context[order]) > 0)] if len(order) else order
    order = order[seen[order] > 3]
    level = np.minimum(seen[order] * _LEVELS // all_seen[context[order]].astype(np.int64), _LEVELS - 1)
    cells[context[order]] = now[order] * _LEVELS + level
    return cells


class _Models:
    """The models of all blocks of a segment: rows for order 2 and order 1, cells lie block after block."""

    def __init__(self, start: _Start, blocks: int):
        rows = np.arange(2 * blocks).reshape(2, blocks)
        self.off, self.off_level = rows * _CELLS, rows * _LEVELS
        self.cells = np.concatenate([np.tile(start.cells2, blocks), np.tile(start.cells1, blocks)])
        self.right = np.tile(np.arange(_LEVELS, dtype=np.int32) * 480 + 240, 2 * blocks)
        self.weights = np.full((2, blocks), 128, np.int32)  # add up to 256
        self.context = np.zeros((2, blocks), np.int64)
        self.last = np.zeros(blocks, np.int64)

    def predict(self, n: int) -> None:
        """For the first n blocks: what orders 2 and 1 expect, and where their shares of 4096 end."""
        self.n = n
        self.at = self.context[:, :n] + self.off[:, :n]
        self.cell = self.cells.take(self.at)
        self.ids, self.sure, self.used = self.cell >> 3, self.cell & 7, self.cell >= 0
        self.level = self.sure + self.off_level[:, :n]
        self.chance = self.right.take(self.level)
        parts = self.chance * self.weights[:, :n]
        parts >>= 8
        parts *= self.used
        both = parts[1] * (self.ids[0] == self.ids[1])
        self.one = np.maximum(parts[0] + both, 1)
        self.two = self.one + np.maximum(parts[1] - both, 1)

    def update(self, number: np.ndarray, hit: np.ndarray) -> None:
        """After the next number of each block; ``hit`` are the orders that expected it."""
        n, cell, sure = self.n, self.cell, self.sure
        chance = hit * np.int32(4000)
        chance -= self.chance
        chance >>= 5
        chance += self.chance
        self.right[self.level] = chance
        self.used &= sure > 1
        missed = np.where(self.used, cell - sure + (sure >> 1), (number << 3).astype(np.int32))
        self.cells[self.at] = np.where(hit, cell + (sure < 7), missed)
        rows = (hit[0] != hit[1]).nonzero()[0]
        w = self.weights[0, rows]
        w += np.where(hit[0, rows], (250 - w) >> 5, -((w - 6) >> 5))
        self.weights[0, rows], self.weights[1, rows] = w, 256 - w
        self.context[0, :n] = _context2(number, self.last[:n])
        self.context[1, :n] = number & (_CELLS - 1)
        self.last[:n] = number


def _settle(low: np.ndarray, span: np.ndarray, take) -> None:
    """Shift out the leading 16 bits that no later step can change."""
    moves = low ^ (low + span)
    rows = ((moves < _TOP) | (span < _BOTTOM)).nonzero()[0]
    lo, sp, moves = low[rows], span[rows], moves[rows]
    while len(rows):
        tight = (moves >= _TOP).nonzero()[0]  # the interval lies across a border: keep the part below it
        if len(tight):
            sp[tight] = (~lo[tight] + np.uint64(1)) & (_BOTTOM - np.uint64(1))
        take(rows, lo >> np.uint64(48))
        lo <<= _WORD
        sp <<= _WORD
        low[rows], span[rows] = lo, sp
        moves = lo ^ (lo + sp)
        more = ((moves < _TOP) | (sp < _BOTTOM)).nonzero()[0]
        rows, lo, sp, moves = rows[more], lo[more], sp[more], moves[more]


def _write_blocks(numbers: np.ndarray, lengths: np.ndarray, start: _Start) -> list[bytes]:
    """Code the numbers of every block (rows, longest block first)."""
    blocks, most = len(numbers), int(lengths[0])
    models = _Models(start, blocks)
    low = np.zeros(blocks, np.uint64)
    span = np.full(blocks, np.uint64(0xFFFFFFFFFFFFFFFF))
    width = most * 4 + 8
    out = np.zeros(blocks * width, ">u2")
    begin = np.arange(blocks) * width
    end = begin.copy()

    def take(rows: np.ndarray, top: np.ndarray) -> None:
        at = end[rows]
        out[at] = top
        end[rows] = at + 1

    columns = np.ascontiguousarray(numbers.T)
    active = blocks
    for t in range(most):
        while lengths[active - 1] <= t:
            active -= 1
        models.predict(active)
        number = columns[t, :active].astype(np.int64)
        lo, sp = low[:active], span[:active]
        hit = models.ids == number
        is2 = hit[0]
        missed = ~(is2 | hit[1])
        first = np.where(is2, 0, np.where(missed, models.two, models.one))
        stop = np.where(is2, models.one, np.where(missed, 4096, models.two))
        unit = sp >> np.uint64(12)
        lo += unit * first.astype(np.uint64)
        sp[:] = unit * (stop - first).astype(np.uint64)
        m = missed.nonzero()[0]
        unit = sp[m] >> start.bits
        lo[m] += unit * start.cdf[number[m]]
        sp[m] = unit * start.chances[number[m]].astype(np.uint64)
        models.update(number, hit)
        _settle(lo, sp, take)
    every = np.arange(blocks)
    low += np.uint64((1 << 32) - 1)  # what the reader takes for missing words are zeros
    for _ in range(2):
        take(every, low >> np.uint64(48))
        low <<= _WORD
    return [out[a:b].tobytes() for a, b in zip(begin, end, strict=True)]


def _read_blocks(coded: list[bytes], lengths: np.ndarray, start: _Start) -> np.ndarray:
    """The numbers of every block; the longest block comes first."""
    blocks, most = len(coded), int(lengths[0])
    models = _Models(start, blocks)
    slots = np.repeat(np.arange(len(start.chances)), start.chances)
    width = max(map(len, coded)) // 2 + 8
    data = np.zeros((blocks, width), np.uint64)
    for b, c in enumerate(coded):
        data[b, :len(c) // 2] = np.frombuffer(c, ">u2", len(c) // 2)
    code = np.zeros(blocks, np.uint64)
    for k in range(4):
        code = code << _WORD | data[:, k]
    data, at = data.ravel(), np.arange(blocks) * width + 4
    end = np.arange(1, blocks + 1) * width - 1
    low = np.zeros(blocks, np.uint64)
    span = np.full(blocks, np.uint64(0xFFFFFFFFFFFFFFFF))
    columns = np.zeros((most, blocks), np.int32)

    def take(rows: np.ndarray, _) -> None:
        here = at[rows]
        code[rows] = (code[rows] << _WORD) | data[np.minimum(here, end[rows])]  # damaged code may end too early
        at[rows] = here + 1

    active = blocks
    for t in range(most):
        while lengths[active - 1] <= t:
            active -= 1
        models.predict(active)
        lo, sp, co = low[:active], span[:active], code[:active]
        unit = sp >> np.uint64(12)
        value = np.minimum((co - lo) // unit, np.uint64(4095)).astype(np.int64)
        is2, missed = value < models.one, value >= models.two
        first = np.where(is2, 0, np.where(missed, models.two, models.one))
        stop = np.where(is2, models.one, np.where(missed, 4096, models.two))
        number = np.where(is2, models.ids[0], models.ids[1]).astype(np.int64)
        lo += unit * first.astype(np.uint64)
        sp[:] = unit * (stop - first).astype(np.uint64)
        m = missed.nonzero()[0]
        unit = sp[m] >> start.bits
        got = slots[np.minimum((co[m] - lo[m]) // unit, np.uint64(len(slots) - 1)).astype(np.int64)]
        lo[m] += unit * start.cdf[got]
        sp[m] = unit * start.chances[got].astype(np.uint64)
        number[m] = got
        columns[t, :active] = number
        models.update(number, models.ids == number)
        _settle(lo, sp, take)
    return columns.T


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment of documents with ``counts`` ids each."""
    blocks = [ids[a:a + BLOCK_IDS] for a in range(0, len(ids), BLOCK_IDS)]
    lengths = np.array([len(b) for b in blocks], np.int64)
    names = np.array([-(1 << 63) if d is None else d for d in doc_ids], np.int64)
    index = zlib.compress(names.tobytes() + counts.astype(np.int64).tobytes(), 6)
    model, coded = b"", []
    if blocks:
        start, numbers = _Start.learn(ids)
        model = start.pack()
        numbers = np.pad(numbers, (0, len(blocks) * BLOCK_IDS - len(ids))).reshape(len(blocks), BLOCK_IDS)
        coded = _write_blocks(numbers, lengths, start)
    head = struct.pack(_HEAD, len(doc_ids), len(blocks), len(index), len(model), zlib.crc32(model, zlib.crc32(index)))
    parts = [_MAGIC, head, index, model]
    for block, code in zip(blocks, coded, strict=True):
        parts += [struct.pack(_BLOCK, len(block), len(code), zlib.crc32(code, zlib.crc32(block.tobytes()))), code]
    return b"".join(parts)


def unpack(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, counts and all ids of a segment; a part that does not match its checksum is an error."""
    if payload[:len(_MAGIC)] != _MAGIC:
        raise ValueError("not a segment of token ids")
    at = len(_MAGIC)
    documents, n, size, model, crc = struct.unpack_from(_HEAD, payload, at)
    at += struct.calcsize(_HEAD)
    if zlib.crc32(payload[at:at + size + model]) != crc:
        raise ValueError("the index or the starting model does not match its checksum")
    index = np.frombuffer(zlib.decompress(payload[at:at + size]), np.int64)
    start = _Start.unpack(payload[at + size:at + size + model]) if n else None
    at += size + model
    names, counts = index[:documents], index[documents:]
    coded, lengths, sums = [], [], []
    for _ in range(n):
        length, code, crc = struct.unpack_from(_BLOCK, payload, at)
        at += struct.calcsize(_BLOCK)
        coded.append(payload[at:at + code])
        at += code
        lengths.append(length)
        sums.append(crc)
    ids = np.zeros(0, np.uint32)
    if n:
        numbers = _read_blocks(coded, np.array(lengths, np.int64), start)
        parts = [start.values[numbers[b, :length]].astype(np.uint32) for b, length in enumerate(lengths)]
        for b, part in enumerate(parts):
            if zlib.crc32(coded[b], zlib.crc32(part.tobytes())) != sums[b]:
                raise ValueError(f"block {b} does not match its checksum")
        ids = np.concatenate(parts)
    return [None if d == -(1 << 63) else d for d in names.tolist()], counts, ids


#: Steps that change single characters or act alike on both sides of a blank, and such that drop blanks.
_LOCAL_STEPS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "Nmt"}
_DROPPING_STEPS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}


def _steps(settings: dict, part: str, name: str) -> list[dict]:
    first = settings.get(part)
    return [] if first is None else first[name] if first["type"] == "Sequence" else [first]


def drops_blanks(tokenizer: str) -> bool:
    """Whether a tokenizer file gives the same ids if texts are cut at blanks and line ends.

    That holds if its normalizer only changes single characters or shortens white
    space, its first pre-tokenizer drops blanks (shown by the library on a probe for patterns),
    and no added token holds a blank or takes those beside it.
    """
    from tokenizers import Tokenizer

    settings = json.loads(tokenizer)
    shorter = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if not all(n["type"] in _LOCAL_STEPS or n == shorter for n in _steps(settings, "normalizer", "normalizers")):
        return False
    if any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \n") for t in settings.get("added_tokens") or []):
        return False
    first = _steps(settings, "pre_tokenizer", "pretokenizers")[:1]
    if not first or settings["model"].get("type") == "Unigram":
        return False
    if first[0]["type"] in _DROPPING_STEPS:
        return True
    if first[0]["type"] != "Split" or first[0]["behavior"] != "Removed" or not first[0]["invert"]:
        return False
    split = Tokenizer.from_str(tokenizer).pre_tokenizer.pre_tokenize_str

    def probe(text: str) -> list[str]:
        return [piece for piece, _ in split(text)]

    marks = "aZ7.'é"
    return not any(probe(blank) for blank in (" ", "  ", "\n", " \n ")) and all(
        probe(f"{a}{blank}{b}") == probe(a) + probe(b) for a in marks for b in marks for blank in (" ", "\n")
    )


#: Pre-tokenization for which texts may also be cut where a word of Latin letters ends.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
#: Letters, and the second bytes of the Latin-1 letters.
_ASCII, _LATIN = np.zeros(256, bool), np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def splits_words(settings: dict) -> bool:
    """Whether a word of the letters A-Z, a-z and of Latin-1 between other ASCII characters has the ids of its lower case by the model alone.

    ``settings`` are those of a tokenizer file that drops blanks. The normalizer
    leaves such a word in lower case alone, and it is one match of the pattern, unless
    an apostrophe precedes it.
    """
    normal = [n["type"] for n in _steps(settings, "normalizer", "normalizers")]  # of Replace, drops_blanks knows only white space
    split, *more = _steps(settings, "pre_tokenizer", "pretokenizers")
    return (
        set(normal) <= {"NFC", "Replace", "Lowercase"} and "Lowercase" in normal
        and split.get("pattern") == {"Regex": _PATTERN} and split["behavior"] == "Removed" and split["invert"]
        and all((m["type"], m.get("add_prefix_space"), m.get("use_regex")) == ("ByteLevel", False, False) for m in more)
        and not any(t["normalized"] for t in settings.get("added_tokens") or [])
        and settings["model"].get("type") == "BPE" and not settings["model"].get("dropout")
        and not settings.get("truncation") and not settings.get("padding")
    )


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Texts cut around their words of Latin letters (in lower case) and after blanks, and the first piece of each text."""
    letter = _ASCII[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & _LATIN[data[1:]])
    letter[latin] = letter[latin + 1] = True
    starts, ends = runs(letter, offsets)
    mark = np.zeros(len(data) + 1, bool)
    mark[offsets] = True
    before, after = data[starts - 1], data[np.minimum(ends, len(data) - 1)]
    # beside other characters the word may be longer, or the normalizer may join them
    plain = (mark[starts] | ((before < 128) & (before != ord("'")))) & (mark[ends] | (after < 128))
    starts, ends = starts[plain], ends[plain]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    lower = np.where(np.cumsum(inside[:-1], dtype=np.int8).view(bool), lowered(data), data)
    mark[starts] = mark[ends] = True
    mark[1:] |= (data == ord(" ")) | (data == ord("\n"))
    cuts = np.flatnonzero(mark)
    pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(lower)])
    return pieces, np.searchsorted(cuts, offsets)


class WordEncoder:
    """Ids of texts by a tokenizer file, each text encoded as a whole or piece by piece.

    Where the tokenizer drops blanks (``drops_blanks``), texts are cut at blanks and
    line ends, and every part is encoded once by the library and remembered; other white
    space stays inside parts. Where it also splits off words (``splits_words``), these
    are parts of their own, which need the library's model only. Otherwise the library
    gets whole texts.
    """

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(tokenizer)
        self.encode_batch = library.encode_batch_fast
        self.end = np.array([end_id], np.uint32).tobytes()
        self.cut, settings = drops_blanks(tokenizer), json.loads(tokenizer)
        self.known: dict[str, bytes] = {}
        self.model_batch = None
        if self.cut and splits_words(settings):
            from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

            model = Tokenizer(library.model)
            level = any(t["type"] == "ByteLevel" for t in _steps(settings, "pre_tokenizer", "pretokenizers"))
            model.pre_tokenizer = Sequence([WhitespaceSplit(), *[ByteLevel(add_prefix_space=False, use_regex=False)] * level])
            suffix, vocab = settings["model"].get("end_of_word_suffix"), library.get_vocab()
            self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)
            if any(c.isascii() and not c.isalnum() for c in suffix or ""):  # so no letters of a word look like its end
                self.last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            self.model_batch = model.encode_batch_fast
            self.added = [t["content"].encode() for t in settings.get("added_tokens") or []]

    def _encoded(self, texts: list[str], by=None) -> Iterator[bytes]:
        return (array("I", got.ids).tobytes() for got in (by or self.encode_batch)(texts, add_special_tokens=False))

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of plain words by the model, many in a call; ids of a word's end show where the next one begins."""
        lines = [" ".join(words[a:a + LINE_WORDS]) for a in range(0, len(words), LINE_WORDS)]
        ids = np.frombuffer(b"".join(self._encoded(lines, self.model_batch)), np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or len(ends) and ends[-1] != len(ids):
            return list(self._encoded(words, self.model_batch))
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _looked_up(self, words: list[str]) -> list[bytes]:
        """The ids of all different ``words``."""
        got = list(map(self.known.get, words))
        fresh = [w for w, g in zip(words, got, strict=True) if g is None]
        if not fresh:
            return got
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, words
        if self.model_batch:
            plain = [w for w in fresh if _PLAIN(w)]
            self.known.update(zip(plain, self._words(plain), strict=True))
            fresh = [w for w in fresh if w not in self.known]
        self.known.update(zip(fresh, self._encoded(fresh), strict=True))
        return list(map(self.known.__getitem__, words))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return [got + self.end for got in self._encoded(texts)]
        column = pa.array(texts, pa.large_string())
        if self.model_batch and sum(map(len, texts)):
            data, offsets = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int64)[:len(texts) + 1]
            whole = column.buffers()[2].to_pybytes()
            if not any(token in whole for token in self.added):
                return self._by_pieces(*_pieces(data[:offsets[-1]], offsets))
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        self._looked_up(list(set().union(*parts)))
        return [b"".join(map(self.known.__getitem__, p)) + self.end for p in parts]

    def _by_pieces(self, pieces: pa.Array, first: np.ndarray) -> list[bytes]:
        coded = pieces.dictionary_encode()
        got, at = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        begin = np.cumsum(size) - size
        each = size[at]
        end = np.cumsum(each)
        ids = np.frombuffer(b"".join(got), np.uint32)[np.repeat(begin[at] - end + each, each) + np.arange(end[-1])]
        cuts = np.concatenate([[0], end])[first].tolist()
        return [ids[a:b].tobytes() + self.end for a, b in zip(cuts, cuts[1:], strict=False)]


#: The encoder of a Python worker, so that later tasks find its words.
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(tokenizer: str, end_id: int) -> WordEncoder:
    if (tokenizer, end_id) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer, end_id] = WordEncoder(tokenizer, end_id)
    return _ENCODERS[tokenizer, end_id]


def write_ids(documents: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, partitions: int | None = None) -> None:
    """Encode doc_id and text, and write the ids to ``path`` in ascending doc_id order.

    Null ids come first; rows of one doc_id are ordered by their text. Null and
    empty texts consist of the end id alone. Texts are dealt by ranges of doc_id
    and a hash of the text, so rows of one id can lie in several tasks. A long text is
    encoded whole, and its ids are one value of a segment. Other
    columns are ignored. The tokenizer file is read on the driver and sent along.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    spark = documents.sparkSession
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "_h", "text"]
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(number, "doc_id", "_h").sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(tokenizer, end_id), TaskContext.get().partitionId()
        segment, names, ids, held = 0, [], [], 0
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE_CHARS):
                    size, b = size + len(texts[b]), b + 1
                for name, got in zip(docs[a:b], encoder(texts[a:b]), strict=True):
                    names.append(name)
                    ids.append(got)
                    held += len(got) // 4
                if held >= SEGMENT_IDS:
                    yield _segment(shard, segment, names, ids)
                    segment, names, ids, held = segment + 1, [], [], 0
                a = b
        if names:
            yield _segment(shard, segment, names, ids)

    ordered.mapInArrow(run, _SCHEMA).write.option("compression", "none").parquet(path)


def _segment(shard: int, segment: int, names: list, ids: list[bytes]) -> pa.RecordBatch:
    counts = np.array([len(i) // 4 for i in ids], np.int64)
    payload = pack(names, counts, np.frombuffer(b"".join(ids), np.uint32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(names)], pa.int64()),
            pa.array([int(counts.sum())], pa.int64()), pa.array([payload], pa.binary()),
        ],
        names=["shard", "segment", "documents", "ids", "payload"],
    )


def _with_starts(segments: DataFrame) -> DataFrame:
    """Segments with ``first``, the number of ids before them.

    Sums of shards come first, so a window holds the segments of one shard or the
    shards, never all segments.
    """
    shards = segments.groupBy("shard").agg(F.sum("ids").alias("_ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per written file
    shards = shards.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("shard").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    light = segments.select("shard", "segment", "ids").withColumn("_in", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return light.join(shards, light["shard"] == shards["_shard"]).select(
        "shard", "segment", (F.col("_base") + F.col("_in")).cast("bigint").alias("first")
    )


def read_ids(df_or_spark, path: str, digest: bool = False) -> DataFrame:
    """The documents of the files at ``path``: doc_id, start, n_tokens and their ids.

    ``start`` is the number of ids of all documents before. With ``digest`` the ids
    are replaced by ids_crc32, the CRC-32 of the ids as little-endian 32-bit
    numbers. A folder without segments gives no rows.
    """
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    segments = spark.read.schema(_SCHEMA).parquet(path)
    firsts = _with_starts(segments)
    rows = segments.select("shard", "segment", "payload").join(firsts, ["shard", "segment"]).select("first", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column("first").to_pylist(), batch.column("payload"), strict=True):
                names, counts, ids = unpack(payload.as_py())
                ends = np.cumsum(counts)
                for a in range(0, len(names), 4096):
                    part = slice(a, a + 4096)
                    cuts = list(zip((ends - counts)[part], ends[part], strict=True))
                    if digest:
                        last = pa.array([zlib.crc32(ids[x:y].tobytes()) for x, y in cuts], pa.int64())
                    else:
                        last = pa.array([ids[x:y].astype(np.int32) for x, y in cuts], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[part], pa.int64()), pa.array(first + (ends - counts)[part]), pa.array(counts[part]), last],
                        names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                    )

    kind = "ids_crc32 bigint" if digest else "ids array<int>"
    return rows.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {kind}")
