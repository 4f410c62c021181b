"""SentencePiece BPE: one last token per prefix, ids recovered backwards.

A text is normalised (dummy space, spaces as the piece mark) and cut into units
where no piece of the model can reach across: before a run of marks that follows
another character, and around characters that no piece holds (these become byte
ids), and between letters and other characters if no piece has both. Inside a unit every prefix has exactly one last token: of all pieces that
end there (found by one pass of an Aho-Corasick automaton) the only one that
stays apart from the last token of what lies before it. Two tokens stay apart
when merging the characters of both, best score first and leftmost among equals,
gives these two again; the answers are remembered. From the table of last tokens
the ids of the unit are read from its end to its start, so the work grows with
the length of the unit however long it is.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text handled at a time; short units, and token pairs, that a task remembers.
SLICE_CHARS = 1 << 20
REMEMBERED_UNITS = 400_000
REMEMBERED_PAIRS = 1_000_000
REMEMBERED_LENGTH = 64

#: Fixed values of the model format: the mark, kinds of pieces, the model type.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message in protocol-buffer wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, data[at:at + size]
        at += size


class Model:
    """What a model file says: pieces with scores and kinds, and how texts are normalised.

    Only what the method covers is accepted: type BPE with byte fallback, normal,
    unknown, control and byte pieces, no character map, no removal of spaces. Any
    other file is a ValueError.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        for number, value in fields:
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
        top = dict(f for f in fields if f[0] != 1)
        trainer, normalizer = dict(_fields(top.get(2, b""))), dict(_fields(top.get(3, b"")))
        self.dummy = bool(normalizer.get(3, 1))
        refused = {
            "a model type other than BPE": trainer.get(3, 1) != BPE,
            "no byte fallback": not trainer.get(35, 0) or self.kinds.count(BYTE) != 256,
            "white space as suffix": bool(trainer.get(24, 0)),
            "a character map": bool(normalizer.get(2)) or bool(normalizer.get(6)),
            "removal of extra white space": bool(normalizer.get(4, 1)),
            "unescaped white space": not normalizer.get(5, 1),
            "user-defined or unused pieces": not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE},
        }
        if any(refused.values()):
            raise ValueError(f"{path}: not supported: {', '.join(k for k, v in refused.items() if v)}")


class _Units(dict):
    """Remembered ids of short units; a missing one is encoded."""

    def __init__(self, coder: PieceBpe):
        super().__init__()
        self.coder = coder

    def __missing__(self, unit: str) -> bytes:
        ids = self.coder.unit(unit)
        if len(unit) <= REMEMBERED_LENGTH:
            self[unit] = ids
        return ids


class PieceBpe:
    """Encoder and decoder of one model."""

    def __init__(self, model: Model):
        self.model = model
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        self.ids = {model.pieces[i]: i for i in normal}
        order = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal}, reverse=True))}
        #: Turn of each piece in merging: 0 is merged first; equal scores share a turn.
        self.turn = {model.pieces[i]: order[model.scores[i]] for i in normal}
        self.bytes_at = {int(p[3:5], 16): i for i, p in enumerate(model.pieces) if model.kinds[i] == BYTE}
        self.pattern = f"{self._unit_pattern()}|(?s:.)"
        surface = [b""] * len(model.pieces)
        for i, kind in enumerate(model.kinds):
            if kind == BYTE:
                surface[i] = bytes([int(model.pieces[i][3:5], 16)])
            elif kind == NORMAL:
                surface[i] = model.pieces[i].replace(MARK, " ").encode()
            elif kind == UNKNOWN:
                surface[i] = " ⁇ ".encode()
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self._start()

    def _unit_pattern(self) -> str:
        """Units as long as they must be: a cut may stand only where no piece reaches across."""
        bare = [p.lstrip(MARK) for p in self.ids]
        letters = {c for p in bare for c in p if c.isalpha()}
        others = {c for p in bare for c in p} - letters - {MARK}
        known = [f"[{''.join(map(re.escape, sorted(c)))}]" for c in (letters, others) if c]
        if any(MARK in p for p in bare):
            return f"(?:{'|'.join([MARK, *known])})+"
        if any(p.isalpha() != any(c in letters for c in p) for p in bare):
            known = [f"(?:{'|'.join(known)})"]  # some piece has letters and other characters
        return "|".join([f"{MARK}*{k}+" for k in known] + [f"{MARK}+"])

    def _start(self) -> None:
        self.split = self.automaton = None
        self.units, self.pairs, self.whole = _Units(self), {}, {}

    def __getstate__(self) -> dict:
        made_by_tasks = ("split", "automaton", "units", "pairs", "whole")
        return {k: v for k, v in self.__dict__.items() if k not in made_by_tasks}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def merged(self, text: str) -> list[str]:
        """The parts of a short text by merging: best turn first, leftmost among equals."""
        parts, turn, never = list(text), self.turn.get, len(self.turn)
        turns = [turn(a + b, never) for a, b in pairwise(parts)]
        while turns and (best := min(turns)) < never:
            at = turns.index(best)
            parts[at] += parts.pop(at + 1)
            del turns[at]
            if at:
                turns[at - 1] = turn(parts[at - 1] + parts[at], never)
            if at < len(turns):
                turns[at] = turn(parts[at] + parts[at + 1], never)
        return parts

    def _alone(self, token: int) -> bool:
        piece = self.model.pieces[token]
        known = self.whole[token] = self.merged(piece) == [piece]
        return known

    def _apart(self, key: int) -> bool:
        first, second = divmod(key, len(self.model.pieces))
        left, right = self.model.pieces[first], self.model.pieces[second]
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def unit(self, text: str) -> bytes:
        """The ids of one unit as 32-bit integers."""
        if text not in self.ids and len(text) == 1 and text != MARK:
            return array("I", [self.bytes_at[b] for b in text.encode("utf-8", "surrogatepass")]).tobytes()
        whole, pairs, n = self.whole, self.pairs, len(self.model.pieces)
        last = [0] * (len(text) + 1)  # the last token of each prefix; no normal piece has id 0
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            if size == end:
                known = whole.get(token)
                if known or (known is None and self._alone(token)):
                    last[end] = token
            else:
                key = last[end - size] * n + token
                known = pairs.get(key)
                if known or (known is None and self._apart(key)):
                    last[end] = token
        out, at, pieces = array("I"), len(text), self.model.pieces
        while at:
            out.append(last[at])
            at -= len(pieces[last[at]])
        out.reverse()
        return out.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.split is None:
            import ahocorasick

            self.split = re.compile(self.pattern).findall
            self.automaton = ahocorasick.Automaton()
            for piece, token in self.ids.items():
                self.automaton.add_word(piece, (token, len(piece)))
            self.automaton.make_automaton()
        if len(self.units) >= REMEMBERED_UNITS:
            self.units.clear()
        first, known = MARK if self.model.dummy else "", self.units.__getitem__
        out = []
        for text in texts:
            units = self.split(first + text.replace(" ", MARK)) if text else []
            out.append(np.frombuffer(b"".join(map(known, units)), np.uint32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: pieces without control pieces, bytes joined, the dummy space dropped."""
        silent = np.flatnonzero(self.lengths[ids] == 0)
        if len(silent):  # bytes on two sides of a control piece are not joined
            spoken = [part[part_at:] for part, part_at in zip(np.split(ids, silent), [0] + [1] * len(silent), strict=True)]
            spoken = [part for part in spoken if len(part)]
        else:
            spoken = [ids] if len(ids) else []
        text = "".join(map(self._spoken, spoken))
        drop = self.model.dummy and spoken and self.model.kinds[spoken[0][0]] == NORMAL and text.startswith(" ")
        return text[1:] if drop else text

    def _spoken(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - ends + lengths, lengths)
        at += np.arange(len(at))
        data = self.surface[at].tobytes()
        try:
            return data.decode()
        except UnicodeDecodeError:  # byte ids that are no text: each such byte is replaced
            return data.decode("utf-8", _ONE_BY_ONE)


_ONE_BY_ONE = "passagemill.one_by_one"


@lru_cache(1)
def _register() -> None:
    import codecs

    codecs.register_error(_ONE_BY_ONE, lambda error: ("�", error.start + 1))


def encode(documents: DataFrame, model_path: str, *, decoded: bool = False) -> DataFrame:
    """Every row with ``ids`` (array of int): the ids of its whole text, without begin or end ids.

    All columns are kept, but one named ids (or decoded) is replaced. Null and empty
    text have no ids; repeated rows are encoded as often as they come; a text may
    have any length. With ``decoded`` also the text that the ids decode to. The
    model file is read on the driver and sent along. Without rows the result is
    empty.
    """
    coder = PieceBpe(Model(model_path))
    kept = documents.drop("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _register()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE_CHARS):
                    size, b = size + len(texts[b]), b + 1
                ids = coder.encode(texts[a:b])
                part = batch.slice(a, b - a)
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                columns = [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32)))]
                names = [*part.schema.names, "ids"]
                if decoded:
                    columns.append(pa.array([coder.decode(i) for i in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                a = b

    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.StringType())] * decoded
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Every row with ``decoded``: the text of its ids, null where the ids are null.

    All columns are kept, but one named decoded is replaced.
    """
    coder = PieceBpe(Model(model_path))
    kept = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _register()
        for batch in batches:
            column = batch.column("ids")
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]])
            there = column.is_valid().to_pylist()
            out = [coder.decode(flat[a:b]) if ok else None for a, b, ok in zip(starts, ends, there, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(decoded: DataFrame) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
