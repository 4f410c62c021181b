"""Conversation structure repair: the cheapest edits as one integer minimum.

A conversation's turns must read ``(s?(ua)+)?`` by the initials of their roles.
Each row is kept (K, costs 0), given the role user or assistant (R, 2) or deleted
(D, 3); a user or assistant turn without text can be inserted anywhere (I, 2).
Blank rows and duplicates must be deleted; a truncated row that stays adds 1. Of
all cheapest edits those count whose letters are least in ASCII order.

Both wishes go into one whole number per path: its high digits are the cost, its
low digits (octal, D 1, I 2, K 3, R 4) the letters. Every row owns digits at a
fixed place: one for an insertion, one for its own edit, unused ones at the end of
the place are zero. Letters of two paths differ first where their numbers do,
since a place never holds a beginning of what the other path has there: it ends
with the row's own edit, the only letter that is no I. So an edge has one scalar
weight, the weights of a path are added, and the least number at the end of the
graph of (row, grammar state) is the answer; its digits are the edits.

One insertion ahead of a row is enough: two in a row could be left out for 4
less, unless only a system turn stood before the end, and deleting that costs 3.

A conversation may hold any share of all rows: rows are dealt by ranges of
(conversation, turn, role, text), equal rows counted before. A stretch of rows is
summed up as the matrix of least numbers between grammar states, at most
``BLOCK`` different rows at a time. Matrices of stretches that belong to one
conversation are multiplied (minimum and sum) pairwise, then each stretch gets
the digits that fell to it. Conversations that lie within one task, the usual
case, are finished there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from passagemill.session import broadcast_if_small, materialize

#: Different rows of one conversation that are solved at a time.
BLOCK = 256
#: Output rows put into one Arrow batch.
OUT_ROWS = 500

#: Costs (fixed values of the rules).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Octal digits of the letters, in ASCII order.
D, I, K, R = 1, 2, 3, 4
_LETTERS = str.maketrans("1234", "DIKR", "0")
#: Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

_ROW = "struct<role:string,text:string,kind:int,copies:bigint>"
_SUMMARY = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint"
_TURNS = "array<struct<role:string,text:string>>"
_SEGMENT = (
    f"conv_id bigint, part int, block int, closed boolean, {_SUMMARY}, rows array<{_ROW}>, digits bigint, "
    f"matrix array<binary>, cost bigint, audit string, repaired {_TURNS}"
)
_DECISION = f"conv_id bigint, part int, block int, place int, stretches int, state int, letters string, {_SUMMARY}, cost bigint, audit string"
_RESULT = f"conv_id bigint, place int, stretches int, {_SUMMARY}, cost bigint, audit string, letters string, repaired {_TURNS}"

#: Faults of a row.
SOUND, CUT, BLANK, COPY = range(4)


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def complete(text: Column) -> Column:
    """True where the last character that is not white space ends a sentence."""
    return text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


@dataclass(slots=True)
class Row:
    role: str
    text: str
    kind: int
    copies: int


def keeps(row: Row, state: int) -> int | None:
    """The state after keeping the row's role, None where the grammar forbids it."""
    initial = row.role[:1]
    if initial == "s":
        return SYSTEM if state == START else None
    if initial in ("u", "a") and initial == _NAME[_NEXT[state]][0]:
        return _NEXT[state]
    return None


def _places(rows: list[Row]) -> Iterator[tuple[Row, bool, int]]:
    """(row, whether it must go, rows it stands for): a row's first copy, then the others as one run."""
    for row in rows:
        sound = row.kind in (SOUND, CUT) and row.copies > 0
        if sound:
            yield row, False, 1
        if row.copies > sound:
            yield row, True, row.copies - sound


def width(rows: list[Row]) -> int:
    """Digits of a stretch: one for an insertion and one for each edit at every place."""
    return sum(1 + copies for _, _, copies in _places(rows))


def solve(rows: list[Row], entry: int, spare: int = 0) -> dict[int, int]:
    """For each state that the rows can end in, the least number of a path from ``entry``.

    ``spare`` digits are left free below those of the rows.
    """
    total = at = width(rows) + spare
    best = {entry: 0}
    one = 1 << 3 * total  # a cost of one
    for row, forced, copies in _places(rows):
        at -= 1 + copies
        first, second = 1 << 3 * (at + copies), 1 << 3 * at
        run = D * ((1 << 3 * copies) - 1) // 7 << 3 * at  # a D for each copy, behind an insertion
        late = TRUNCATED * one if row.kind == CUT else 0
        step: dict[int, int] = {}
        for state, value in best.items():
            for inserted in (False, True):
                here = _NEXT[state] if inserted else state
                base = value + (INSERT * one + I * first if inserted else 0)
                # without an insertion the edits move up one digit
                shift = 0 if inserted else 3
                edges = [(here, copies * DELETE * one + (run << shift))]
                if not forced:
                    if (after := keeps(row, here)) is not None:
                        edges.append((after, late + (K * second << shift)))
                    edges.append((_NEXT[here], REROLE * one + late + (R * second << shift)))
                for after, weight in edges:
                    number = base + weight
                    if after not in step or number < step[after]:
                        step[after] = number
        best = step
    return best


#: Insertions that finish a conversation, by the state before them.
_END = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
_SPARE = 2


def finish(best: dict[int, int], digits: int) -> int:
    """The least number over all ends; ``digits`` include two free ones for the last insertions."""
    one = 1 << 3 * digits
    tails = {0: 0, 1: I * 8, 2: I * 8 + I}
    return min(value + _END[state] * INSERT * one + tails[_END[state]] for state, value in best.items())


def split(number: int, digits: int) -> tuple[int, str]:
    """(cost, all low digits as octal text)."""
    cost = number >> 3 * digits
    low = number - (cost << 3 * digits)
    return cost, format(low, "o").zfill(digits) if digits else ""


def letters(octal: str) -> str:
    return octal.translate(_LETTERS)


def apply(rows: list[Row], edits: str, state: int = START) -> list[dict[str, str]]:
    """The turns that the edits make of the rows; ``state`` is the one before them."""
    out, row, left, current = [], iter(rows), 0, None
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            out.append({"role": _NAME[state], "text": ""})
            continue
        while not left:
            current = next(row)
            left = current.copies
        left -= 1
        if edit == "K":
            state = keeps(current, state)
            out.append({"role": current.role, "text": current.text})
        elif edit == "R":
            state = _NEXT[state]
            out.append({"role": _NAME[state], "text": current.text})
    return out


class Product:
    """Matrices of consecutive stretches, multiplied in balanced pairs."""

    def __init__(self):
        self.stack: list[tuple[int, int, list[dict[int, int]]]] = []

    def add(self, digits: int, matrix: list[dict[int, int]]) -> None:
        item = (0, digits, matrix)
        while self.stack and self.stack[-1][0] == item[0]:
            item = self._times(self.stack.pop(), item)
        self.stack.append(item)

    @staticmethod
    def _times(a, b):
        digits = a[1] + b[1]
        shift, low = 3 * b[1], (1 << 3 * b[1]) - 1
        right = [{q: (v >> shift << 3 * digits) + (v & low) for q, v in row.items()} for row in b[2]]
        out = []
        for row in a[2]:
            best: dict[int, int] = {}
            for middle, value in row.items():
                value <<= shift
                for q, other in right[middle].items():
                    number = value + other
                    if q not in best or number < best[q]:
                        best[q] = number
            out.append(best)
        return a[0] + 1, digits, out

    def total(self) -> tuple[int, dict[int, int]]:
        """Digits, and the row of the product that starts at the first state."""
        item = self.stack.pop()
        while self.stack:
            item = self._times(self.stack.pop(), item)
        return item[1], item[2][START]


@dataclass
class Stretch:
    """Rows of one conversation in order, with what has to be counted."""

    rows: list[Row] = field(default_factory=list)
    n: int = 0
    faults: list[int] = field(default_factory=lambda: [0] * 4)
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn: int | None, row: Row) -> None:
        if not row.copies:
            return
        self.rows.append(row)
        sound = row.kind in (SOUND, CUT)
        self.faults[row.kind] += 1 if sound else row.copies
        if sound:
            self.faults[COPY] += row.copies - 1
        initial = row.role[:1]
        self.illegal += (self.n > 0 and self.last + initial not in LEGAL) + (row.copies - 1)
        self.first = initial if self.first is None else self.first
        self.last = initial
        self.n += row.copies
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def summary(self) -> tuple:
        _, cut, blank_rows, copies = self.faults
        return self.n, blank_rows, copies, cut, self.illegal, self.first, self.last, self.low, self.high, self.turns


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from batch.slice(at, 1000).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


_SUMMARY_NAMES = [c.split()[0] for c in _SUMMARY.split(", ")]


def _packed(number: int) -> bytes:
    return number.to_bytes((number.bit_length() + 7) // 8, "big")


def _segments(rows: Iterator[dict], part: int) -> Iterator[dict]:
    """Stretches of the sorted rows of one task; closed where a conversation is surely whole."""
    block = 0
    conv, seen, opened, stretch = None, False, True, Stretch()

    def put(closed: bool) -> dict:
        nonlocal block
        out = dict(zip(_SUMMARY_NAMES, stretch.summary(), strict=True))
        out |= {"conv_id": conv, "part": part, "block": block, "closed": closed}
        rows = stretch.rows
        if closed:
            digits = width(rows) + _SPARE
            out["cost"], octal = split(finish(solve(rows, START, _SPARE), digits), digits)
            out["audit"] = letters(octal)
            out["repaired"] = apply(rows, out["audit"])
        else:
            out["rows"] = [{"role": r.role, "text": r.text, "kind": r.kind, "copies": r.copies} for r in rows]
            out["digits"] = width(rows)
            solved = [solve(rows, q) for q in range(4)]
            out["matrix"] = [_packed(s[q]) if q in s else None for s in solved for q in range(4)]
        block += 1
        return out

    for r in rows:
        if seen and r["conv_id"] != conv:
            yield put(not opened)
            stretch, opened = Stretch(), False
        elif len(stretch.rows) >= BLOCK:
            yield put(False)
            stretch, opened = Stretch(), True
        conv, seen = r["conv_id"], True
        kind = COPY if r["late"] and r["fault"] != BLANK else r["fault"]
        stretch.add(r["turn"], Row(r["role"], r["text"], kind, r["copies"]))
    if seen:
        yield put(False)


def _joined(blocks: list[dict]) -> tuple:
    """The summary of a conversation from those of its stretches, in order."""
    total = Stretch()
    for b in blocks:
        total.faults = [x + y for x, y in zip(total.faults, (0, b["truncated"], b["blank"], b["duplicate"]), strict=True)]
        total.illegal += b["illegal"] + (total.n > 0 and b["n"] > 0 and total.last + b["first"] not in LEGAL)
        total.first = b["first"] if total.first is None else total.first
        total.last = b["last"] if b["n"] else total.last
        total.n += b["n"]
        if b["low"] is not None:
            total.turns += b["turns"] - (b["low"] == total.high)
            total.low = b["low"] if total.low is None else total.low
            total.high = b["high"]
    return total.summary()


def _decided(rows: Iterator[dict]) -> Iterator[dict]:
    """Edits of every open stretch; the first of a conversation carries its summary and cost."""

    def conversation(blocks: list[dict]) -> Iterator[dict]:
        product, matrices = Product(), []
        for b in blocks:
            cells = [None if m is None else int.from_bytes(m, "big") for m in b["matrix"]]
            matrices.append([{q: v for q, v in enumerate(cells[4 * p:4 * p + 4]) if v is not None} for p in range(4)])
            product.add(b["digits"], matrices[-1])
        digits, best = product.total()
        shift, low = 3 * digits, (1 << 3 * digits) - 1
        spaced = {q: (v >> shift << shift + 3 * _SPARE) + ((v & low) << 3 * _SPARE) for q, v in best.items()}
        cost, octal = split(finish(spaced, digits + _SPARE), digits + _SPARE)
        at, state, summary = 0, START, dict(zip(_SUMMARY_NAMES, _joined(blocks), strict=True))
        for i, (b, matrix) in enumerate(zip(blocks, matrices, strict=True)):
            end = at + b["digits"]
            mine = int(octal[at:end] or "0", 8)
            out = {c: b[c] for c in ("conv_id", "part", "block")} | {"place": i, "stretches": len(blocks), "state": state}
            out["letters"] = letters(octal[at:end if i < len(blocks) - 1 else None])
            # letters lead to one state only, so the digits tell where the stretch ends
            low = (1 << 3 * b["digits"]) - 1
            state = next(q for q, v in matrix[state].items() if v & low == mine)
            if not i:
                out |= summary | {"cost": cost, "audit": letters(octal)}
            at = end
            yield out

    held: list[dict] = []
    for r in rows:
        if held and r["conv_id"] != held[0]["conv_id"]:
            yield from conversation(held)
            held = []
        held.append(r)
    if held:
        yield from conversation(held)


def _kinds(turns: DataFrame) -> DataFrame:
    return turns.withColumn(
        "fault", F.when(blank(F.col("text")), BLANK).when(complete(F.col("text")), SOUND).otherwise(CUT)
    )


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The cheapest repair of every conversation, one row per stretch of a conversation.

    Input: conv_id, turn, role, text; ``copies`` names a column that says how often
    a row stands (rows of 0 copies only make their conversation known); further
    columns are ignored. Rows are ordered by turn (null first), then role and text.
    Null role or text is one space, rows with a null conv_id form one conversation,
    repeated rows are duplicates, an empty table gives an empty result.

    Result: conv_id, place (of the stretch, from 0; most conversations have one) and
    stretches (their number); letters (its edits) and repaired (array of role,
    text: what they make of its rows); in the first stretch also, over the whole
    conversation, n, blank, duplicate, truncated (rows by their first fault), illegal
    (adjacent initials other than su, ua, au), low, high and turns (least, largest
    and number of different turns), first, last (initials), cost and audit (all
    edits). A conversation's audit is one value, so its size is bounded by Spark's
    row size; its rows and texts are not.
    """
    times = F.col(copies).cast("bigint") if copies else F.lit(1).cast("bigint")
    plain = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), times.alias("copies"),
    )
    # what a conversation says again at a later turn; a digest stands for role and text
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = materialize(
        plain.filter("copies > 0").groupBy("conv_id", said.alias("said")).agg(F.min(when).alias("since"), F.max(when).alias("until"))
        .filter(F.col("since") < F.col("until")).select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "since"),
        "turns-again",
    )
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    known = counted.join(
        broadcast_if_small(again, "s"), F.col("conv_id").eqNullSafe(F.col("c")) & (said == F.col("s")), "left"
    ).select("conv_id", "turn", "role", "text", "copies", F.coalesce(when > F.col("since"), F.lit(False)).alias("late"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = _kinds(known).repartitionByRange(*order).sortWithinPartitions(*order)
    shape = _arrow(_SEGMENT)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_segments(_rows_of(batches), TaskContext.get().partitionId()), shape)

    found = materialize(dealt.mapInArrow(stretches, _SEGMENT), "turns-stretches")
    whole = found.filter("closed").selectExpr(
        "conv_id", "0 AS place", "1 AS stretches", *_SUMMARY_NAMES, "cost", "audit", "audit AS letters", "repaired"
    )
    parts = found.filter("NOT closed")
    shape2, shape3 = _arrow(_DECISION), _arrow(_RESULT)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_decided(_rows_of(batches)), shape2)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(r: dict) -> dict:
            return r | {"repaired": apply([Row(**row) for row in r["rows"]], r["letters"], r["state"])}

        yield from _batches(({k: v for k, v in done(r).items() if k in names} for r in _rows_of(batches)), shape3)

    names = set(shape3.names)
    decisions = (
        parts.select("conv_id", "part", "block", "digits", "matrix", *_SUMMARY_NAMES)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block")
        .mapInArrow(decide, _DECISION)
    )
    return whole.unionByName(decisions.join(parts.select("part", "block", "rows"), ["part", "block"]).mapInArrow(edit, _RESULT))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place, number (in the stretch, from 0), role, text."""
    return repaired.select("conv_id", "place", F.posexplode("repaired").alias("number", "turn")).select(
        "conv_id", "place", "number", "turn.role", "turn.text"
    )


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, edits and a digest of the repaired turns.

    A digest over several stretches is taken in their order as they pass by.
    """
    said = F.concat_ws("\n", F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    lines = repaired.withColumn("said", said).drop("repaired", "letters", "first", "last")
    counts = ["conv_id", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "cost", "audit"]
    names = [*counts, "repaired_sha256"]
    schema = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'bigint'}" for c in names)
    shape = _arrow(schema)

    def joined(rows: Iterator[dict]) -> Iterator[dict]:
        head, digest, begun = None, None, False
        for r in rows:
            if not r["place"]:
                if head:
                    yield head | {"repaired_sha256": digest.hexdigest()}
                head, digest, begun = {c: r[c] for c in counts}, hashlib.sha256(), False
            if r["said"]:
                digest.update((b"\n" if begun else b"") + r["said"].encode())
                begun = True
        if head:
            yield head | {"repaired_sha256": digest.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(joined(_rows_of(batches)), shape)

    single = lines.filter("stretches = 1").select(*counts, F.sha2("said", 256).alias("repaired_sha256"))
    several = lines.filter("stretches > 1").repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, schema)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    return single.unionByName(several).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Planted faults by crc32 of ``conv_id:turn`` (null: one space) modulo 20.

    0 drops a row (it stays with 0 copies, so its conversation is known), 1 empties
    its text, 2 takes out its ``. ! ?``, 3 repeats it (2 copies), 4 gives it role
    user; null role and text are one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("f")).select(
        "conv_id",
        F.when(F.col("f") != 0, F.col("turn")).alias("turn"),
        F.when(F.col("f") == 0, " ").when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("f") == 0, " ").when(F.col("f") == 1, "").when(F.col("f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("f") == 0, 0).when(F.col("f") == 3, 2).otherwise(1).alias("copies"),
    )
