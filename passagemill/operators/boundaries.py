"""Long texts split where it hurts least: paragraph, line, sentence, clause, word.

Every piece costs something, and so does every cut, the less the stronger the
boundary it lies at. Of all splits into pieces of at most ``max_tokens`` words the
cheapest one is taken, found as a shortest path over the cuts with a sliding
window, so the work grows with the length of a text and not with the cap. Words
and boundaries are found in the JVM; only one number per word of a text that is
too long goes to Python and only the cuts come back.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_headings, token_count
from .hybrid import MAX_TOKENS

#: A word with the separators after it; the first word also keeps those before it.
_WORD = r"(?:\A[^\p{L}\p{N}]+)?[\p{L}\p{N}]+[^\p{L}\p{N}]*"
_AFTER = r"[\p{L}\p{N}]"
#: Boundaries from the strongest to the weakest: separators that make one, and the cost of a cut there.
BOUNDARIES: dict[str, tuple[str, int]] = {
    "paragraph": (r"\n[ \t\r]*\n", 0),
    "line": (r"\n", 2),
    "sentence": (r"[.!?。！？…][\"'”’»)\]]*\s", 4),
    "clause": (r"[,;:，；：–—]\s?", 8),
    "word": (r"", 16),
}
PIECE_COST = 10


def cheapest_cuts(costs: np.ndarray, room: int, piece: int) -> list[int]:
    """Starts of the pieces of a text whose cut after word i costs ``costs[i]``.

    Of equally cheap splits each piece, from the last to the first, is as long as can be.
    """
    n = len(costs)
    best = np.zeros(n + 1, np.int64)
    come = np.zeros(n + 1, np.int64)
    window: deque[int] = deque()  # starts in reach, their sums rising
    for end in range(1, n + 1):
        while window and best[window[-1]] > best[end - 1]:
            window.pop()
        window.append(end - 1)
        if window[0] < end - room:
            window.popleft()
        come[end] = window[0]
        best[end] = best[window[0]] + piece + (costs[end - 1] if end < n else 0)
    starts = []
    at = n
    while at:
        at = int(come[at])
        starts.append(at)
    return starts[::-1]


def _cut_cost(word: Column, costs: Mapping[str, int]) -> Column:
    """The cost of a cut behind a word, by the separators that follow its letters."""
    after = F.regexp_extract(word, r"[^\p{L}\p{N}]*\z", 0)
    cost = F.lit(costs["word"])
    for name, (pattern, _) in reversed(BOUNDARIES.items()):
        if pattern:
            cost = F.when(after.rlike(pattern), costs[name]).otherwise(cost)
    return cost


def split_at_boundaries(
    chunks: DataFrame,
    max_tokens: int = MAX_TOKENS,
    *,
    costs: Mapping[str, int] | None = None,
    piece_cost: int = PIECE_COST,
) -> DataFrame:
    """Split chunks whose headings and text exceed ``max_tokens``; adds ``piece``.

    Input and result are those of ``split_long_chunks``: headings are repeated, those
    that fill the limit alone are dropped, and the pieces of a text put together give
    the text again. ``costs`` replaces costs of boundaries by name. A null text gives
    no piece. Runs inside the row: no shuffle.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be at least 1")
    unknown = set(costs or {}) - set(BOUNDARIES)
    if unknown:
        raise ValueError(f"unknown boundaries: {sorted(unknown)}")
    priced = {name: cost for name, (_, cost) in BOUNDARIES.items()} | dict(costs or {})
    if min(*priced.values(), piece_cost) < 0:
        raise ValueError("costs must not be negative")

    @F.pandas_udf("array<int>")
    def cuts(prices: pd.Series, rooms: pd.Series) -> pd.Series:
        found = [
            None if p is None else np.array(cheapest_cuts(np.asarray(p, np.int64), int(room), piece_cost), np.int32)
            for p, room in zip(prices, rooms, strict=True)
        ]
        return pd.Series(found, dtype=object)

    room = F.lit(max_tokens) - token_count(join_headings("headings", "\n"))
    sized = chunks.withColumns({"_n": token_count("text"), "_room": room}).withColumns(
        {
            "_room": F.when(F.col("_room") > 0, F.col("_room")).otherwise(F.lit(max_tokens)),
            "headings": F.when(F.col("_room") > 0, F.col("headings")),
        }
    )
    words = F.when(F.col("_n") > F.col("_room"), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    listed = sized.withColumn("_words", words)
    cut = listed.withColumn("_cuts", cuts(F.transform("_words", lambda w: _cut_cost(w, priced)), F.col("_room")))

    def piece(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_cuts", i + 1), F.size("_words"))
        return F.array_join(F.slice("_words", start + 1, end - start), "")

    pieces = F.when(F.col("_cuts").isNull(), F.array("text")).otherwise(F.transform("_cuts", piece))
    kept = [c for c in chunks.columns if c != "text"]
    return cut.where(F.col("text").isNotNull()).select(*kept, F.posexplode(pieces).alias("piece", "text"))
