"""Quality by co-training: a view of the text and a view of the page teach each other.

The text view sees what is written (shares of characters, repetition of words and
lines); the page view sees what a crawl knows about a page (source, language,
length, number and length of lines). Each view is an additive logistic model over
binned features. Both start from the labelled documents; in every round each view
labels the unlabelled documents it is sure of, and the other view learns from
them. At the end the scores of both views are calibrated and combined by a
logistic model on labelled documents that the last fit of the views left out, so
a view that knows little gets little weight.

At most ``MAX_LABELLED`` labelled documents (those of smallest hash of their id)
come to the driver. All unlabelled documents take part: their features are written
once as the numbers of their bins, every round labels all of them in one Spark job,
and each step of a fit adds up the gradient of all guesses per bin in Spark. The
sums are of whole numbers, so neither order nor partitions change a model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill.session import materialize

from .arrays import LOWER, SPACE, runs, span_hashes, text_slices

#: Bound of the labelled documents that the models are fitted on.
MAX_LABELLED = 8_000
ROUNDS = 3
#: Certainty from which a view's guess is passed on, and the most that a guess counts;
#: all guesses together count at most this times as much as the labels.
SURE = 0.97
GUESS = 0.3
BINS = 16
#: Steps of a fit on the labels alone and of one with guesses, past steps a step goes by.
STEPS = 200
GUESS_STEPS = 20
PAST = 8
#: Sums over documents are of multiples of this part.
PART = 2.0**30

#: Features of the text view, by position; then the 33 ASCII signs and controls.
_TEXT = ("letters", "upper", "digits", "spaces", "signs", "high", "word_length", "distinct", "top", "again", "pairs", "lines", "long_word", "no_stop")
_SIGNS = [i for i in range(33, 127) if not chr(i).isalnum()]


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text view: one row of numbers per text; all zero for an empty text."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    table = np.bincount(doc * 128 + np.minimum(data, 127), minlength=n * 128).reshape(n, 128).astype(np.float64)
    high = np.bincount(doc[data >= 128], minlength=n)
    table[:, 127] -= high
    out = np.zeros((n, len(_TEXT) + len(_SIGNS)))
    upper, lower = table[:, 65:91].sum(1), table[:, 97:123].sum(1)
    signs = table[:, _SIGNS]
    out[:, :6] = np.stack([upper + lower, upper, table[:, 48:58].sum(1), table[:, SPACE[:128]].sum(1), signs.sum(1), high], 1) / size[:, None]
    out[:, 1] = upper / np.maximum(upper + lower, 1)
    out[:, len(_TEXT):] = signs / size[:, None]
    small = LOWER[data]
    w0, w1 = runs(~SPACE[small], offsets)
    l0, l1 = runs(small != 10, offsets)
    words, lines = span_hashes(small, w0, w1), span_hashes(small, l0, l1)
    wf, lf = np.searchsorted(w0, offsets), np.searchsorted(l0, offsets)
    lengths = w1 - w0
    for i in range(n):
        a, b = wf[i], wf[i + 1]
        if a == b:
            continue
        own = words[a:b]
        _, counts = np.unique(own, return_counts=True)
        pairs = len(np.unique(own[1:] * np.uint64(3) ^ own[:-1])) if b - a > 1 else 1
        text_lines = lines[lf[i]:lf[i + 1]]
        out[i, 6:14] = (
            lengths[a:b].mean(), len(counts) / (b - a) ** 0.8, counts.max() / (b - a), (own[1:] == own[:-1]).mean() if b - a > 1 else 0,
            pairs / max(1, b - a - 1), len(np.unique(text_lines)) / len(text_lines), lengths[a:b].max(), (table[i, [33, 46, 63]].sum()) / (b - a),
        )
    return out


def page_features(data: np.ndarray, offsets: np.ndarray, source: list, lang: list) -> np.ndarray:
    """The page view: hashed source and language as categories, length and lines as numbers."""
    from zlib import crc32

    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    lines = np.bincount(doc[data == 10], minlength=n) + 1.0
    category = [[crc32(str(x).encode("utf-8", "surrogatepass")) % m for x in column] for column, m in ((source, 64), (lang, BINS))]
    return np.stack([np.log1p(size), np.log(lines), size / lines, *map(np.array, category)], 1) if n else np.zeros((0, 5))


class View:
    """Additive logistic model over quantile bins of its features."""

    def __init__(self, edges: list[np.ndarray], categories: int = 0):
        self.plain, self.edges = len(edges), edges
        self.widths = [len(e) + 1 for e in self.edges] + [64] * categories
        self.base = np.concatenate([[0], np.cumsum(self.widths)]).astype(np.int64)
        self.weights = np.zeros(self.base[-1] + 1)

    def cells(self, features: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(self.edges[j], features[:, j], "right") for j in range(self.plain)]
        columns += [features[:, j].astype(np.int64) for j in range(self.plain, features.shape[1])]
        return np.stack(columns, 1) + self.base[:-1] if len(features) else np.zeros((0, len(self.widths)), np.int64)

    def sums(self, cells: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Gradient and loss of the rows, in whole parts."""
        z = weights[-1] + weights[cells].sum(1)
        error = np.rint((1 / (1 + np.exp(-np.clip(z, -700, 700))) - labels) * PART)
        loss = np.rint((np.logaddexp(0, z) - labels * z) * PART).sum()
        by_cell = np.bincount(cells.ravel(), np.repeat(error, cells.shape[1]), minlength=self.base[-1])
        return np.concatenate([by_cell, [error.sum(), loss]]).astype(np.int64)

    def logit(self, features: np.ndarray) -> np.ndarray:
        return self.weights[-1] + self.weights[self.cells(features)].sum(1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _combiner(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights (not negative) of the views and the offset, by Newton's method with a small prior."""
    x = np.column_stack([logits, np.ones(len(logits))])
    w = np.array([1.0, 0.0, 0.0])
    prior = np.diag([0.5, 0.5, 0.01])
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + prior
        w = w - np.linalg.solve(h, x.T @ (p - labels) + prior @ (w - np.array([1.0, 0.0, 0.0])))
    if w[1] < 0:
        w[1] = 0.0
    return w


def _edges(features: DataFrame, column: str, plain: int) -> list[np.ndarray]:
    """Quantiles of each number over all documents, from exact counts of its leading 20 bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column(0), np.float32)[:, :plain]
                more = (np.ascontiguousarray(values).view(np.uint32) >> 12).astype(np.int64) + (np.arange(plain) << 20)
                new, n = np.unique(more, return_counts=True)
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

    counted = features.select(column).mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, counts = counted["key"].to_numpy(), counted["n"].to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    cuts = np.searchsorted(keys, np.arange(plain + 1) << 20)
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        up_to = np.cumsum(counts[a:b])
        at = np.searchsorted(up_to, np.linspace(0, 1, BINS + 1)[1:-1] * up_to[-1])
        out.append(np.unique(((keys[a:b][at] & 0xFFFFF) << 12).astype(np.uint32).view(np.float32)))  # no number is negative
    return out


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


_STATE = "text binary, page binary, text_told int, page_told int"


def _guessed(unlabelled: DataFrame, views: tuple[View, View]) -> DataFrame:
    """Every unlabelled document with the guesses it got so far and those the views are now sure of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            told = [batch.column(c).to_numpy() for c in (2, 3)]
            for v, view in enumerate(views):
                p = _sigmoid(view.weights[-1] + view.weights[_matrix(batch.column(v), np.uint16)].sum(1))
                new = (np.maximum(p, 1 - p) >= SURE) & (told[1 - v] < 0)
                told[1 - v] = np.where(new, p >= 0.5, told[1 - v]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *map(pa.array, told)], names=batch.schema.names)

    return unlabelled.mapInArrow(run, _STATE)


def _told_sums(told: DataFrame, views: tuple[View, View], w: list[np.ndarray]) -> list[np.ndarray]:
    """Gradient and loss of all guesses for each view, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(len(x) + 1 for x in w), np.int64)
        for batch in batches:
            if batch.num_rows:
                parts = []
                for v, view in enumerate(views):
                    labels = batch.column(2 + v).to_numpy()
                    parts.append(view.sums(_matrix(batch.column(v), np.uint16)[labels >= 0], labels[labels >= 0], w[v]))
                total += np.concatenate(parts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "x"])

    got = told.mapInArrow(run, "i int, x bigint").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(sum(len(x) + 1 for x in w), np.int64)
    out[got["i"].to_numpy()] = got["x"].to_numpy()
    return [out[:len(w[0]) + 1], out[len(w[0]) + 1:]]


def _fit(views: tuple[View, View], cells: list[np.ndarray], labels: np.ndarray, told: DataFrame | None, counts: list[int]) -> None:
    """Both views on the labels and on all guesses, by steps of limited-memory BFGS from where they are."""
    sizes = [len(view.weights) for view in views]
    share = [GUESS * min(1.0, len(labels) / max(1, n)) for n in counts]
    bias = np.cumsum(sizes) - 1

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        parts = [w[:sizes[0]], w[sizes[0]:]]
        sums = [view.sums(c, labels, x) / PART for view, c, x in zip(views, cells, parts, strict=True)]
        if told is not None:
            sums = [s + t / PART * by for s, t, by in zip(sums, _told_sums(told, views, parts), share, strict=True)]
        shrunk = w.copy()
        shrunk[bias] = 0
        return sums[0][-1] + sums[1][-1] + 0.25 * shrunk @ shrunk, np.concatenate([s[:-1] for s in sums]) + 0.5 * shrunk

    w = np.concatenate([view.weights for view in views])
    loss, grad = value(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    left = STEPS if told is None else GUESS_STEPS
    while left > 0 and np.abs(grad).max() > 1e-3:
        way, kept = -grad, []
        for s, y in reversed(past):
            kept.append(s @ way / (s @ y))
            way = way - kept[-1] * y
        way = way * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(grad).sum()))
        for (s, y), by in zip(past, reversed(kept), strict=True):
            way = way + (by - y @ way / (s @ y)) * s
        step = 1.0
        while left > 0:
            left -= 1
            new = w + step * way
            new_loss, new_grad = value(new)
            if new_loss <= loss + 1e-4 * step * (grad @ way):
                break
            step /= 4
        else:
            break
        if (new - w) @ (new_grad - grad) > 1e-10:
            past = [*past, (new - w, new_grad - grad)][-PAST:]
        w, loss, grad = new, new_loss, new_grad
    views[0].weights, views[1].weights = w[:sizes[0]], w[sizes[0]:]


def co_train(text: np.ndarray, page: np.ndarray, labels: np.ndarray, views: tuple[View, View], unlabelled: DataFrame, rounds: int = ROUNDS) -> dict:
    """Fit both views on labelled rows and all unlabelled ones. Returns views, combiner and the rounds' exchange."""
    fold = np.arange(len(labels)) % 4 == 0  # for calibration
    cells = [view.cells(f[~fold]) for view, f in zip(views, (text, page), strict=True)]
    inner = labels[~fold]
    start = np.clip(inner.mean(), 0.01, 0.99)
    for view in views:
        view.weights[-1] = np.log(start / (1 - start))
    _fit(views, cells, inner, None, [0, 0])
    log: list[list[int]] = []
    counts = [0, 0]
    for _ in range(rounds):
        unlabelled = materialize(_guessed(unlabelled, views), "quality-guesses")
        got = unlabelled.agg(*[F.count(F.when(F.col(c) >= 0, 1)) for c in ("text_told", "page_told")]).first()
        log.append([got[1] - counts[1], got[0] - counts[0]])
        counts = [got[0], got[1]]
        if sum(counts):
            _fit(views, cells, inner, unlabelled.filter("text_told >= 0 OR page_told >= 0"), counts)
    logits = np.column_stack([view.logit(f[fold]) for view, f in zip(views, (text, page), strict=True)])
    return {"views": views, "combine": _combiner(logits, labels[fold]), "exchanged": log}


def train(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict | None:
    """Models from documents (doc_id, text, source, lang) and labels (doc_id, quality).

    A document labelled twice counts as good only if all labels say so. Without
    both classes among at least eight labelled documents there is no model: None.
    """
    marked = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("_quality"))
    )
    described = documents.select("doc_id", "text", "source", "lang").mapInArrow(_features, "doc_id bigint, view binary, page binary")
    features = materialize(described, "quality-features")
    present = marked.join(features.select(F.col("doc_id").alias("_id")), "_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("_id"), F.col("_id")).limit(max_labelled)
    # of several rows of one doc_id one is used, so that max_labelled bounds the rows too
    labelled = features.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "_quality")
    table = labelled.agg(F.min(F.struct("view", "page")).alias("f")).select("doc_id", "_quality", "f.view", "f.page").toArrow()
    table = table.take(np.array(sorted(range(table.num_rows), key=list(zip(*(table[c].to_pylist() for c in ("doc_id", "view", "page")), strict=True)).__getitem__), np.int64))
    known = table["_quality"].to_numpy().astype(np.int64)
    if (known == 0).sum() < 4 or (known == 1).sum() < 4:
        return None
    text, page = (_matrix(table[c], np.float32) for c in ("view", "page"))
    views = (View(_edges(features, "view", text.shape[1])), View(_edges(features, "page", 3), 2))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [view.cells(_matrix(batch.column(v), np.float32)).astype(np.uint16) for v, view in enumerate(views)] if batch.num_rows else [[], []]
            none = pa.array(np.full(batch.num_rows, -1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r.tobytes() for r in c], pa.binary()) for c in cells), none, none], names=["text", "page", "text_told", "page_told"]
            )

    others = features.join(marked.select("_id"), F.col("doc_id") == F.col("_id"), "left_anti").select("view", "page")
    return co_train(text, page, known, views, materialize(others.mapInArrow(placed, _STATE), "quality-cells"))


def _views(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b, data, offsets in text_slices(batch.column("text")):
        source, lang = (batch.column(c).slice(a, b - a).to_pylist() for c in ("source", "lang"))
        yield a, b, text_features(data, offsets).astype(np.float32), page_features(data, offsets, source, lang).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, text, page in _views(batch):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a).cast(pa.int64()),
                    pa.array([r.tobytes() for r in text], pa.binary()), pa.array([r.tobytes() for r in page], pa.binary()),
                ],
                names=["doc_id", "view", "page"],
            )


def score(documents: DataFrame, model: dict | None) -> DataFrame:
    """Every document with ``quality_score`` (0 to 1), ``text_view`` and ``page_view``.

    All columns of ``documents`` are kept; those of these names are replaced. Null
    text is empty, null source and language are categories of their own. Without
    a model every document scores 1: nothing is known against it.
    """
    kept = documents.drop("quality_score", "text_view", "page_view")
    names = ("quality_score", "text_view", "page_view")
    if model is None:
        return kept.withColumns({n: F.lit(1.0) for n in names})
    views, combine = model["views"], model["combine"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text, page in _views(batch):
                one, two = views[0].logit(text), views[1].logit(page)
                both = _sigmoid(combine[0] * one + combine[1] * two + combine[2])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(both), pa.array(_sigmoid(one)), pa.array(_sigmoid(two))],
                    names=[*part.schema.names, *names],
                )

    added = [T.StructField(name, T.DoubleType()) for name in names]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))
