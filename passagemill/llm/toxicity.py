"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Only documents carry labels. A sentence scores s = sigmoid(b + the weights of its
distinct words); the document is toxic if any sentence is, by noisy-or:
p = 1 - prod(1 - s). The weights are learned from document labels alone, and the
sentences that carry the score can then be pointed at.

The model is fitted in numpy on at most ``MAX_LABELLED`` labelled documents, the
ones of smallest hash of their id; every document is scored from its whole text.
Only words of several of these documents reach the driver, as 32-bit numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill.session import materialize

from .arrays import LETTER, lowered, runs, span_hashes, text_slices

#: Bound of the labelled documents that the model is fitted on.
MAX_LABELLED = 8_000
#: Documents of the fit a word must occur in to get a weight.
LEAST_DOCUMENTS = 3
STEPS = 150
#: Entries of the fit that are summed at a time.
PIECE = 1 << 18

_END = np.zeros(256, bool)
_END[[0x0A, 0x0D, ord("."), ord("!"), ord("?")]] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The distinct words of each sentence with words.

    doc, start and end of each sentence; word hash and sentence of each word.
    """
    data = lowered(data)
    w0, w1 = runs(LETTER[data], offsets)
    s0, s1 = runs(~_END[data], offsets)
    hashes = span_hashes(data, w0, w1)
    of = np.searchsorted(s0, w0, "right") - 1
    used = np.zeros(len(s0), bool)
    used[of] = True
    number = np.cumsum(used) - 1
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    first = np.ones(len(of), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    doc = np.searchsorted(offsets, s0, "right") - 1
    return {
        "doc": doc[used], "start": s0[used], "end": s1[used],
        "word": hashes[first], "sentence": number[of[first]],
    }


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sums(at: np.ndarray, weights: Callable[[slice], np.ndarray], number: int) -> np.ndarray:
    """Sums of weights per place for ascending places, taken in pieces so that little memory is needed at once."""
    out = np.zeros(number)
    a = 0
    while a < len(at):
        b = a + PIECE
        # a piece ends with a place: each place is summed in one go, in the order of its entries
        b = len(at) if b >= len(at) else int(np.searchsorted(at, at[b], "right"))
        first, last = int(at[a]), int(at[b - 1])
        out[first:last + 1] = np.bincount(at[a:b] - first, weights(slice(a, b)), minlength=last - first + 1)
        a = b
    return out


def fit(index: np.ndarray, sentence: np.ndarray, doc: np.ndarray, labels: np.ndarray, vocabulary: np.ndarray) -> dict[str, np.ndarray | float]:
    """Weights of words and the offset, by full gradients of the noisy-or likelihood (Adam).

    index (place in the sorted ``vocabulary``) and sentence: one entry per distinct known word
    of a sentence, in order of sentences; doc: of each sentence; labels: of each document.
    """
    share = labels.mean()
    per_doc = max(1.0, len(doc) / max(1, len(labels)))
    theta = np.zeros(len(vocabulary) + 1)
    theta[-1] = np.log(np.expm1(max(-np.log1p(-min(share, 0.99)) / per_doc, 1e-6)))
    moment, power = np.zeros_like(theta), np.zeros_like(theta)
    toxic = labels == 1
    # the entries by word, for the gradient
    by = np.argsort(index, kind="stable").astype(np.int32)
    by_index, by_sentence = index[by], sentence[by]
    del by
    for step in range(1, STEPS + 1):
        z = theta[-1] + _sums(sentence, lambda part: theta[index[part]], len(doc))
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.exp(-np.bincount(doc, _softplus(z), minlength=len(labels)))
        pull = np.where(toxic, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        grad_z = s * pull[doc]
        grad = np.append(_sums(by_index, lambda part, grad_z=grad_z: grad_z[by_sentence[part]], len(vocabulary)), grad_z.sum())
        grad[:-1] += 0.05 * theta[:-1] + 0.3 * np.sign(theta[:-1])
        moment = 0.9 * moment + 0.1 * grad
        power = 0.99 * power + 0.01 * grad * grad
        rate = 0.15 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        theta -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-6)
    strong = np.abs(theta[:-1]) > 0.02
    return {"words": vocabulary[strong], "weights": theta[:-1][strong], "offset": float(theta[-1])}


def train(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[str, np.ndarray | float]:
    """A model from documents (doc_id, text) and labels (doc_id, toxic).

    Uses the ``max_labelled`` labelled documents of smallest hash of doc_id, of
    those in ``documents`` that have toxic 0 or 1; a document labelled twice counts as toxic if one label says
    so, and of several rows of one doc_id the smallest text is used. Without two classes the model knows no words and scores nothing as toxic.
    """
    chosen = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
        .join(documents.select(F.col("doc_id").alias("_id")), "_id", "left_semi")
        .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # of several rows of one doc_id the smallest text, so that max_labelled bounds the rows too
    single = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_toxic").alias("_toxic"))
    single = materialize(single, "toxicity-fit")
    # words of fewer documents get no weight and never leave the tasks
    often = single.mapInArrow(_words, "word bigint").groupBy("word").count().filter(F.col("count") >= LEAST_DOCUMENTS)
    vocabulary = np.sort(often.select("word").toArrow()["word"].to_numpy().view(np.uint64))
    parts = single.mapInArrow(_features(vocabulary), "doc_id bigint, toxic int, counts binary, words binary").toArrow()
    labels_of = parts["toxic"].to_numpy()
    if len(set(labels_of.tolist())) < 2:
        return {"words": np.zeros(0, np.uint64), "weights": np.zeros(0), "offset": -20.0}
    order = np.argsort(parts["doc_id"].to_numpy(), kind="stable")
    counts, sentences_of = _joined(parts["counts"], order)
    index, _ = _joined(parts["words"], order)
    del parts
    doc = np.repeat(np.arange(len(order), dtype=np.int32), sentences_of)
    sentence = np.repeat(np.arange(len(doc), dtype=np.int32), counts)
    return fit(index, sentence, doc, labels_of[order], vocabulary)


def _joined(column: pa.ChunkedArray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all rows in the given order as one array, and their number per row."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)[order] // 4
    out = np.empty(sizes.sum(), np.int32)
    ends = np.cumsum(sizes)
    at = np.empty(len(order), np.int64)
    at[order] = ends - sizes
    row = 0
    for chunk in column.chunks:
        for value in chunk:
            part = np.frombuffer(value.as_buffer(), np.int32)
            out[at[row]:at[row] + len(part)] = part
            row += 1
    return out, sizes


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each document."""
    for batch in batches:
        for a, b, data, offsets in text_slices(batch.column("text")):
            got = sentences(data, offsets)
            doc, word = got["doc"][got["sentence"]], got["word"]
            order = np.lexsort((word, doc))
            doc, word = doc[order], word[order]
            first = np.ones(len(doc), bool)
            first[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64))], names=["word"])


def _features(vocabulary: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document the number of known words in each sentence, and their places in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                got = sentences(data, offsets)
                place = np.searchsorted(vocabulary, got["word"])
                place[place == len(vocabulary)] = 0
                known = vocabulary[place] == got["word"] if len(vocabulary) else np.zeros(len(place), bool)
                place, sizes = place[known].astype(np.int32), np.bincount(got["sentence"][known], minlength=len(got["doc"])).astype(np.int32)
                cut = np.searchsorted(got["doc"], np.arange(b - a + 1))
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).cast(pa.int64()),
                        batch.column("_toxic").slice(a, b - a).cast(pa.int32()),
                        pa.array([sizes[cut[i]:cut[i + 1]].tobytes() for i in range(b - a)], pa.binary()),
                        pa.array([place[ends[cut[i]]:ends[cut[i + 1]]].tobytes() for i in range(b - a)], pa.binary()),
                    ],
                    names=["doc_id", "toxic", "counts", "words"],
                )

    return run


def score(documents: DataFrame, model: dict[str, np.ndarray | float], at: float = 0.5) -> DataFrame:
    """Every document with its score and its offending sentences.

    Adds to all columns of ``documents``: ``toxicity`` (noisy-or of its sentences,
    0 to 1; null and empty texts and texts without words score 0) and
    ``offending`` (array of start, stop, score: sentences of at least ``at``, or,
    when only together they make the document toxic, its highest one; places in
    code points of the text). Columns of these names are replaced. The model, at
    most a few MB, goes along with the task.
    """
    kept = documents.drop("toxicity", "offending")
    words, weights, offset = model["words"], model["weights"], model["offset"]
    table = np.zeros(1 << 20, bool)
    table[(words >> np.uint64(44)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                got = sentences(data, offsets)
                hit = np.flatnonzero(table[(got["word"] >> np.uint64(44)).astype(np.int64)])
                place = np.searchsorted(words, got["word"][hit])
                place[place == len(words)] = 0
                real = words[place] == got["word"][hit] if len(words) else np.zeros(0, bool)
                z = offset + np.bincount(got["sentence"][hit][real], weights[place[real]], minlength=len(got["doc"]))
                total = np.bincount(got["doc"], _softplus(z), minlength=b - a)
                toxicity = -np.expm1(-total)
                s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                found: list[list[dict]] = [[] for _ in range(b - a)]
                shown = s >= at
                peak = np.lexsort((s, got["doc"]))
                last = peak[np.append(got["doc"][peak][1:] != got["doc"][peak][:-1], True)] if len(peak) else peak
                shown[last[toxicity[got["doc"][last]] >= at]] = True
                for i in np.flatnonzero(shown):
                    d, start, end = got["doc"][i], got["start"][i], got["end"][i]
                    before = data[offsets[d]:start]
                    begin = int(((before & 0xC0) != 0x80).sum())
                    found[d].append(
                        {"start": begin, "stop": begin + int(((data[start:end] & 0xC0) != 0x80).sum()), "score": float(s[i])}
                    )
                part = batch.slice(a, b - a)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(toxicity), pa.array(found, kind)],
                    names=[*part.schema.names, "toxicity", "offending"],
                )

    spans = "array<struct<start:int,stop:int,score:double>>"
    added = T.StructType.fromDDL(f"toxicity double, offending {spans}")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))


def held_out(doc_id: str) -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
