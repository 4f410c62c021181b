"""From raw documents to encoded training data, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the docs of the next one.

In every stage a null text is an empty one, an empty table gives an empty result, and
further columns are kept up to the last stage, which returns digests. Stages that
drop rows decide by the row's own content, so repeated rows share their fate;
ties are stated where a stage has to choose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.llm import byte_bpe, jaccard_join, mixing, quality, toxicity
from passagemill.session import materialize


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out("doc_id"))


def _kept(docs: DataFrame, score: Callable[[DataFrame], DataFrame], condition: str, made: set[str]) -> DataFrame:
    """Rows that meet a condition on their scores; own columns named like a score stay as they are."""
    names = {c: f"_own_{i}" if c in made else c for i, c in enumerate(docs.columns)}
    scored = score(docs.withColumnsRenamed(names)).filter(condition)
    return scored.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject.

    Empty texts are scored like others. Without labels of both classes every
    document stays. Rows with a null doc_id are scored, but never learned from.
    """
    model = quality.train(docs, _labels(spark, sf_dir))
    made = {"quality_score", "text_view", "page_view"}
    return _kept(docs, lambda rows: quality.score(rows, model), "quality_score >= 0.5", made)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an offending sentence.

    Texts without words score 0 and stay; so does everything where labels of only
    one class are there.
    """
    model = toxicity.train(docs, _labels(spark, sf_dir))
    return _kept(docs, lambda rows: toxicity.score(rows, model), "toxicity < 0.5", {"toxicity", "offending"})


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8).

    The smallest doc_id of a group stays, once; if it has several rows, the one with
    the smallest text. Documents without words and rows with a null doc_id stay.
    """
    return jaccard_join.distinct_documents(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents are left out or repeated.

    A null source is one of its own. Reruns take the same documents; documents
    without words are never taken.
    """
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids by byte-level BPE, decoded again, as counts and digests: one row per row."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, decoded=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Trained models and random rounding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
