"""Answer records for a table of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import check_template, error_excerpt, fill_template
from .context import context_rows
from .scan import number_rows

Retriever = Callable[[DataFrame], DataFrame]
#: A generator maps (prompt, best passage) to an answer column: a string, or
#: ``struct<value, ok, error>`` as ``functions.batched.text_generator`` makes it.
Generator = Callable[[Column, Column], Column]

DEFAULT_TEMPLATE = (
    "Answer the question from the retrieved passages alone and say which of them "
    "you used. If they do not hold the answer, say so.\n\n"
    "Passages:\n{context}\n\nQuestion:\n{question}\n\nAnswer:"
)


def extractive_answer(_prompt: Column, best_text: Column) -> Column:
    """Built-in generator: the text of the best passage, empty without any."""
    return F.coalesce(best_text, F.lit(""))


def prompt_rows(
    questions: DataFrame, contexts: DataFrame, template: str | None = None
) -> DataFrame:
    """Every question with its context and filled prompt; no passages give an empty context."""
    template = DEFAULT_TEMPLATE if template is None else template
    check_template(template)
    joined = questions.join(contexts, "qid", "left")
    context = F.coalesce("context", F.lit(""))
    return joined.withColumns(
        {"context": context, "prompt": fill_template(template, context, F.col("question"))}
    )


class _QA:
    typed = False

    def __init__(self, retriever: Retriever, template: str | None, generator: Generator | None):
        if template is not None:
            check_template(template)
        self.retriever, self.template = retriever, template
        self.generator = generator or extractive_answer

    def _answered(self, questions: DataFrame) -> DataFrame:
        contexts = context_rows(self.retriever(questions), typed=self.typed)
        prompts = prompt_rows(questions, contexts, self.template)
        out = prompts.withColumn("_a", self.generator(F.col("prompt"), F.col("best_text")))
        if isinstance(out.schema["_a"].dataType, T.StructType):
            return out.withColumns({"result": F.col("_a.value"), "error": F.col("_a.error")})
        return out.withColumns({"result": F.col("_a"), "error": F.lit(None).cast("string")})


class RetrievalQA(_QA):
    """Answers over one index; ``reranking`` selects the reranking retriever."""

    def __init__(
        self,
        retriever: Retriever | None,
        reranking_retriever: Retriever | None = None,
        *,
        template: str | None = None,
        reranking: bool = False,
        generator: Generator | None = None,
    ):
        if reranking and reranking_retriever is None:
            raise ValueError("reranking=True needs a reranking_retriever")
        super().__init__(reranking_retriever if reranking else retriever, template, generator)
        self.reranking = reranking

    def __call__(self, questions: DataFrame) -> DataFrame:
        """``qid, query, result, source_documents, reranked, num_sources, unified_index, error``."""
        return self._answered(questions).select(
            "qid",
            F.col("question").alias("query"),
            "result",
            _no_null_array("source_documents"),
            F.lit(self.reranking).alias("reranked"),
            F.coalesce("num_sources", F.lit(0)).alias("num_sources"),
            F.lit(True).alias("unified_index"),
            "error",
        )


class TwoRouteQA(_QA):
    """Answers over narrative and table routes, with types and their counts."""

    typed = True

    def __init__(
        self,
        retriever: Retriever,
        *,
        template: str | None = None,
        generator: Generator | None = None,
    ):
        super().__init__(retriever, template, generator)

    def __call__(self, questions: DataFrame) -> DataFrame:
        def count(name: str) -> Column:
            return F.coalesce(name, F.lit(0))

        return self._answered(questions).select(
            "qid",
            F.col("question").alias("query"),
            "result",
            _no_null_array("source_documents"),
            _no_null_array("context_types"),
            F.struct(
                count("narrative").alias("narrative"),
                count("table").alias("table"),
                count("num_sources").alias("total"),
            ).alias("content_breakdown"),
            F.lit(True).alias("reranked"),
            count("num_sources").alias("num_sources"),
            F.lit(True).alias("unified_index"),
            "error",
        )


def _no_null_array(name: str) -> Column:
    c = F.col(name)
    return F.when(c.isNull(), F.slice(F.array(F.element_at(c, 1)), 1, 0)).otherwise(c).alias(name)


def answer_batch(questions: DataFrame, qa: _QA) -> DataFrame:
    """Answer all questions in one job: ``ordinal, question, answer, error``.

    ``ordinal`` counts from 1 in question order. A question whose generation
    failed keeps its row with the first 100 characters of the error.
    """
    ordinal = number_questions(questions)
    answers = qa(questions).select("qid", F.col("query").alias("question"), "result", "error")
    return answers.join(ordinal, "qid").select(
        "ordinal",
        "qid",
        "question",
        F.when(F.col("error").isNull(), F.col("result")).alias("answer"),
        error_excerpt("error").alias("error"),
    )


def number_questions(questions: DataFrame) -> DataFrame:
    """``qid, ordinal``: position of every question from 1, by ascending ``qid``.

    Counts per id are summed in ranges of ids, so that no task sorts all questions,
    however far apart their ids lie. Ids may be of any type that has an order.
    """
    rows = questions.select("qid", F.lit(0).alias("_at"))
    numbered = number_rows(rows, "qid", "_at", index="_no", global_id="ordinal")
    return numbered.select("qid", (F.col("ordinal") + 1).alias("ordinal"))
