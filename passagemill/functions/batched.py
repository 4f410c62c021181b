"""Arrow-batched calls to a user's model, with a fallback per slice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

#: A provider factory makes the callable once per task: slice of inputs -> outputs.
ProviderFactory = Callable[[], Callable[[list[Any]], Sequence[Any]]]


def batched_apply(
    make_provider: ProviderFactory,
    batch_size: int,
    fallback: Callable[[], Any],
    value_type: str,
):
    """A vectorised function calling a provider in slices of ``batch_size`` rows.

    Returns ``struct<value, ok, error>``. When the provider raises, or answers
    with the wrong number of values, only the slice it was given gets the
    fallback value with ``ok = false``; other slices are not touched. The
    provider is created once per task, not once per Arrow batch.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")

    @F.pandas_udf(f"struct<value: {value_type}, ok: boolean, error: string>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        provider = make_provider()
        for series in batches:
            values: list[Any] = []
            ok: list[bool] = []
            errors: list[str | None] = []
            for start in range(0, len(series), batch_size):
                part = series.iloc[start:start + batch_size].tolist()
                try:
                    answer = list(provider(part))
                    if len(answer) != len(part):
                        raise ValueError(f"expected {len(part)} values, got {len(answer)}")
                    values += answer
                    ok += [True] * len(part)
                    errors += [None] * len(part)
                except Exception as exc:  # noqa: BLE001 - any provider failure is isolated
                    values += [fallback() for _ in part]
                    ok += [False] * len(part)
                    errors += [str(exc)] * len(part)
            yield pd.DataFrame({"value": values, "ok": ok, "error": errors})

    return apply


def embedding_provider(make_provider: ProviderFactory, dim: int, batch_size: int):
    """``batched_apply`` for embedding models; failures become zero vectors."""
    return batched_apply(make_provider, batch_size, lambda: [0.0] * dim, "array<float>")


def text_generator(make_provider: ProviderFactory, batch_size: int = 1):
    """``batched_apply`` for models that answer a prompt with text."""
    return batched_apply(make_provider, batch_size, lambda: None, "string")
