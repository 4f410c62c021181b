"""Per-row isolation of a user's parser: bad documents are set aside, not fatal."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_isolated(
    docs: DataFrame, parse: Callable[[Any], Any], column: str, result_type: str
) -> DataFrame:
    """Add ``parsed`` and ``error``: ``parse(value)``, or the message it raised.

    Split the outcome with ``succeeded`` and ``quarantined``.
    """

    @F.pandas_udf(f"struct<parsed: {result_type}, error: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            parsed, errors = [], []
            for value in series:
                try:
                    parsed.append(parse(value))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - any bad document is set aside
                    parsed.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            yield pd.DataFrame({"parsed": parsed, "error": errors}, dtype=object)

    return docs.withColumn("_r", run(F.col(column))).select("*", "_r.parsed", "_r.error").drop("_r")


def check_isolated(docs: DataFrame, checks: dict[str, Any]) -> DataFrame:
    """Add ``error``: the first failing check's message, without leaving the JVM.

    ``checks`` maps a message to a boolean column that must be true.
    """
    error = F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for message, ok in checks.items()],
        F.lit(None).cast(T.StringType()),
    )
    return docs.withColumn("error", error)


def succeeded(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull())


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull())
