"""Parsing with a dead-letter table: what fails is kept, and tried again a bounded number of times.

Rows that were parsed are never parsed again. A row that failed waits in the
dead-letter table with its error, its number of attempts and a digest of its
input; the next run takes it up again until ``max_attempts`` are used. A row whose
input has changed since counts as new. Both tables are keyed, so a run rewrites
only the partitions of the rows it touched, and repeating a run that died changes
nothing that was done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import KeyedTable, create_keyed, replace_keys
from ..session import broadcast_if_small, materialize
from .isolation import quarantined, succeeded

#: A parser: rows in, the same rows with its columns and ``error`` (null: parsed) out.
Parse = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ParseTables:
    """Tables of one parsing stage: ``parsed`` results and ``failed`` rows."""

    key: tuple[str, ...]
    parsed: KeyedTable
    failed: KeyedTable


def open_parse(spark: SparkSession, name: str, key: dict[str, str], result: dict[str, str], buckets: int = 64) -> ParseTables:
    """Create the tables unless they exist; ``key`` and ``result`` map columns to types."""
    keys = ", ".join(f"{k} {t}" for k, t in key.items())
    results = "".join(f", {c} {t}" for c, t in result.items())
    return ParseTables(
        tuple(key),
        create_keyed(spark, f"{name}_parsed", f"{keys}, input string{results}", list(key), buckets),
        create_keyed(spark, f"{name}_failed", f"{keys}, input string, attempts int, error string", list(key), buckets),
    )


def _on_key(rows: DataFrame, held: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    same = F.lit(True)
    for k in key:
        same = same & rows[k].eqNullSafe(held[f"_{k}"])
    return rows.join(held, same, how)


def _held(table: KeyedTable, spark: SparkSession, key: Sequence[str], *columns: Column) -> DataFrame:
    """Key columns under names of their own, and the digest of the input."""
    return table.read(spark).select(*[F.col(k).alias(f"_{k}") for k in key], F.col("input").alias("_held"), *columns)


def run_parse(rows: DataFrame, tables: ParseTables, parse: Parse, *, max_attempts: int = 3) -> dict[str, int]:
    """Parse the rows that are new, changed or have attempts left; returns counts.

    ``parsed`` and ``failed`` are the outcomes of this run, ``skipped`` the rows that
    were done before or have been given up. Keys must be unique in ``rows``.
    """
    spark, key = rows.sparkSession, tables.key
    inputs = [c for c in rows.columns if c not in key]
    digest = F.sha2(F.to_json(F.struct(*inputs), {"ignoreNullFields": "false"}), 256)
    given = rows.withColumn("input", digest)
    strings = [f"_{k}" for k in key if dict(rows.dtypes)[k] == "string"]
    done = _held(tables.parsed, spark, key)
    known = _on_key(given, broadcast_if_small(done, "_held", *strings), key, "left")
    fresh = known.where(~F.col("_held").eqNullSafe(F.col("input")) | F.col("_held").isNull()).select(*given.columns)
    dead = _held(tables.failed, spark, key, F.col("attempts").alias("_attempts"))
    tried = _on_key(fresh, broadcast_if_small(dead, "_held", *strings), key, "left")
    attempts = F.when(F.col("_held") == F.col("input"), F.col("_attempts")).otherwise(F.lit(0))
    todo = tried.select(*given.columns, F.coalesce(attempts, F.lit(0)).alias("attempts")).where(F.col("attempts") < max_attempts)
    outcome = materialize(parse(todo), "parsed")
    keys = outcome.select(*key)
    good, bad = succeeded(outcome), quarantined(outcome).withColumn("attempts", (F.col("attempts") + 1).cast("int"))
    # results first: a run that dies in between finds its rows parsed, and only takes them off the failed ones
    replace_keys(tables.parsed, keys, good)
    replace_keys(tables.failed, keys, bad)
    n = rows.count()
    total, failed = outcome.count(), bad.count()
    return {"parsed": total - failed, "failed": failed, "skipped": n - total}
