"""Session helpers: a tuned builder, the shared work folder, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Limits for an explicit broadcast; a side above either one is joined by shuffle.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "passagemill", cores: int | str = "*") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    width = str(os.cpu_count() if cores == "*" else cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        .getOrCreate()
    )


_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}
_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, read from ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder; on a cluster
    the setting is required because executors could not see the files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="passagemill-")
    return _local_dirs[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a plan would otherwise be evaluated several times. The files
    outlive lost executors, so nothing upstream is recomputed after a failure.
    ``discard_intermediates`` removes them, or the ``scratch`` they are written in.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    held = _scratch.get()
    if held:
        held.paths.append((name, path))
    else:
        _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    writer = df.write.option("compression", "zstd") if held else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard_intermediates(spark: SparkSession) -> int:
    """Delete what ``materialize`` wrote in this application; returns the number of folders.

    Call it when no result of this library is still to be read.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    delete_paths(spark, paths)
    return len(paths)


class Scratch:
    """What ``materialize`` has written since ``scratch`` began, by name."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, list[tuple[str, str]]()

    def drop(self, *names: str) -> None:
        """Delete what was written by these names, or all; no result that is still to be read may need it."""
        self.keep(*[n for n, _ in self.paths if names and n not in names])

    def keep(self, *names: str) -> None:
        """Delete all that was written by other names."""
        gone = [p for n, p in self.paths if n not in names]
        self.paths = [(n, p) for n, p in self.paths if n in names]
        delete_paths(self.spark, gone)


#: Removes the shuffle files of a query as soon as it has ended.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Disk is given back inside: shuffle files after every query, written intermediates at the end or by ``drop``.

    For work that runs its queries itself and leaves tables behind; a frame made inside
    must not be read afterwards.
    """
    held = Scratch(spark)
    token, before = _scratch.set(held), spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield held
    finally:
        _scratch.reset(token)
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
        held.drop()


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders, wherever Spark can reach them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def fits_broadcast(
    df: DataFrame,
    *text_columns: str,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Measure ``df`` and tell whether it is within both broadcast limits.

    Strings count by their bytes, every other column as 16 bytes; the limit on
    the inner select stops the scan of a table that is far too large.
    """
    fixed = 16 * len(df.columns)
    width = F.lit(fixed)
    for column in text_columns:
        width = width + F.coalesce(F.octet_length(column), F.lit(0))
    rows, size = (
        df.select(width.alias("w"))
        .limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, *text_columns: str, **limits: int) -> DataFrame:
    """Broadcast hint behind a measurement; the plain frame otherwise.

    Without the hint Spark joins by sort-merge, where adaptive execution splits
    skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, *text_columns, **limits) else df


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer splits than cores spread over all of them.

    A large table has plenty of splits and is returned as it is; a small one, as
    a single file, would leave every core but one idle in row-wise work.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
