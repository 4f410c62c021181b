"""Files below a folder, and their metadata rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import has_extension, last_segment

#: Largest file whose content is read; a longer one goes to the error side unread.
MAX_FILE_BYTES = 64 * 1024 * 1024

#: Splits of a scan that one task takes at most; a split holds a few small files.
TASK_SPLITS = 64

FILE_SCHEMA = "file_name string, file_path string, file_size bigint, modification_time timestamp"


def _any_case_glob(extension: str) -> str:
    """Glob for an extension in any letter case, used to prune while listing."""
    letters = (f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    return "*" + "".join(letters)


def scan_files(spark: SparkSession, folder: str, extension: str | None = None) -> DataFrame:
    """Every file below ``folder``: path, modification time, length and content.

    Files of another extension are dropped while listing. Content is read only
    when a query selects it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if extension:
        reader = reader.option("pathGlobFilter", _any_case_glob(extension))
    return reader.load(folder)


def in_few_tasks(files: DataFrame) -> DataFrame:
    """A scan of very many small files in fewer tasks, each of them with many files.

    Spark counts every file as several megabytes, so that a task has only a few;
    their contents pass one by one, so a longer task holds no more of them.
    """
    splits, cores = files.rdd.getNumPartitions(), files.sparkSession.sparkContext.defaultParallelism
    tasks = max(4 * cores, math.ceil(splits / TASK_SPLITS))
    return files.coalesce(tasks) if splits > tasks else files


def file_metadata(files: DataFrame, extension: str | None = None) -> DataFrame:
    """``file_name, file_path, file_size, modification_time`` of scanned files."""
    rows = files.select(
        last_segment("path").alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modification_time"),
    )
    return rows.where(has_extension("file_name", extension)) if extension else rows


def file_texts(files: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """``path, modificationTime, length, text, error``: contents read and decoded on the executors.

    Exactly one of text and error is null. Files longer than ``max_bytes`` and
    contents that are not UTF-8 have an error in place of a text. The length is
    tested by the file source, so the content of a longer file is never read. A byte
    order mark is dropped. Empty files have no row, as Spark's sources skip them.
    """
    own = ["path", "modificationTime", "length"]
    text = F.col("content").cast("string")
    valid = F.call_function("is_valid_utf8", text)
    read = files.where(F.col("length") <= max_bytes).select(
        *own,
        F.when(valid, F.regexp_replace(text, "^\ufeff", "")).alias("text"),
        F.when(~valid, F.lit("not UTF-8")).alias("error"),
    )
    unread = files.where(F.col("length") > max_bytes).select(
        *own, F.lit(None).cast("string").alias("text"), F.lit(f"longer than {max_bytes} bytes").alias("error")
    )
    return read.unionByName(unread)
