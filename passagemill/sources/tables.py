"""Catalog tables: create, append, swap in a new version, guards."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, delete_paths

CHANGE_FEED = "passagemill.changeFeed"
#: Property that lists the folders of replaced versions, and how many of them stay readable.
EARLIER = "passagemill.earlierVersions"
KEPT_VERSIONS = 2


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the warehouse; tables outlive the folder of intermediate files."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/{name.replace('.', '-')}--{uuid.uuid4().hex}"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_exists(
    spark: SparkSession, table: str, schema: str | None = None, catalog: str | None = None
) -> bool:
    """Whether the table exists. Only "not found" answers no; other errors are raised."""
    return spark.catalog.tableExists(".".join(p for p in (catalog, schema, table) if p))


def is_table_empty(spark: SparkSession, name: str) -> bool:
    """True for a missing table or one without rows; reads at most one row."""
    return not spark.catalog.tableExists(name) or spark.read.table(name).isEmpty()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    *,
    path: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Create a parquet table with declared columns unless it exists."""
    props = {CHANGE_FEED: "true"} if properties is None else properties
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in props.items())
    where = path or table_path(spark, name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION {_quoted(where)}"
        + (f" TBLPROPERTIES ({listed})" if listed else "")
    )


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).head(1)
    return rows[0]["value"] if rows else None


def append_table(df: DataFrame, name: str) -> None:
    """Append rows, matched to the table's columns by name; creates a missing table."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = df.select(*spark.read.table(name).columns)
        df.write.mode("append").insertInto(name)
    else:
        df.write.option("path", table_path(spark, name)).saveAsTable(name)


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return described.where(F.col("col_name") == "Location").head()["data_type"]


def swap_table(df: DataFrame, name: str, *, partition_by: list[str] | None = None) -> None:
    """Make ``df`` the table's content; ``partition_by`` names columns with a folder per value.

    Rows go to a fresh folder and the table is then pointed there, so ``df`` may
    read the table itself and readers see the old or the new state. The last
    ``KEPT_VERSIONS`` replaced folders stay for readers that began earlier; older
    ones are deleted, but never a folder that the caller of ``create_table`` chose.
    """
    spark = df.sparkSession
    fresh = f"{name}__{uuid.uuid4().hex}"
    writer = df.write.option("path", table_path(spark, name))
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(fresh)
    if spark.catalog.tableExists(name):
        replaced = _location(spark, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(_location(spark, fresh))}")
        spark.sql(f"DROP TABLE {fresh}")
        earlier = [p for p in (table_property(spark, name, EARLIER) or "").split("|") if p]
        own = re.escape(name.replace(".", "-")) + "--[0-9a-f]{32}"
        if re.fullmatch(own, replaced.rsplit("/", 1)[-1]):
            earlier.append(replaced)
        set_table_property(spark, name, EARLIER, "|".join(earlier[-KEPT_VERSIONS:]))
        delete_paths(spark, earlier[:-KEPT_VERSIONS])
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def run_stage(spark: SparkSession, output: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored output of a stage; built and saved only when the table is missing."""
    if not spark.catalog.tableExists(output):
        append_table(build(), output)
    return spark.read.table(output)


def known_sources(requested: DataFrame, known: DataFrame, name: str = "name") -> DataFrame:
    """Requested sources with ``known`` telling whether the short name is listed."""
    short = F.element_at(F.split(F.col(name), r"\."), -1)
    listed = known.select(F.col(name).alias("_short"), F.lit(True).alias("known")).distinct()
    return (
        requested.withColumn("_short", short)
        .join(broadcast_if_small(listed, "_short"), "_short", "left")
        .withColumn("known", F.coalesce("known", F.lit(False)))
        .drop("_short")
    )

