"""Tables rendered as Markdown text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(value: Column) -> Column:
    """A cell that stays one cell: bars are escaped, line ends become ``<br>``."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    barred = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.regexp_replace(barred, r"\r\n|\r|\n", "<br>")


def markdown_row(cells: Sequence[Column]) -> Column:
    """One line of a Markdown table."""
    shown = [_cell(c) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |"))


def markdown_tables(
    rows: DataFrame, group: str, order: str, columns: dict[str, str]
) -> DataFrame:
    """One Markdown table per group; ``columns`` maps shown names to input columns."""
    header = "| " + " | ".join(columns) + " |"
    rule = "|" + "|".join(" --- " for _ in columns) + "|"
    line = markdown_row([F.col(c) for c in columns.values()])
    body = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))),
            lambda x: x["l"],
        ),
        "\n",
    )
    return rows.groupBy(group).agg(
        F.concat(F.lit(f"{header}\n{rule}\n"), body).alias("markdown"),
        F.count("*").alias("n_rows"),
    )
