"""The grid model: rows(object, sheet, row_idx, cells) and cells(object, sheet, row_idx, col_idx, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_content
from ..functions.tokens import TRIM_NULLS

SHEET = ["object", "sheet"]
ROWS_SCHEMA = "object string, sheet string, row_idx int, cells array<string>"
CELLS_SCHEMA = "object string, sheet string, row_idx int, col_idx int, value string"
DEFAULT_SHEET = "_default_"


def rows_from_table(df: DataFrame, columns: list[str], row_idx: Column, name: str, sheet: str | Column = DEFAULT_SHEET) -> DataFrame:
    """A table as a grid of text, for tests and for compatibility with readers that keep no types."""
    sheet = F.lit(sheet) if isinstance(sheet, str) else sheet
    return df.select(F.lit(name).alias("object"), sheet.alias("sheet"), row_idx.cast("int").alias("row_idx"), F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"))


def to_cells(rows: DataFrame) -> DataFrame:
    """A row for each cell, null ones too."""
    return rows.select(*SHEET, "row_idx", F.posexplode("cells").alias("col_idx", "value"))


def occupied(cells: DataFrame) -> DataFrame:
    """Cells that count as content."""
    return cells.where(has_content(F.col("value")))


def cut_rectangle(cells: DataFrame, r1: int, c1: int, r2: int, c2: int) -> DataFrame:
    """Cells of a rectangle (corners inclusive), renumbered from 0."""
    inside = F.col("row_idx").between(r1, r2) & F.col("col_idx").between(c1, c2)
    return cells.where(inside).withColumns({"row_idx": F.col("row_idx") - r1, "col_idx": F.col("col_idx") - c1})


def cut_rows(rows: DataFrame, r1: int, c1: int, r2: int, c2: int) -> DataFrame:
    """The same of the row form; short rows are filled up with nulls."""
    width = c2 - c1 + 1
    cells = F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), c2 + 1)), c1 + 1, width)
    return rows.where(F.col("row_idx").between(r1, r2)).withColumns({"row_idx": F.col("row_idx") - r1, "cells": cells})


def sheet_density(cells: DataFrame) -> DataFrame:
    """Per sheet: n_cells, n_content and their ratio."""
    out = cells.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(has_content(F.col("value"))).alias("n_content"))
    return out.withColumn("density", F.col("n_content") / F.col("n_cells"))


def trim_sparse_rows(rows: DataFrame, row_density: float = 0.3) -> DataFrame:
    """Rows from the first to the last with at least max(1, int(width * row_density)) values; opt-in."""
    width = F.size("cells")
    values = F.size(F.filter("cells", lambda v: v.isNotNull() & ~v.isin(*TRIM_NULLS)))
    dense = values >= F.greatest(F.lit(1), F.floor(width * row_density))
    ends = rows.groupBy(*SHEET).agg(F.min(F.when(dense, F.col("row_idx"))).alias("first_row"), F.max(F.when(dense, F.col("row_idx"))).alias("last_row"))
    return rows.join(ends, SHEET).where(F.col("row_idx").between(F.col("first_row"), F.col("last_row"))).drop("first_row", "last_row")
