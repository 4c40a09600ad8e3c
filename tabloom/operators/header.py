"""Header promotion: whether a table's first row holds its column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_name, generic_names, unique_names
from ..functions.tokens import PROMOTE_NULLS
from ..functions.values import is_number
from .cells import SHEET


def first_row_stats(cells: Column) -> dict[str, Column]:
    """Of a row's cells: n_cols, n_nonnull, n_distinct (of these) and n_numeric."""
    known = F.filter(cells, lambda v: v.isNotNull() & ~v.isin(*PROMOTE_NULLS))
    return {
        "n_cols": F.size(cells),
        "n_nonnull": F.size(known),
        "n_distinct": F.size(F.array_distinct(known)),
        "n_numeric": F.size(F.filter(cells, lambda v: F.coalesce(is_number(v), F.lit(False)))),
    }


def is_header(n_cols: Column, n_nonnull: Column, n_distinct: Column) -> Column:
    """More than 0.8 of the values differ, more than 0.6 of the cells have one, and there are two at least."""
    return F.coalesce((F.try_divide(n_distinct, n_nonnull) > 0.8) & (F.try_divide(n_nonnull, n_cols) > 0.6) & (n_distinct > 1), F.lit(False))


def header_stats(rows: DataFrame) -> DataFrame:
    """One row a sheet: the statistics of its first row and promoted."""
    first = rows.groupBy(*SHEET).agg(F.min_by("cells", "row_idx").alias("cells"))
    out = first.withColumns(first_row_stats(F.col("cells"))).drop("cells")
    return out.withColumn("promoted", is_header(F.col("n_cols"), F.col("n_nonnull"), F.col("n_distinct")))


def promotes(first_row: list[str | None], names: list[str]) -> bool:
    """The same for one row on the driver; names that mean something are only given up for a row with more distinct values."""
    words = ["nan" if v is None else v for v in first_row]
    known = [w for w in words if w not in PROMOTE_NULLS]
    distinct = len(set(known))
    if not known or distinct <= 1 or distinct / len(known) <= 0.8 or len(known) / max(1, len(words)) <= 0.6:
        return False
    return generic_names(names) or distinct > len(set(names))


def header_names(first_row: list[str | None] | None, width: int) -> list[str]:
    """Column names from a promoted row, or from positions: sanitised and made unique. A missing cell is named nan."""
    raw = [str(k) for k in range(width)] if first_row is None else ["nan" if v is None else v for v in first_row]
    return unique_names([clean_name(n) for n in raw])
