"""Cleaning of a detected table: header, names, empty rows and columns, white space, missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NAME_LENGTH, null_tokens, strip
from .header import header_names, promotes
from .infer import ROW_ORDER


def numbered_repeats(df: DataFrame, name: str, order: str, out: str, partition: list[str] | None = None) -> DataFrame:
    """Adds out: the k-th repeat of a name (k from 1) gets _k, cut to the length of a name."""
    k = F.row_number().over(Window.partitionBy(*(partition or []), name).orderBy(order)) - 1
    return df.withColumn(out, F.when(k == 0, F.col(name)).otherwise(F.left(F.concat(F.col(name), F.lit("_"), k.cast("string")), F.lit(NAME_LENGTH))))


def drop_empty(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Without columns, then rows, that hold only nulls (blank text is no null). Columns take one aggregation."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{k}") for k, c in enumerate(columns)]).first()
    gone = {c for k, c in enumerate(columns) if not counts[k]}
    left = [c for c in columns if c not in gone]
    if not left:
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone]).limit(0)
    out = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])
    return out.where(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in left]))


def clean_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text columns stripped, and words for missing values made null; columns that lose all values stay."""
    columns = [c for c, kind in df.dtypes if kind == "string"] if columns is None else columns
    return df.select(*[null_tokens(strip(F.col(f"`{c}`"))).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def table_frame(rows: DataFrame, width: int) -> DataFrame:
    """rows(row_idx, cells) of one table to columns row_idx, _c0, _c1 ..."""
    return rows.select("row_idx", *[F.get("cells", F.lit(k)).alias(f"_c{k}") for k in range(width)])


def clean_table(rows: DataFrame, width: int, keep_order: bool = False) -> DataFrame:
    """A detected table (rows numbered from 0, cells of one width) to a frame of named text columns.

    row_idx is dropped at the end, or with keep_order named ROW_ORDER; physical names stay _c0, _c1 ... until then, as names may
    differ in case only. One row is moved to the driver.
    """
    first = rows.where("row_idx = 0").select("cells").first()
    first = list(first[0]) if first is not None else []
    promoted = promotes(first, [str(k) for k in range(width)])
    names = header_names(first if promoted else None, width)
    frame = table_frame(rows.where("row_idx > 0") if promoted else rows, width)
    frame = drop_empty(frame, [f"_c{k}" for k in range(width)])
    left = [c for c in frame.columns if c != "row_idx"]
    frame = clean_values(frame, left)
    order = [F.col("row_idx").alias(ROW_ORDER)] if keep_order else []
    return frame.select(*[F.col(c).alias(names[int(c[2:])]) for c in left], *order)
