"""Which schema a table gets: an existing one, a suggested one or a sniffed one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .infer import ROW_ORDER, Schema, logical_type, sniff_schema, suggest_schema

STEPS = ("existing", "suggest", "sniff")


def existing_schema(spark: SparkSession, table: str) -> Schema | None:
    """Schema of a catalog table, None where there is none; errors are raised. Nested fields are refused."""
    if not spark.catalog.tableExists(table):
        return None
    fields = spark.table(table).schema.fields
    bad = [f.name for f in fields if f.dataType.typeName() in ("struct", "array", "map")]
    if bad:
        raise ValueError(f"{table} has nested columns, which can't be loaded: {', '.join(bad)}")
    return [{"name": f.name, "type": (f.metadata or {}).get("logical_type") or logical_type(f.dataType), "mode": "NULLABLE" if f.nullable else "REQUIRED"} for f in fields]


def reconcile(schema_names: list[str], columns: list[str]) -> dict[str, list[str]]:
    """Names in both, only in the schema, only in the data. No common name is an error."""
    both = sorted(set(schema_names) & set(columns))
    if not both:
        raise ValueError("the schema and the data have no column in common")
    return {"common": both, "only_schema": sorted(set(schema_names) - set(columns)), "only_data": sorted(set(columns) - set(schema_names))}


def reconciled(pairs: DataFrame) -> DataFrame:
    """The same for rows with two arrays, schema_names and columns."""
    return pairs.withColumns({
        "common": F.array_sort(F.array_intersect("schema_names", "columns")),
        "only_schema": F.array_sort(F.array_except("schema_names", "columns")),
        "only_data": F.array_sort(F.array_except("columns", "schema_names")),
    })


def determine_schema(
    df: DataFrame, table: str, strategy: str = "existing_or_sniff", suggester: Callable[[str, list[str]], str] | None = None, order: str | list[str] | None = None, rows: int = 5, timeout_s: float | None = None
) -> Schema | None:
    """The first schema that the strategy's steps give, with modes filled in; None where none does.

    A suggester sees the first rows by `order`, by ROW_ORDER where df has that, or else as they are
    read, and has timeout_s to answer.
    """
    order = order or (ROW_ORDER if ROW_ORDER in df.columns else None)
    steps = strategy.split("_or_")
    if unknown := [s for s in steps if s not in STEPS]:
        raise ValueError(f"unknown step in schema strategy {strategy!r}: {unknown[0]!r}")
    schema = None
    for step in steps:
        if step == "existing":
            schema = existing_schema(df.sparkSession, table)
        elif step == "suggest":
            schema = suggest_schema(df, suggester, order, rows, timeout_s)
        else:
            schema = sniff_schema(df)
        if schema:
            break
    if not schema:
        return None
    reconcile([f["name"] for f in schema], [c for c in df.columns if c != ROW_ORDER])
    return [{"mode": "NULLABLE"} | f for f in schema]
