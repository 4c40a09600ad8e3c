"""One object to catalog tables: read, find tables, clean, decide a schema, align, load."""

from __future__ import annotations

import logging
import posixpath
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.text import TABLE_NAME_LENGTH, clean_name
from ..operators.align import align, coercion_loss
from ..operators.cells import DEFAULT_SHEET, cut_rows, to_cells, trim_sparse_rows
from ..operators.clean import clean_table
from ..operators.detect import detect_tables
from ..operators.infer import ROW_ORDER
from ..operators.schema import determine_schema
from ..sources.grid import exists, read_object
from ..sources.messages import DATASET_ID
from ..sources.parse import UnsupportedFormat, extension
from .ledger import Ledger
from .sink import load

log = logging.getLogger("tabloom")

STATUS_SCHEMA = "object string, sheet string, table string, outcome string, n_rows long, error string, table_rows long, warning string"


@dataclass(frozen=True)
class TableStatus:
    """What became of one detected table: loaded, skipped (nothing left) or failed.

    table_rows: rows of the target after the load. warning: columns that lost values to their type.
    """

    object: str
    sheet: str
    table: str
    outcome: str
    n_rows: int | None = None
    error: str | None = None
    table_rows: int | None = None
    warning: str | None = None


def target_name(path: str, sheet: str, number: int, n_sheets: int, n_tables: int) -> str:
    """file, file_sheet, file_table_N or file_sheet_table_N: no more than is needed to tell tables apart."""
    parts = [clean_name(posixpath.splitext(posixpath.basename(path))[0])]
    if sheet != DEFAULT_SHEET or n_sheets > 1 or n_tables > 1:
        parts.append(clean_name(sheet))
    if n_tables > 1:
        parts.append(f"table_{number}")
    return "_".join(parts)[:TABLE_NAME_LENGTH]


def plan_object(spark: SparkSession, path: str, config: EngineConfig) -> tuple[DataFrame, list[dict]]:
    """(rows of the object, one entry for each table to load), in one job over all sheets."""
    rows = read_object(spark, path, config.parquet_as_grid, config.large_csv_mb << 20).persist()
    found = detect_tables(to_cells(rows), config.detect, config.min_table_rows, config.min_table_cols, config.block_density, config.min_header_confidence)
    boxes = [r.asDict() for r in found.collect()]  # a few a sheet
    sheets = {r["sheet"] for r in rows.select("sheet").distinct().collect()}
    per_sheet = {s: sum(b["sheet"] == s for b in boxes) for s in sheets}
    taken: set[str] = set()
    for b in sorted(boxes, key=lambda b: (b["sheet"], int(b["table_id"][6:]))):
        name = target_name(path, b["sheet"], int(b["table_id"][6:]), len(sheets), per_sheet[b["sheet"]])
        k = 1
        while name.lower() in taken:  # sheets whose names come out alike
            k += 1
            name = f"{name[: TABLE_NAME_LENGTH - 6]}_{k}"
        taken.add(name.lower())
        b["name"] = name
    return rows, boxes


def table_of(rows: DataFrame, box: dict, config: EngineConfig) -> DataFrame:
    """The clean frame of text columns of one detected table, and ROW_ORDER."""
    own = cut_rows(rows.where(F.col("sheet") == box["sheet"]), box["r1"], box["c1"], box["r2"], box["c2"])
    if config.trim_rows:
        own = trim_sparse_rows(own, config.row_density)
    return clean_table(own, box["c2"] - box["c1"] + 1, keep_order=True)


def load_frame(frame: DataFrame, target: str, config: EngineConfig, suggester: Callable | None = None, ledger: Ledger | None = None) -> tuple[int | None, int | None, str | None]:
    """Decides the schema, aligns and loads: (rows loaded, None for nothing to load; rows of the target then; warning).

    The clean frame and the aligned one are computed once and kept until the load is over.
    """
    if not set(frame.columns) - {ROW_ORDER}:
        raise ValueError("no column is left after cleaning")
    frame, aligned = frame.persist(), None
    try:
        schema = determine_schema(frame, target, config.schema_strategy, suggester, rows=config.sample_rows, timeout_s=config.suggest_timeout_s)
        if schema is None:
            raise ValueError("no schema")
        aligned = align(frame, schema, config.strict_integers).persist()
        n = aligned.count()
        if not n:
            return None, None, None
        text = {c for c, kind in frame.dtypes if kind == "string"}
        lost = coercion_loss(frame, [f for f in schema if f["name"] in text]).where("warn").collect() if text else []  # a row a column
        warning = "; ".join(f"{r['name']}: {r['n_lost']} of {r['n_before']} values lost" for r in lost) or None
        if warning:
            log.warning("%s: %s", target, warning)
        if ledger:
            ledger.begin(target, n)
        total = load(aligned, target, schema, config.write_disposition, config.load_timeout_s, count=True)
        if ledger:
            ledger.finish(target, n)
        log.info("%s: %d rows loaded, %d in the table", target, n, total)
        return n, total, warning
    finally:
        frame.unpersist()
        if aligned is not None:
            aligned.unpersist()


def process_object(spark: SparkSession, path: str, dataset: str, config: EngineConfig, suggester: Callable | None = None, ledger: Ledger | None = None) -> list[TableStatus]:
    """Loads every table of an object into tables of the dataset. A table that fails doesn't stop the others.

    With a ledger, tables that were loaded from this version of the object already are not loaded again.
    Errors of the object as a whole are raised: FileNotFoundError, UnsupportedFormat, unreadable contents.
    """
    if not re.fullmatch(DATASET_ID.strip("^$"), dataset or ""):
        raise ValueError(f"bad dataset {dataset!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")
    jobs: list[tuple[str, str, Callable[[], DataFrame]]] = []
    rows = None
    if extension(path) == ".parquet" and not config.parquet_as_grid:
        if not exists(spark, path):
            raise FileNotFoundError(path)
        jobs.append((DEFAULT_SHEET, target_name(path, DEFAULT_SHEET, 1, 1, 1), lambda: spark.read.parquet(path)))
    else:
        rows, boxes = plan_object(spark, path, config)
        jobs += [(b["sheet"], b["name"], lambda b=b: table_of(rows, b, config)) for b in boxes]
    out = []
    try:
        for sheet, name, frame in jobs:
            target = f"`{dataset}`.`{name}`"
            try:
                if ledger and (n := ledger.done(target)) is not None:
                    out.append(TableStatus(path, sheet, name, "loaded", n))
                    continue
                n, total, warning = load_frame(frame(), target, config, suggester, ledger)
                out.append(TableStatus(path, sheet, name, "loaded" if n else "skipped", n, None, total, warning))
            except Exception as e:  # noqa: BLE001  reported in the status
                log.warning("%s: table %s failed: %s", path, name, e)
                out.append(TableStatus(path, sheet, name, "failed", None, f"{type(e).__name__}: {e}"[:500]))
    finally:
        if rows is not None:
            rows.unpersist()
    return out


def settle(statuses: DataFrame) -> DataFrame:
    """One row an object from its tables' statuses: n_tables, n_loaded, n_failed, status and decision.

    Nothing loaded and something failed is a failure, to be tried again; anything else is settled.
    """
    counts = statuses.groupBy("object").agg(
        F.count(F.lit(1)).alias("n_tables"), F.count_if(F.col("outcome") == "loaded").alias("n_loaded"), F.count_if(F.col("outcome") == "failed").alias("n_failed")
    )
    status = F.when((F.col("n_loaded") == 0) & (F.col("n_failed") > 0), "failed").when(F.col("n_failed") > 0, "partial").otherwise("ok")
    return counts.withColumn("status", status).withColumn("decision", F.when(F.col("status") == "failed", "nack").otherwise("ack"))


def decision(statuses: list[TableStatus]) -> tuple[str, str]:
    """(status, ack or nack) of one object by the same rule."""
    loaded, failed = (sum(s.outcome == o for s in statuses) for o in ("loaded", "failed"))
    if failed and not loaded:
        return "failed", "nack"
    return ("partial" if failed else "ok"), "ack"


__all__ = ["STATUS_SCHEMA", "TableStatus", "UnsupportedFormat", "decision", "load_frame", "plan_object", "process_object", "settle", "table_of", "target_name"]
