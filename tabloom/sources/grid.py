"""Objects to rows(object, sheet, row_idx, cells): the batch reader and the `grid` data source."""

from __future__ import annotations

import csv
import glob
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import is_blank
from ..functions.tokens import READER_NULLS
from ..operators.cells import DEFAULT_SHEET, ROWS_SCHEMA
from .parse import UnsupportedFormat, extension, parse_file, sniff_delimiter

READABLE = (".csv", ".xlsx", ".xls", ".parquet")
_BATCH = 4096


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its file system. Other errors are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for sheet, grid in parse_file(path, raw.as_py()):
                for a in range(0, len(grid), _BATCH):
                    part = grid[a : a + _BATCH]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * n), pa.array([sheet] * n), pa.array(range(a, a + n), pa.int32()), pa.array(part, pa.list_(pa.string()))],
                        names=["object", "sheet", "row_idx", "cells"],
                    )


def read_grid(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of CSV and Excel files in any file system that Spark reads; a file is one task's work.

    A file that doesn't parse fails its read. For CSV files of many GB use read_large_csv.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(_rows, ROWS_SCHEMA)


def read_large_csv(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """Rows of one CSV file of any size, as read_grid gives them; the file is split over tasks.

    The delimiter is sniffed on the first line; a comma is taken where none is found or some line
    has more values than the first by it. Lines are numbered by the file's blocks: a count for each
    block, then a number within it. A file with a value that holds a line break (some line has an
    odd number of quotes) is read as a stream by one task. Quotes that don't match are no error.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    lines = lines.where(~is_blank(F.col("value")))
    odd = F.count_if((F.length("value") - F.length(F.replace("value", F.lit("\""), F.lit("")))) % 2 == 1)
    counts = sorted(map(tuple, lines.groupBy("block").agg(F.count(F.lit(1)), F.min_by("value", "id"), odd).collect()))  # one row a block
    if not counts:
        return spark.createDataFrame([], ROWS_SCHEMA)
    first = counts[0][2].removeprefix("\ufeff")
    apart = any(n for *_, n in counts)
    begin, total = {}, 0
    for block, n, _, _ in counts:
        begin[block], total = total, total + n
    place = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
    shift = F.create_map(*[F.lit(x) for kv in begin.items() for x in kv])
    index = (F.element_at(shift, F.col("block")) + place).cast("int")

    def rows(sep: str) -> DataFrame:
        """row_idx, cells, and wide (what stands beyond the first line's width)."""
        width = len(next(csv.reader([first], delimiter=sep)))
        schema = ", ".join(f"_c{k} string" for k in range(width + 1))
        options = {"sep": sep, "quote": '"', "escape": '"'}
        if apart:
            df = spark.read.schema(schema).options(**options, multiLine="true").csv(path)
            some = F.col("_c0").isNull() | ~is_blank(F.col("_c0"))
            for k in range(1, width + 1):
                some = some | F.col(f"_c{k}").isNotNull()
            df = df.where(some).withColumn("row_idx", F.monotonically_increasing_id().cast("int"))  # one file, one task
            value = lambda k: F.col(f"_c{k}")
        else:
            df = lines.withColumn("row_idx", index).withColumn("value", F.when(F.col("row_idx") == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")))
            df = df.withColumn("_csv", F.from_csv("value", schema, options))
            value = lambda k: F.col("_csv")[f"_c{k}"]
        known = [F.when(~value(k).isin(*READER_NULLS), value(k)) for k in range(width)]
        if apart:
            known[0] = F.when(F.col("row_idx") == 0, F.regexp_replace(known[0], "^\ufeff", "")).otherwise(known[0])
        return df.select("row_idx", F.array(*known).alias("cells"), value(width).isNotNull().alias("wide"))

    sep = delimiter or sniff_delimiter(first) or ","
    found = rows(sep)
    if sep != "," and not delimiter and not found.where("wide").isEmpty():
        found = rows(",")
    message = F.concat(F.lit("row "), F.col("row_idx").cast("string"), F.lit(" has more fields than the first"))
    cells = F.when(F.col("wide"), F.raise_error(message).cast("array<string>")).otherwise(F.col("cells"))
    return found.select(F.lit(path).alias("object"), F.lit(DEFAULT_SHEET).alias("sheet"), "row_idx", cells.alias("cells"))


def length(spark: SparkSession, path: str) -> int:
    """Bytes of a file in its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()


def read_object(spark: SparkSession, path: str, parquet_as_grid: bool = False, large_csv: int = 64 << 20) -> DataFrame:
    """Rows of one object by its extension; a missing one is a FileNotFoundError.

    A CSV file of more than large_csv bytes is split over tasks (read_large_csv).

    Parquet has a schema already: it is only made a grid of text on request (its columns by
    position, its names lost), else read it with spark.read.parquet.
    """
    kind = extension(path)
    if kind not in READABLE or kind == ".parquet" and not parquet_as_grid:
        raise UnsupportedFormat(f"{path}: no grid reader for {kind or 'a file without extension'}")
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if kind == ".csv" and length(spark, path) > large_csv:
        return read_large_csv(spark, path)
    if kind != ".parquet":
        return read_grid(spark, path)
    df = spark.read.parquet(path)
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    rows = df.select(cells.alias("cells"), F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"))
    counts = sorted(map(tuple, rows.groupBy("part").count().collect()))  # one row a partition
    begin, total = {}, 0
    for part, n in counts:
        begin[part], total = total, total + n
    if not begin:
        return spark.createDataFrame([], ROWS_SCHEMA)
    shift = F.create_map(*[F.lit(x) for kv in begin.items() for x in kv])
    index = F.element_at(shift, F.col("part")) + F.col("id").bitwiseAND((1 << 33) - 1)
    return rows.select(F.lit(path).alias("object"), F.lit(DEFAULT_SHEET).alias("sheet"), index.cast("int").alias("row_idx"), "cells")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class GridReader(DataSourceReader):
    def __init__(self, options):
        self.pattern, self.sheet = options["path"], options.get("sheet")

    def partitions(self):
        where = self.pattern.removeprefix("file://")
        found = sorted(glob.glob(os.path.join(where, "*") if os.path.isdir(where) else where))
        files = [p for p in found if extension(p) in (".csv", ".xlsx", ".xls")]
        if not files:
            raise FileNotFoundError(self.pattern)
        return [_File(p) for p in files]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            raw = f.read()
        for sheet, grid in parse_file(partition.path, raw):
            if self.sheet in (None, sheet):  # the one filter that can be pushed down
                for k, cells in enumerate(grid):
                    yield partition.path, sheet, k, cells


class GridDataSource(DataSource):
    """spark.dataSource.register(GridDataSource); spark.read.format("grid").load(path or pattern), option sheet.

    For files on a disk that all executors mount; read_grid reads from any file system.
    """

    @classmethod
    def name(cls):
        return "grid"

    def schema(self):
        return ROWS_SCHEMA

    def reader(self, schema):
        return GridReader(self.options)
