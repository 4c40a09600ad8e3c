"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the intermediate tables that this driver has written and not removed.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. In local mode, where it may be unset, a temporary folder is set; a cluster needs a shared one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="tabloom-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet, with the writer's options, into the shared folder and read it back.

    Lineage ends there, so a lost executor costs a re-read and not a recomputation. The files stay
    until discard(), discard_all() or the end of scratch(), as results are read from them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tabloom/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tabloom_path = path
    return out


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p, fs = _file_system(spark, path)
        fs.delete(p, True)
        if path in _written:
            _written.remove(path)


def discard(*tables: DataFrame) -> None:
    """Removes the files of materialised tables that nothing reads any more."""
    for df in tables:
        _remove(df.sparkSession, [df._tabloom_path])


def discard_all(spark: SparkSession) -> None:
    """Removes every intermediate table of this driver: for when all results have been written."""
    _remove(spark, list(_written))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes, at the end, the intermediate tables that were written within, but for those handed to the function it gives."""
    before, kept = set(_written), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._tabloom_path)
        return df

    yield keep
    _remove(spark, [p for p in _written if p not in before and p not in kept])


def put(spark: SparkSession, path: str, content: bytes) -> str:
    """Writes a small file, in whatever file system the path is."""
    p, fs = _file_system(spark, path)
    out = fs.create(p)
    out.write(content)
    out.close()
    return path
