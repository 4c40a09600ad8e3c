"""Loading a frame into a catalog table."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.align import spark_type
from ..operators.infer import Schema

DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite", "WRITE_EMPTY": "append"}


def struct_of(schema: Schema) -> T.StructType:
    """Spark fields of a schema; a field without name or type is a ValueError."""
    out = T.StructType()
    for f in schema:
        if not f.get("name") or not f.get("type"):
            raise ValueError(f"a field needs a name and a type: {f}")
        mode = f.get("mode", "NULLABLE")
        if mode == "REPEATED":
            raise ValueError(f"repeated columns can't be loaded: {f['name']}")
        out.add(f["name"], spark_type(f["type"]), mode != "REQUIRED", {"logical_type": f["type"], "mode": mode})
    return out


def load(df: DataFrame, table: str, schema: Schema, disposition: str = "WRITE_APPEND", timeout_s: int | None = None, count: bool = False) -> int | None:
    """Writes df, which has been aligned to schema, and waits. Returns the table's rows if count is set.

    An empty frame writes nothing. WRITE_EMPTY wants a table that is missing or empty. A REQUIRED
    column with a null, an empty schema and an unknown disposition are ValueErrors. After
    timeout_s the jobs are cancelled, which fails the load.
    """
    if not schema:
        raise ValueError("an empty schema")
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown write disposition {disposition}")
    spark: SparkSession = df.sparkSession
    fields = struct_of(schema)
    if df.isEmpty():
        return None
    must = [f.name for f in fields if not f.nullable]
    if must:
        nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{k}") for k, c in enumerate(must)]).first()
        if bad := [c for k, c in enumerate(must) if nulls[k]]:
            raise ValueError(f"required columns with nulls: {', '.join(bad)}")
    if disposition == "WRITE_EMPTY" and spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
        raise ValueError(f"{table} isn't empty")
    group, timer, sc = f"load {table} {uuid.uuid4().hex}", None, spark.sparkContext
    before = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    if timeout_s:
        sc.setJobGroup(group, f"load {table}", interruptOnCancel=True)
        timer = threading.Timer(timeout_s, sc.cancelJobGroup, [group])
        timer.start()
    try:
        df.write.mode(DISPOSITIONS[disposition]).saveAsTable(table)
    finally:
        if timer:
            timer.cancel()
            for k, v in before.items():
                sc.setLocalProperty(k, v)
    return spark.table(table).count() if count else None
