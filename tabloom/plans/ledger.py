"""A ledger of loads, so that an object that is delivered again after a crash isn't loaded twice."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "object string, dataset string, version string, target string, state string, rows_before long, rows long"


class Ledger:
    """What became of the loads of one version of an object into one dataset.

    A load writes a row before it begins (begun, with the target's rows at that time and the rows
    to come) and one when it is over (done). A load that was begun and not done took place if the
    target has grown by just those rows; this holds as long as nothing else writes to the target
    in between.
    """

    def __init__(self, spark: SparkSession, table: str, object_name: str, dataset: str, version: str):
        self.spark, self.table, self.key = spark, table, (object_name, dataset, version)

    def _past(self, target: str):
        if not self.spark.catalog.tableExists(self.table):
            return []
        own = self.spark.table(self.table)
        for column, value in zip(("object", "dataset", "version", "target"), (*self.key, target), strict=True):
            own = own.where(F.col(column) == value)
        return own.select("state", "rows_before", "rows").collect()  # two rows for each try

    def _write(self, target: str, state: str, before: int, rows: int) -> None:
        self.spark.createDataFrame([(*self.key, target, state, before, rows)], SCHEMA).coalesce(1).write.mode("append").saveAsTable(self.table)

    def _rows(self, target: str) -> int:
        return self.spark.table(target).count() if self.spark.catalog.tableExists(target) else 0

    def done(self, target: str) -> int | None:
        """Rows that a finished load into the target had; None where there was none."""
        past = self._past(target)
        for r in past:
            if r["state"] == "done":
                return r["rows"]
        now = self._rows(target) if past else 0
        for r in past:
            if now == r["rows_before"] + r["rows"]:
                self._write(target, "done", r["rows_before"], r["rows"])
                return r["rows"]
        return None

    def begin(self, target: str, rows: int) -> None:
        self._write(target, "begun", self._rows(target), rows)

    def finish(self, target: str, rows: int) -> None:
        self._write(target, "done", 0, rows)
