"""The listener: control messages from a stream, each object loaded, outcomes kept in tables.

A message is acknowledged when its batch is checkpointed. One that failed goes to the dead-letter
table with its reason instead of being delivered for ever; `retry` gives those that may be tried
again. The table of outcomes makes a message that comes again load nothing twice, and a ledger of
single loads does so where a batch broke off and is run again.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import astuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EngineConfig
from ..plans.ledger import Ledger
from ..plans.pipeline import STATUS_SCHEMA, UnsupportedFormat, decision, process_object
from ..sources.messages import message_stream, route

log = logging.getLogger("tabloom")
OUTCOME_SCHEMA = "object_name string, target_dataset_id string, version string, status string, decision string, reason string, batch long"


class Listener:
    def __init__(self, spark: SparkSession, config: EngineConfig, database: str = "tabloom_log", suggester: Callable | None = None):
        self.spark, self.config, self.suggester = spark, config, suggester
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        self.outcomes, self.tables, self.dead, self.loads = (f"`{database}`.{t}" for t in ("outcomes", "tables", "dead_letters", "loads"))

    def _version(self, path: str) -> str:
        """Length and time of the object, so that a changed one counts as new."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        s = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(p)
        return f"{s.getLen()}-{s.getModificationTime()}"

    def _settled(self, path: str, dataset: str, version: str) -> bool:
        if not self.config.skip_repeated_messages or not self.spark.catalog.tableExists(self.outcomes):
            return False
        same = (F.col("object_name") == path) & (F.col("target_dataset_id") == dataset) & (F.col("version") == version)
        return not self.spark.table(self.outcomes).where(same & (F.col("decision") == "ack")).isEmpty()

    def handle(self, name: str, dataset: str, batch: int) -> tuple:
        """Processes one valid message; the row for the outcomes."""
        path, version, statuses = f"{self.config.source_dir.rstrip('/')}/{name}", None, []
        try:
            version = self._version(path)
            if self._settled(name, dataset, version):
                return name, dataset, version, "repeated", "ack", None, batch
            ledger = Ledger(self.spark, self.loads, name, dataset, version) if self.config.skip_repeated_messages else None
            statuses = process_object(self.spark, path, dataset, self.config, self.suggester, ledger)
            status, verdict = decision(statuses)
            reason = "; ".join(s.error for s in statuses if s.error) or None
        except UnsupportedFormat as e:
            status, verdict, reason = "unsupported", "dead", str(e)
        except Exception as e:  # noqa: BLE001  one message must not stop the stream
            missing = isinstance(e, FileNotFoundError) or "FileNotFoundException" in str(e)
            status, verdict = ("missing", "ack") if missing else ("failed", "nack")
            reason = f"{type(e).__name__}: {e}"[:500]
        if statuses:
            self.spark.createDataFrame([astuple(s) for s in statuses], STATUS_SCHEMA).write.mode("append").saveAsTable(self.tables)
        return name, dataset, version, status, verdict, reason, batch

    def batch(self, messages: DataFrame, batch: int) -> None:
        """Handler of foreachBatch. Messages are few and small: each names an object."""
        rows = []
        for m in route(messages).collect():
            if m["outcome"] == "ok":
                rows.append(self.handle(m["object_name"], m["target_dataset_id"], batch))
            else:
                bad = "bad JSON" if m.asDict().get("_corrupt_record") else m["reason"]
                rows.append((m["object_name"], m["target_dataset_id"], None, "invalid", "nack", bad, batch))
        if not rows:
            return
        out = self.spark.createDataFrame(rows, OUTCOME_SCHEMA).coalesce(1)
        out.write.mode("append").saveAsTable(self.outcomes)
        dead = out.where("decision != 'ack'")
        if not dead.isEmpty():
            dead.write.mode("append").saveAsTable(self.dead)

    def start(self, messages: str | DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        """Starts the stream, from a folder of JSON lines or a stream of messages; with once it stops when all messages that are there are done."""
        stream = message_stream(self.spark, messages) if isinstance(messages, str) else messages
        writer = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()

    def run(self, messages: str | DataFrame, checkpoint: str) -> None:
        """Blocks until interrupted, then stops."""
        query = self.start(messages, checkpoint)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()

    def retry(self) -> DataFrame:
        """Messages that failed and may be delivered again (not those no reader handles)."""
        return self.spark.table(self.dead).where("status = 'failed'").select("object_name", "target_dataset_id").distinct()
