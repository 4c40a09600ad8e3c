"""Control messages: JSON objects with object_name and target_dataset_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "object_name string, target_dataset_id string"
DATASET_ID = "^[A-Za-z0-9_]+$"


def message_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Messages, one JSON object a line, from files that arrive in a folder; bad lines keep their text in _corrupt_record."""
    shape = f"{MESSAGE_SCHEMA}, _corrupt_record string"
    return spark.readStream.schema(shape).option("maxFilesPerTrigger", files_per_trigger).json(path)


def broker_stream(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """Messages of a broker, by a streaming source whose rows have a value: JSON text. Its connector has to be in the session.

    For example broker_stream(spark, **{"kafka.bootstrap.servers": "host:9092", "subscribe": "objects"}).
    """
    return messages_of(spark.readStream.format(kind).options(**options).load())


def messages_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """Messages from a column of JSON text or bytes, batch or stream; text that is no JSON object is kept in _corrupt_record."""
    text = lines.select(F.col(column).cast("string").alias("value"))
    got = parse_messages(text)
    bad = F.when(F.col("object_name").isNull() & F.col("target_dataset_id").isNull(), F.col("value"))
    return got.select("object_name", "target_dataset_id", bad.alias("_corrupt_record"))


def parse_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds object_name and target_dataset_id from a column of JSON text; null where it is no JSON object."""
    got = F.from_json(F.col(column), MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})
    return lines.withColumns({"object_name": got["object_name"], "target_dataset_id": got["target_dataset_id"]})


def route(messages: DataFrame) -> DataFrame:
    """Adds outcome: ok; nack for a message without both names, or with a dataset that is no plain name."""
    known = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    both = known("object_name") & known("target_dataset_id")
    fine = F.coalesce(F.col("target_dataset_id").rlike(DATASET_ID), F.lit(False))
    reason = F.when(~both, "missing name").when(~fine, "bad dataset")
    return messages.withColumns({"outcome": F.when(both & fine, "ok").otherwise("nack"), "reason": reason})
