"""A session with the settings that the engine wants, and its log."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from ..config import EngineConfig
from ..sources.grid import GridDataSource


def session(config: EngineConfig, name: str = "tabloom", **options: str) -> SparkSession:
    """Adaptive plans, UTC, and the grid data source. Sizes of partitions and memory are the cluster's to set."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in options.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.dataSource.register(GridDataSource)
    configure_log(config.log_level)
    return spark


def configure_log(level: str = "INFO") -> logging.Logger:
    """The engine's logger, whose lines name the thread: one stream handles one message after the other."""
    log = logging.getLogger("tabloom")
    log.setLevel(level)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s [%(threadName)s] %(name)s: %(message)s"))
        log.addHandler(handler)
    return log
