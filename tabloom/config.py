"""Settings of the engine. Importing this has no side effects."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class EngineConfig:
    """Where objects come from, how tables are found in them, and how they are written.

    schema_strategy: `existing`, `suggest` and `sniff` joined by `_or_`, tried in that order.
    write_disposition: WRITE_APPEND, WRITE_TRUNCATE or WRITE_EMPTY.
    large_csv_mb: larger CSV files are split over tasks.
    detect: `by_size`, `grouped` (a sheet a task), `distributed` (sheets of any size) or `whole_sheet`.
    """

    source_dir: str = ""
    default_dataset: str = "default"
    schema_strategy: str = "existing_or_sniff"
    write_disposition: str = "WRITE_APPEND"
    sample_rows: int = 5
    suggest_timeout_s: int = 90
    load_timeout_s: int = 300
    min_table_rows: int = 3
    min_table_cols: int = 2
    min_header_confidence: float = 0.6
    block_density: float = 0.25
    row_density: float = 0.3
    trim_rows: bool = False
    detect: str = "by_size"
    parquet_as_grid: bool = False
    large_csv_mb: int = 64
    strict_integers: bool = False
    skip_repeated_messages: bool = True
    log_level: str = "INFO"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "TABLOOM_") -> EngineConfig:
        """From variables such as TABLOOM_SOURCE_DIR (which has to be set)."""
        env, got = os.environ if env is None else env, {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw is not None:
                kind = type(f.default)
                got[f.name] = raw.strip().lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        if not got.get("source_dir"):
            raise ValueError(f"{prefix}SOURCE_DIR has to be set")
        return cls(**got)
