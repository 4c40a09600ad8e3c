"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..storage import discard, materialise, scratch, shared_dir

__all__ = ["bounded_batches", "discard", "materialise", "scratch", "shared_dir"]

#: White space of the text contracts: space and the bytes 09 to 0D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Makes Arrow batches small enough for texts of any length. A smaller setting stays as it is.

    The setting stays in the session, as results are computed only when they are read.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("bB").isdigit() or not 0 < int(now.rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps, which otherwise stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Gives memory that is free again back to the system, as Python workers live on between tasks."""
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # only where the C library has it
        trim(0)


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many _ after it as it takes to differ from all columns (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def word_count(text):
    """Number of words `[^\\x20\\x09-\\x0D]+` of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


# ---- numpy over Arrow string columns ---------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES_LOWER = _BYTE_CODES[_LOWER]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Words are hashed byte by byte in step over all words; longer ones one at a time.
LONG_WORD = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values end to end, int64 offsets with one more entry than rows). Null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def row_slices(offsets: np.ndarray, most_bytes: int = 2 << 20, most_rows: int = 2048):
    """Consecutive row ranges of about most_bytes each; a longer row stands alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most_bytes, "right")) - 1
        b = min(max(b, a + 1), a + most_rows, n)
        yield a, b
        a = b


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and row numbers of the words of rows laid end to end."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of words; A-Z count as a-z when lower is set."""
    codes = _BYTE_CODES_LOWER if lower else _BYTE_CODES
    length = ends - starts
    h = length.astype(np.uint64) * _PRIME
    active = np.flatnonzero(length <= LONG_WORD)
    step = 0
    while len(active):
        h[active] = (h[active] ^ codes[data[starts[active] + step]]) * _PRIME
        h[active] ^= h[active] >> np.uint64(29)
        step += 1
        active = active[length[active] > step]
    for i in np.flatnonzero(length > LONG_WORD):
        word = codes[data[starts[i] : ends[i]]]
        place = mix64(np.arange(1, len(word) + 1, dtype=np.uint64) * _PRIME) | np.uint64(1)
        h[i] ^= np.bitwise_xor.reduce(mix64(word * place))
    return mix64(h)
