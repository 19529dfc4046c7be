"""What the training-data operators share: words, the shared folder, cut lineage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.shared import discard, fresh_path, saved, shared_dir

__all__ = ["WORD", "bounded_batches", "discard", "fresh_path", "kept", "parts_for", "release", "saved", "shared_dir", "trim"]

#: Words are runs of anything but space, \t, \n, \v, \f and \r; bytes.split() splits at just these.
WORD = r"[^\x20\x09-\x0D]+"


#: Python workers live on from task to task; what they keep between tasks is here, for one use at a time.
_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What make gave for this key earlier in this Python worker, or gives now; anything else that was kept is let go."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Lets go of what the worker has kept, and of what earlier operators left in its heaps, so that the next one has the memory."""
    _kept.clear()
    trim()


def trim() -> None:
    """Gives memory that is free, but still held by the allocators, back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def bounded_batches(spark: SparkSession, size: str = "16m") -> None:
    """Sets the session's Arrow batches, which bound a Python worker's memory, to size bytes at most."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def parts_for(df: DataFrame, col: str, part_bytes: int) -> int:
    """How many partitions hold the whole column in about part_bytes each, at least the session's shuffle partitions."""
    total = df.agg(F.sum(F.octet_length(col))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
