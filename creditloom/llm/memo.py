"""Memory of Python workers: what they keep between tasks, and how much text they hold at once."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch: with texts of some kilobytes the batches stay at a few megabytes on both sides of the pipe.
BATCH_ROWS = 1_000
#: Rows turned into Python objects at once.
SLICE_ROWS = 250
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def per_process(name: str, key, build):
    """``build()``, kept in this process as long as no other name or key is asked for: one entry in all."""
    kept = sys.__dict__.setdefault("_kept_by_worker", {})
    if name not in kept or kept[name][0] != key:
        release()
        kept[name] = (key, build())
    return kept[name][1]


def release() -> None:
    """Let go of what ``per_process`` keeps, and give the system back what this and earlier tasks have freed.

    A worker serves one stage after the other. Without this it holds on to the most that any of them took.
    """
    sys.__dict__.setdefault("_kept_by_worker", {}).clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size for long texts; smaller settings stay."""
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS or int(spark.conf.get(_BATCH)) <= 0:
        spark.conf.set(_BATCH, BATCH_ROWS)


def slices(batches) -> Iterator:
    """Batches of at most SLICE_ROWS rows; an empty batch stays, so that a column order is always seen."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)
