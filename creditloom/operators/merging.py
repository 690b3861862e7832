"""Small partial results that come together in a tree of tasks instead of on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from creditloom.session import materialise

FAN_IN = 32      # partial results that one task, and the driver at the end, takes in


def batch_of(*states: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"state": pa.array(list(states), pa.binary())})


def merged_state(df: DataFrame, partial: Callable[[Iterable[pa.RecordBatch]], bytes | None],
                 merge: Callable[[bytes, bytes], bytes], fan_in: int = FAN_IN) -> bytes | None:
    """One state of all rows of ``df``: ``partial`` makes a task's, ``merge`` joins two; None without any.

    States are written once, so a lost executor costs its own part only, and the driver sees ``fan_in`` of them at most.
    """
    def start(batches):
        state = partial(batches)
        if state is not None:
            yield batch_of(state)

    def join(batches):
        found = None
        for batch in batches:
            for state in batch.column(0).to_pylist():
                found = state if found is None else merge(found, state)
        if found is not None:
            yield batch_of(found)

    parts = materialise(df.mapInArrow(start, "state binary"), "states")
    left = parts.count()
    while left > fan_in:
        left = -(-left // fan_in)
        parts = materialise(parts.repartition(left).mapInArrow(join, "state binary"), "states")
    found = None
    for row in parts.collect():
        found = bytes(row[0]) if found is None else merge(found, bytes(row[0]))
    return found
