"""Attach a learned value to rows by key, at any table size and key skew."""

from __future__ import annotations

import json

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.operators.merging import merged_state

BROADCAST_ROWS = 200_000
HOT_SHARE = 1_000      # a key is hot from 1/1000 of the rows being joined on
COUNTERS = 2 * HOT_SHARE
SALTS = 64


def _reduced(counts: dict[str, int], size: int) -> dict[str, int]:
    """At most ``size`` counters: all lose what the next largest one has, so none is off by more than rows / size."""
    if len(counts) <= size:
        return counts
    least = sorted(counts.values(), reverse=True)[size]
    return {k: n - least for k, n in counts.items() if n > least}


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """(key, rows) of the keys that hold at least 1/``share`` of the rows of ``df``; fewer than ``share`` rows.

    A sketch of ``COUNTERS`` mergeable counters a task finds all candidates: whatever holds that share keeps a counter.
    The few candidates are then counted exactly. Missing keys are not counted.
    """
    size = max(COUNTERS, 2 * share)

    def partial(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                if entry["values"] is not None:
                    counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
            if len(counts) > 8 * size:
                counts = _reduced(counts, size)
        return json.dumps(_reduced(counts, size)).encode()

    def merge(a, b):
        counts = json.loads(a)
        for k, n in json.loads(b).items():
            counts[k] = counts.get(k, 0) + n
        return json.dumps(_reduced(counts, size)).encode()

    keys = df.select(F.col(key).cast("string").alias("key"))
    found = json.loads(merged_state(keys, partial, merge) or b"{}")
    if not found:
        return df.sparkSession.createDataFrame([], "key string, rows long")
    candidates = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in found], "key string"))  # COUNTERS at most
    counted = keys.join(candidates, "key").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).collect()
    total = df.count()
    return df.sparkSession.createDataFrame([r for r in counted if r["rows"] * share >= total], "key string, rows long")


def attach(df: DataFrame, table: DataFrame, table_rows: int, key: str, out: str,
           fallback: float, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left-join ``table`` (key, value) on ``key``; no match gives ``fallback``.

    ``table_rows`` is the counted size of the table. Up to ``broadcast_rows`` it
    is broadcast and the rows stay where they are. Beyond that the keys are
    shuffled, except those that are hot among the rows being joined, whether the
    table knows them or not: they are few, so they are broadcast with their
    values, and their rows are spread over salted partitions instead of
    following their key into a single task. So are rows without a key.
    """
    slim = table.filter(F.col("key").isNotNull()).select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    if table_rows <= broadcast_rows:
        joined = df.join(F.broadcast(slim), df[key] == F.col("_key"), "left")
        return (joined.withColumn(out, F.coalesce("_value", F.lit(float(fallback))))
                .drop("_key", "_value"))

    found = hot_keys(df, key)
    hot = (found.join(slim, found["key"] == F.col("_key").cast("string"), "left")
           .select(found["key"].alias("_hot_key"), F.col("_value").alias("_hot_value")))
    near = df.join(F.broadcast(hot), df[key].cast("string") == F.col("_hot_key"), "left")
    settled: Column = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    seed = [F.col(policy.KEY)] if policy.KEY in df.columns else [F.col(c) for c in df.columns]
    # One text is the join key of all rows: a constant second column would be folded away, and the settled rows with it.
    salt = F.pmod(F.xxhash64(*seed), F.lit(SALTS)).cast("string")
    near = near.withColumn("_cold_key", F.when(settled, F.concat(F.lit("s"), salt))
                           .otherwise(F.concat(F.lit("k"), F.col(key).cast("string"))))
    cold = slim.select(F.concat(F.lit("k"), F.col("_key").cast("string")).alias("_side_key"), "_value")
    joined = near.join(cold, F.col("_cold_key") == F.col("_side_key"), "left")
    return (joined.withColumn(out, F.coalesce("_hot_value", "_value", F.lit(float(fallback))))
            .drop("_hot_key", "_hot_value", "_cold_key", "_side_key", "_value"))
