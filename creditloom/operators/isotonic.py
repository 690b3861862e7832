"""Isotonic calibration at any size (J2): pools per score range, merged along the borders of ranges.

Scores are pre-aggregated per distinct value and cut into ranges of about equal row count. Each range pools its own
adjacent violators. Pooling is associative, so the pools of two neighbouring ranges give those of both; and of these only
the ones can change whose rates overlap: on the left those not below the lowest pool on the right, on the right those
not above the highest on the left. Ranges are joined in pairs, pairs of pairs and so on, each time over that overlap
alone. No step holds all scores, and none sorts them globally.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.functions.bins import grid_bucket
from creditloom.functions.numeric import present
from creditloom.operators.prefix import default_ranges, range_edges
from creditloom.session import materialise

RANGE_ROWS = 1_000_000
POOLS = "part long, low double, high double, rows long, positives long"


def pool(low: Sequence[float], high: Sequence[float], rows: Sequence[int], positives: Sequence[int]) -> list[tuple]:
    """Adjacent violators pooled, in the order given; counts stay whole, so rates are compared exactly."""
    stack: list[list] = []
    for entry in zip(low, high, rows, positives):
        a, b, n, y = entry
        while stack and stack[-1][3] * n >= y * stack[-1][2]:
            a, _, more_n, more_y = stack.pop()
            n, y = n + more_n, y + more_y
        stack.append([a, b, n, y])
    return stack


def _pooled(keep: str):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("low")
        found = pool(*(frame[c].tolist() for c in ("low", "high", "rows", "positives")))
        out = pd.DataFrame(found, columns=["low", "high", "rows", "positives"])
        out.insert(0, "part", frame[keep].iloc[0] if len(frame) else 0)
        return out
    return run


def _overlap(pools: DataFrame, step: int) -> DataFrame:
    """Per pair of parts at this step the highest rate on the left and the lowest on the right, where these overlap."""
    rate, right = F.col("positives") / F.col("rows"), F.shiftright("part", step - 1).bitwiseAND(F.lit(1).cast("long")) == 1
    return (pools.groupBy(F.shiftright("part", step).alias("pair"))
            .agg(F.max(F.when(~right, rate)).alias("top"), F.min(F.when(right, rate)).alias("bottom"))
            .where("top >= bottom"))


def isotonic_pools(df: DataFrame, score: str = "pd", label: str = policy.TARGET, ranges: int | None = None) -> DataFrame:
    """The isotonic regression of ``label`` (0 or 1) on ``score``: low, high, rows, positives and rate of each pool.

    Equal scores are one point. Rates rise strictly from pool to pool. A NULL or NaN score fails the job; rows without
    a label take no part; a frame without labelled rows has no pool.
    """
    points = materialise(
        df.where(F.col(label).isNotNull())
        .select(present(F.col(score).cast("double"), f"Score {score}").alias("low"), F.col(label).cast("long").alias("y"))
        .groupBy("low").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("positives")), "points")
    if not ranges:
        ranges = max(default_ranges(df), points.count() // RANGE_ROWS + 1)
    edges = range_edges(points, "low", ranges)
    cut = grid_bucket(points, "low", edges, "part") if edges else points.withColumn("part", F.lit(0))
    cut = cut.select(F.col("part").cast("long").alias("part"), "low", F.col("low").alias("high"), "rows", "positives")
    pools = materialise(cut.groupBy("part").applyInPandas(_pooled("part"), POOLS), "pools")
    for step in range(1, len(edges).bit_length() + 1):
        overlap = _overlap(pools, step)
        if overlap.isEmpty():
            continue
        marked = pools.join(F.broadcast(overlap), F.shiftright("part", step) == F.col("pair"), "left")  # a row a pair
        rate, right = F.col("positives") / F.col("rows"), F.shiftright("part", step - 1).bitwiseAND(F.lit(1).cast("long")) == 1
        open_ = F.coalesce(F.when(right, rate <= F.col("top")).otherwise(rate >= F.col("bottom")), F.lit(False))
        marked = marked.withColumn("open", open_).withColumn("first", F.shiftleft(F.shiftright("part", step), step))
        names = ["part", "low", "high", "rows", "positives"]
        # joined pools lie on the left side of their pair; the order of pools is that of their scores throughout
        joined = marked.where("open").groupBy("pair").applyInPandas(_pooled("first"), POOLS)
        pools = materialise(marked.where("not open").select(*names).unionByName(joined), "pools")
    return pools.select("low", "high", "rows", "positives", (F.col("positives") / F.col("rows")).alias("rate"))


def curve_points(pools: DataFrame) -> DataFrame:
    """(score, rate) at both ends of each pool: between them the curve is a straight line, beyond them it is flat."""
    return pools.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("score"), "rate")


def apply_curve(scores: np.ndarray, points: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """The calibrated value of each score: interpolated, clipped at both ends."""
    return np.interp(scores, points, rates)
