"""Equal-width bins and threshold grids with exact edges.

The bin number is guessed by division and then checked against the true edge
values, so rounding noise never moves a row across an edge. Everything here is
a plain expression and stays inside code generation.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_grid(start: float, stop: float, count: int) -> list[float]:
    """``count`` evenly spaced points, both ends included."""
    return [float(v) for v in np.linspace(start, stop, count)]


# The grids and cut points the reports are published on.
SWEEP_GRID = (0.001, 0.999, 500)
SEARCH_GRID = (0.01, 0.99, 200)
BUSINESS_THRESHOLDS = tuple(round(0.05 + 0.025 * i, 3) for i in range(19))


def _edge(index: Column, low: float, high: float, bins: int) -> Column:
    step = (high - low) / bins
    exact = index * F.lit(step) + F.lit(low)
    return F.when(index >= bins, F.lit(high)).otherwise(exact)


def left_closed_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of [low, high] with left-closed bins, the last one closed."""
    if high <= low:
        return F.when(value.isNotNull(), F.lit(0))
    guess = F.floor((value - F.lit(low)) / F.lit((high - low) / bins)).cast("int")
    guess = F.greatest(F.lit(0), F.least(F.lit(bins - 1), guess))
    fixed = (F.when(value < _edge(guess, low, high, bins), guess - 1)
             .when((value >= _edge(guess + 1, low, high, bins)) & (guess < bins - 1), guess + 1)
             .otherwise(guess))
    return F.when(value.isNotNull(), fixed)


def right_closed_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of (low, high] with right-closed bins; ``low`` itself is in bin 0."""
    if high <= low:
        return F.when(value.isNotNull(), F.lit(0))
    guess = F.ceil((value - F.lit(low)) / F.lit((high - low) / bins)).cast("int") - 1
    guess = F.greatest(F.lit(0), F.least(F.lit(bins - 1), guess))
    fixed = (F.when((value <= _edge(guess, low, high, bins)) & (guess > 0), guess - 1)
             .when((value > _edge(guess + 1, low, high, bins)) & (guess < bins - 1), guess + 1)
             .otherwise(guess))
    return F.when(value.isNotNull(), fixed)


def count_edges_below(value: Column, edges: list[float]) -> Column:
    """Number of edges strictly below the value (few edges, repeats allowed)."""
    total = F.lit(0)
    for edge in edges:
        total = total + (value > F.lit(float(edge))).cast("int")
    return total


def grid_bucket(df: DataFrame, column: str, grid: list[float], out: str) -> DataFrame:
    """Add the number of grid points at or below the value, 0 to len(grid).

    One binary search per row replaces a join of rows with grid points.
    """
    splits = [float("-inf"), *sorted(grid), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=column, outputCol=out,
                          handleInvalid="keep").transform(df)
    return bucketed.withColumn(out, F.col(out).cast("int"))
