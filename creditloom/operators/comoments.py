"""Pairwise co-moments of many columns in one scan.

A task keeps one small matrix for each moment: how many rows have both columns, the means over those rows, the sums of
squares and of products about these means. Matrices of two tasks merge exactly, so a scan sends a few of them on and no
cell is ever dealt out. A batch is centred before multiplying, so large offsets cost no digits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators.merging import merged_state


class CoMoments:
    """n[a, b] rows with both; over these mean[a, b] and square[a, b] of a, product[a, b] of both.

    low[a, b] and high[a, b] are the range of a as far as it has to be known: infinite once a is seen to vary.
    """

    def __init__(self, n, mean, square, product, low, high):
        self.n, self.mean, self.square, self.product, self.low, self.high = n, mean, square, product, low, high

    @staticmethod
    def of(x: np.ndarray) -> CoMoments:
        """Of the rows of ``x``; NaN is missing."""
        there = ~np.isnan(x)
        filled = np.where(there, x, 0.0)
        count = np.maximum(there.sum(0), 1)
        centre = filled.sum(0) / count
        off = np.where(there, x - centre, 0.0)
        mask = there.astype(float)
        n = mask.T @ mask
        safe = np.maximum(n, 1)
        mean = (off.T @ mask) / safe
        square = (off * off).T @ mask - safe * mean * mean
        product = off.T @ off - safe * mean * mean.T
        # Only a pair that varies has a correlation. Where the squares leave that open, its range is looked up.
        low, high = np.full(n.shape, -np.inf), np.full(n.shape, np.inf)
        for a, b in np.argwhere(square <= 1e-9 * (square + safe * mean * mean)):
            both = there[:, a] & there[:, b]
            low[a, b], high[a, b] = x[both, a].min(initial=np.inf), x[both, a].max(initial=-np.inf)
        return CoMoments(n, np.where(n > 0, mean + centre[:, None], 0.0), square, product, low, high)

    def merged(self, other: CoMoments) -> CoMoments:
        n = self.n + other.n
        share = other.n / np.maximum(n, 1)
        shift = other.mean - self.mean
        weight = self.n * share
        return CoMoments(n, self.mean + shift * share, self.square + other.square + weight * shift * shift,
                         self.product + other.product + weight * shift * shift.T,
                         np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product, self.low, self.high]).tobytes()

    @staticmethod
    def unpacked(state: bytes) -> CoMoments:
        flat = np.frombuffer(state)
        return CoMoments(*flat.reshape(6, int(round((len(flat) / 6) ** 0.5)), -1))

    def correlations(self) -> np.ndarray:
        """Pearson correlation over complete pairs; NaN where a side does not vary or fewer than two rows have both."""
        varied = (self.n > 1) & (self.low < self.high) & (self.low < self.high).T
        with np.errstate(all="ignore"):
            return np.where(varied, self.product / np.sqrt(self.square * self.square.T), np.nan)


def co_moments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """One scan over ``columns`` (numeric; NULL and NaN are missing, infinite values are not allowed)."""
    size = len(columns)

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
                own = CoMoments.of(x)
                total = own if total is None else total.merged(own)
        return total.packed() if total else None

    def merge(a, b):
        return CoMoments.unpacked(a).merged(CoMoments.unpacked(b)).packed()

    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    state = merged_state(doubles, partial, merge)
    return CoMoments.unpacked(state) if state else CoMoments.of(np.zeros((0, size)))


def _table(df: DataFrame, rows: list, names: Sequence[str]) -> DataFrame:
    kinds = [T.StructField(n, T.StringType()) for n in names]
    schema = T.StructType([*kinds, T.StructField("correlation", T.DoubleType())])
    return df.sparkSession.createDataFrame([(*r[:-1], None if pd.isna(r[-1]) else float(r[-1])) for r in rows], schema)


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, other, correlation) for each pair of columns, the later one first."""
    found = co_moments(df, columns).correlations()
    return _table(df, [(a, columns[j], found[i, j]) for i, a in enumerate(columns) for j in range(i)], ["feature", "other"])


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, correlation) of each column with ``target``."""
    found = co_moments(df, [*columns, target]).correlations()[:, -1]
    return _table(df, list(zip(columns, found[:-1])), ["feature"])
