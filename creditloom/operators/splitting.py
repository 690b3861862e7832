"""Time windows and exact sampling."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.session import materialise

WINDOWS = ("train", "validation", "test")
STRATEGY = "time_based_issue_d"
HASHES = 1 << 60


@dataclass(frozen=True)
class Cutoffs:
    """First day after training and first day after validation."""

    train_end: str = "2016-01-01"
    validation_end: str = "2017-01-01"


def window_of(day: Column, cutoffs: Cutoffs = Cutoffs()) -> Column:
    """Window name of an issue date."""
    return (F.when(day < F.lit(cutoffs.train_end).cast("date"), F.lit("train"))
            .when(day < F.lit(cutoffs.validation_end).cast("date"), F.lit("validation"))
            .when(day.isNotNull(), F.lit("test")))


def add_split(df: DataFrame, cutoffs: Cutoffs = Cutoffs()) -> DataFrame:
    return df.withColumn("split", window_of(F.col(policy.SPLIT_COLUMN), cutoffs))


def check_split(split: DataFrame) -> dict[str, int]:
    """Rows per window; raises on undated rows (D1) or an empty window."""
    if "split" not in split.columns:
        raise policy.PolicyError(f"No {policy.SPLIT_COLUMN} column to cut the loans by")
    rows = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    if rows.get(None):
        raise policy.PolicyError(f"{rows[None]:,} loans have no readable {policy.SPLIT_COLUMN}")
    for name in WINDOWS:
        if not rows.get(name):
            raise policy.PolicyError(f"No loan falls into the {name} window")
    return {name: rows[name] for name in WINDOWS}


def time_split(df: DataFrame, cutoffs: Cutoffs = Cutoffs(), check: bool = True,
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training, validation and test frames without the date column (D3)."""
    if policy.SPLIT_COLUMN not in df.columns:
        raise policy.PolicyError(f"No {policy.SPLIT_COLUMN} column to cut the loans by")
    split = add_split(df, cutoffs)
    if check:
        check_split(split)
    return tuple(split.filter(F.col("split") == name).drop("split", policy.SPLIT_COLUMN)
                 for name in WINDOWS)


def split_summary(df: DataFrame, cutoffs: Cutoffs = Cutoffs()) -> DataFrame:
    """Rows, default rate and date range per window."""
    day = F.col(policy.SPLIT_COLUMN)
    return (add_split(df, cutoffs).groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"), F.avg(policy.TARGET).alias("default_rate"),
                 F.min(day).alias("start_date"), F.max(day).alias("end_date")))


def add_fit_flag(df: DataFrame, cutoffs: Cutoffs = Cutoffs(),
                 strategy: str = STRATEGY) -> DataFrame:
    """Boolean ``is_fit``: rows encodings may learn from."""
    if strategy != STRATEGY:
        raise policy.PolicyError(f"Strategy {strategy!r} is not supported")
    if policy.SPLIT_COLUMN not in df.columns:
        raise policy.PolicyError(f"No {policy.SPLIT_COLUMN} column to cut the loans by")
    day = F.col(policy.SPLIT_COLUMN)
    return df.withColumn("is_fit", F.coalesce(day < F.lit(cutoffs.train_end).cast("date"),
                                              F.lit(False)))


def train_and_validation(df: DataFrame, cutoffs: Cutoffs = Cutoffs()) -> DataFrame:
    """Rows for the refit: both windows, one scan."""
    day = F.col(policy.SPLIT_COLUMN)
    return add_split(df.filter(day < F.lit(cutoffs.validation_end).cast("date")), cutoffs)


def sample_hash(key: Column, seed: int) -> Column:
    """60 pseudo-random bits of a key, the same on every engine that has MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = policy.KEY) -> DataFrame:
    """Exactly n rows without replacement, repeatable for a given seed (D6): those with the smallest hash, then key.

    One scan counts the rows. The n-th smallest of so many uniform hashes lies close to n / total, so a second scan writes
    the (hash, key) pairs up to a limit a little above that. Of these only the ones beyond a limit a little below, some
    twelve square roots of n, are put in order: the last one taken is the filter. No row is sorted or moved.
    Keys are unique; rows without one are never drawn.
    """
    hashed = df.withColumn("_h", sample_hash(F.col(key), seed))
    total = df.agg(F.count(key)).first()[0]
    if total <= n:
        return df.filter(F.col(key).isNotNull())
    if n <= 0:
        return df.filter(F.lit(False))
    slack = 6 * math.sqrt(n) + 20
    while True:
        low, high = (int(HASHES * min(max(rank / total, 0), 1)) for rank in (n - slack, n + slack))
        near = materialise(hashed.select(F.col("_h"), F.col(key).alias("_k")).filter(F.col("_h") <= F.lit(high)), "sample")
        counted = near.agg(F.count_if(F.col("_h") < F.lit(low)).alias("below"), F.count(F.lit(1)).alias("all")).first()
        if counted["below"] < n <= counted["all"]:
            break
        slack *= 8      # repeated keys share a hash; else one in a hundred million runs comes here
    last = (near.filter(F.col("_h") >= F.lit(low)).orderBy("_h", "_k").limit(n - counted["below"])
            .agg(F.max(F.struct("_h", "_k")).alias("m"), F.count(F.lit(1)).alias("n")).first())
    cut, on_key = F.lit(last["m"]["_h"]), F.lit(last["m"]["_k"])
    taken = (F.col("_h") < cut) | ((F.col("_h") == cut) & (F.col(key) <= on_key))
    return hashed.filter(taken).drop("_h")
