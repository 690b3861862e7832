"""What moved each score: per-feature contributions (L1, L2).

Contributions travel with their loan as one array of (feature, value,
contribution), so everything about a single loan stays a narrow expression.
``to_long`` gives the relational form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.session import fresh_path, materialise

MAX_NODES = 5_000_000    # of a group of trees
VALUES, CONTRIBUTIONS = "_values", "_contributions"


def linear_contributions(df: DataFrame, weights: dict[str, float], means: dict[str, float],
                         keep: Sequence[str] = (policy.KEY,)) -> DataFrame:
    """w (x - mean): exact Shapley values of a linear score with independent features (L1)."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                        (F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c])))).alias("contribution"))
               for c, w in weights.items()]
    return df.select(*keep, F.array(*entries).alias("drivers"))


def to_long(attributed: DataFrame) -> DataFrame:
    """One row per loan and feature."""
    keep = [c for c in attributed.columns if c != "drivers"]
    return attributed.select(*keep, F.posexplode("drivers").alias("position", "d")).select(*keep, "position", "d.*")


def _stored_ensemble(pipeline: PipelineModel, spark) -> tuple[DataFrame, list[float]]:
    """The node table of a pipeline's tree ensemble, written out, and its tree weights."""
    stage = next(s for s in pipeline.stages if hasattr(s, "treeWeights"))
    boosted = type(stage).__name__.startswith("GBT")
    path = fresh_path(spark, "ensemble")
    stage.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    value = (F.col("prediction") if boosted else
             F.try_divide(F.get("impurityStats", F.lit(1)), F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)))
    table = nodes.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), value.alias("value"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"))
    weights = [float(w) for w in stage.treeWeights]
    return table, weights if boosted else [1.0 / len(weights)] * len(weights)


def ensemble_groups(pipeline: PipelineModel, spark, most: int = MAX_NODES) -> Iterator[list[tuple]]:
    """The ensemble's trees as (weight, value, left, right, feature, cut), in groups of at most ``most`` nodes.

    One group at a time reaches the driver; a single tree is never cut.
    """
    table, weights = _stored_ensemble(pipeline, spark)
    sizes = [r["count"] for r in table.groupBy("tree").count().orderBy("tree").collect()]
    first = 0
    while first < len(sizes):
        last, held = first, 0
        while last < len(sizes) and (last == first or held + sizes[last] <= most):
            held += sizes[last]
            last += 1
        nodes = table.where(F.col("tree").between(first, last - 1)).toPandas().sort_values(["tree", "node"])
        yield [(weights[int(tree)], *[part[c].to_numpy() for c in ("value", "left", "right", "feature", "cut")])
               for tree, part in nodes.groupby("tree")]
        first = last


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix, in one piece of memory."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _walker(shared, width: int):
    """Adds the contributions of one group of trees to those of the groups before."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, values, before = batch.columns
            x, total = _matrix(values, width), _matrix(before, width).copy()
            rows = np.arange(len(x))
            for weight, value, left, right, feature, cut in shared.value:
                at = np.zeros(len(x), dtype=int)
                active = rows[left[at] >= 0]
                while len(active):
                    here = at[active]
                    split = feature[here]
                    child = np.where(x[active, split] <= cut[here], left[here], right[here])
                    total[active, split] += weight * (value[child] - value[here])  # a row is active once
                    at[active] = child
                    active = active[left[child] >= 0]
            after = pa.ListArray.from_arrays(np.arange(0, total.size + 1, width, dtype=np.int32), total.ravel())
            yield pa.RecordBatch.from_arrays([key, values, after], names=batch.schema.names)
    return walk


def path_contributions(df: DataFrame, pipeline: PipelineModel, features: Sequence[str],
                       key: str = policy.KEY, most: int = MAX_NODES) -> tuple[DataFrame, float]:
    """Key, values and path contributions of a tree ensemble (L2), in the order of ``features``; and the base value.

    Walking from root to leaf, the change of the expected value at each split is
    credited to the split's feature (Saabas 2014). Base value plus contributions
    is the raw margin (boosting) or the mean class share (forest). An ensemble of
    any size is walked in groups of ``most`` nodes, each broadcast on its own;
    between groups the contributions so far are written, so neither driver nor
    worker ever holds more than one group. ``with_drivers`` names the entries; as
    plain numbers they are a quarter as large, so joins come before that.
    """
    names, spark = list(features), df.sparkSession
    # Parquet and Spark ML compare doubles, so features enter as doubles.
    state = df.select(key, F.array(*[F.col(c).cast("double") for c in names]).alias(VALUES),
                      F.array_repeat(F.lit(0.0), len(names)).alias(CONTRIBUTIONS))
    base = 0.0
    for number, trees in enumerate(ensemble_groups(pipeline, spark, most)):
        base += float(sum(weight * value[0] for weight, value, *_ in trees))
        state = state if not number else materialise(state, "contributions")
        state = state.mapInArrow(_walker(spark.sparkContext.broadcast(trees), len(names)), state.schema)
    return state, base


def with_drivers(state: DataFrame, features: Sequence[str]) -> DataFrame:
    """Values and contributions as one array of (feature, value, contribution); other columns stay."""
    drivers = F.transform(F.array(*[F.lit(c) for c in features]), lambda f, i: F.struct(
        f.alias("feature"), F.get(VALUES, i).alias("value"), F.get(CONTRIBUTIONS, i).alias("contribution")))
    return state.select(*[c for c in state.columns if c not in (VALUES, CONTRIBUTIONS)], drivers.alias("drivers"))


def tree_contributions(df: DataFrame, pipeline: PipelineModel, features: Sequence[str],
                       key: str = policy.KEY, most: int = MAX_NODES) -> tuple[DataFrame, float]:
    """``path_contributions`` with the drivers named."""
    state, base = path_contributions(df, pipeline, features, key, most)
    return with_drivers(state, features), base
