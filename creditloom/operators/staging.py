"""Early stopping by patience on a boosted ensemble (G7): staged scoring and a cut at the best stage.

One pass walks every validation row through the ensemble tree after tree. Each task counts, for each stage, the labels
at each distinct score so far, so what is shuffled are score histograms of the stages, not rows. The exact ROC-AUC of
all stages follows in one grouped pass over them. The ensemble is then cut behind the best stage before patience ran out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom import policy
from creditloom.operators.attribution import ensemble_groups
from creditloom.operators.metrics import auc_term
from creditloom.operators.prefix import default_ranges, range_edges, running_counts
from creditloom.operators.scoring import ScoringModel
from creditloom.session import materialise

PATIENCE = 50      # fixed value: rounds without a gain until boosting counts as done
SLICE_ROWS = 2_000


def leaf_values(x: np.ndarray, tree: Sequence) -> np.ndarray:
    """The value of the leaf that each row of ``x`` ends in."""
    value, left, right, feature, cut = tree
    at = np.zeros(len(x), dtype=np.int64)
    active = np.arange(len(x)) if left[0] >= 0 else np.zeros(0, dtype=np.int64)
    while len(active):
        here = at[active]
        at[active] = np.where(x[active, feature[here]] <= cut[here], left[here], right[here])
        active = active[left[at[active]] >= 0]
    return value[at]


def staged_counts(df: DataFrame, pipeline: PipelineModel, features: Sequence[str],
                  label: str = policy.TARGET) -> DataFrame:
    """(stage, score, pos, neg): labels at each distinct probability of the first 1, 2, ... trees."""
    groups = list(ensemble_groups(pipeline, df.sparkSession))
    if len(groups) > 1:
        raise ValueError("The ensemble is too large to be staged in one pass")
    shared = df.sparkSession.sparkContext.broadcast(groups[0])
    names = [f"f{i}" for i in range(len(features))]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                part = batch.iloc[start:start + SLICE_ROWS]
                x, y = part[names].to_numpy(dtype=float), part["y"].to_numpy()
                margin = np.zeros(len(x))
                for stage, (weight, *tree) in enumerate(shared.value, start=1):
                    margin = margin + weight * leaf_values(x, tree)
                    score, place = np.unique(1.0 / (1.0 + np.exp(-2.0 * margin)), return_inverse=True)
                    pos = np.bincount(place, y == 1, len(score)).astype(np.int64)
                    yield pd.DataFrame({"stage": stage, "score": score, "pos": pos,
                                        "neg": np.bincount(place, minlength=len(score)) - pos})

    narrow = df.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)], F.col(label).cast("int").alias("y"))
    return (narrow.mapInPandas(walk, "stage int, score double, pos long, neg long")
            .groupBy("stage", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def staged_auc(df: DataFrame, pipeline: PipelineModel, features: Sequence[str], label: str = policy.TARGET) -> DataFrame:
    """(stage, roc_auc) of the ensemble's first trees, one row a stage."""
    counts = materialise(staged_counts(df, pipeline, features, label), "stages")
    edges = range_edges(counts, "score", default_ranges(df))
    return running_counts(counts, edges, "stage").groupBy("stage").agg(auc_term().alias("roc_auc"))


def with_patience(stages: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """``stages`` with best_so_far, best_stage (its first stage), and whether boosting still went on before this one.

    Boosting ends after the first stage that lies ``patience`` stages behind the best one. One row a stage: a small table.
    """
    so_far = Window.orderBy("stage").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("stage").rowsBetween(Window.unboundedPreceding, -1)
    seen = stages.withColumns({
        "best_so_far": F.max("roc_auc").over(so_far),
        "best_stage": F.max_by(F.col("stage"), F.struct(F.col("roc_auc"), -F.col("stage"))).over(so_far)})
    ended = F.max((F.col("stage") - F.col("best_stage") >= patience).cast("int")).over(before)
    return seen.withColumn("went_on", F.coalesce(ended, F.lit(0)) == 0)


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The ensemble of the first ``count`` trees."""
    if not 1 <= count <= model.getNumTrees:
        raise ValueError(f"The ensemble has {model.getNumTrees} trees, not {count}")
    context = SparkContext._active_spark_context
    java, jvm, gateway = model._java_obj, context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(jvm.double, count)
    own = java.trees()
    for i, weight in enumerate(model.treeWeights[:count]):
        trees[i], weights[i] = own[i], float(weight)
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights))
    return model._copyValues(cut)


@dataclass(frozen=True)
class Stopped:
    """The cut model, its number of trees, the validation AUC there, and one row a stage."""

    model: ScoringModel
    best_stage: int
    roc_auc: float
    stages: DataFrame


def cut_at_best(model: ScoringModel, validation: DataFrame, patience: int = PATIENCE,
                label: str = policy.TARGET) -> Stopped:
    """Cut a boosted model at the stage with the highest validation ROC-AUC before patience ran out; the earliest on ties."""
    stages = materialise(with_patience(staged_auc(validation, model.pipeline, model.features, label), patience), "stopped")
    best = stages.where("went_on").orderBy(F.desc("roc_auc"), "stage").first()
    if best is None or best["roc_auc"] is None:
        raise ValueError("The validation rows have no ROC-AUC: both classes are needed")
    cut = [first_trees(s, best["stage"]) if isinstance(s, GBTClassificationModel) else s for s in model.pipeline.stages]
    return Stopped(replace(model, pipeline=PipelineModel(stages=cut)), best["stage"], best["roc_auc"], stages)
