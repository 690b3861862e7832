"""Training, search and comparison on Spark ML."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom import policy
from creditloom.operators import logistic, metrics, staging, thresholds
from creditloom.operators.boosting import BoostedTrees
from creditloom.operators.encoding import add_class_weight, class_weights
from creditloom.operators.scoring import ScoringModel, predict
from creditloom.session import materialise

SEED = 42
WEIGHT = "class_weight"
TOLERANCE = 1e-9      # of the loss, so that the gradient at the end is small as well

# Default hyper-parameters per model.
PARAMETERS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000, "balanced": True},
    "random_forest": {"trees": 300, "depth": 10, "min_rows": 50, "balanced": True},
    "boosted_trees": {"trees": 500, "depth": 6, "step": 0.05, "row_share": 0.8, "column_share": 0.8, "balanced": False},
    "boosted_trees_balanced": {"trees": 500, "depth": 6, "step": 0.05, "row_share": 0.8, "column_share": 0.8, "balanced": True},
}
COMPARISON = {
    "baseline_two_features": ("logistic_regression", {"scaled": True}),
    "logistic_regression": ("logistic_regression", {"scaled": True, "max_iter": 500}),
    "random_forest": ("random_forest", {"trees": 80, "min_rows": 100}),
    "boosted_trees": ("boosted_trees", {"trees": 180, "depth": 4, "step": 0.06, "row_share": 0.85, "column_share": 0.85}),
    "boosted_trees_balanced": ("boosted_trees_balanced", {"trees": 250, "row_share": 0.85, "column_share": 0.85}),
}
BASELINE_FEATURES = ("fico_range_low", "grade_enc")


def fit_standardiser(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, one scan (G1)."""
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardise(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale; a constant column is only centred."""
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s or 1.0)
                           for c, (m, s) in fitted.items()})


def build_estimator(kind: str, features: Sequence[str], rows: int, label: str = policy.TARGET,
                    **overrides) -> Pipeline:
    """An unfitted pipeline: assemble, optionally scale, classify."""
    if kind not in PARAMETERS:
        raise ValueError(f"Unknown model: {kind}. Choose from {sorted(PARAMETERS)}")
    p = {**PARAMETERS[kind], **overrides}
    stages = [VectorAssembler(inputCols=list(features), outputCol="assembled")]
    column = "assembled"
    if p.get("scaled"):
        stages.append(StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True))
        column = "scaled"
    common = {"featuresCol": column, "labelCol": label}
    if p["balanced"]:
        common["weightCol"] = WEIGHT
    if kind == "logistic_regression":
        # sum(loss) * C + |w|^2 / 2 is, divided by C * rows, Spark's mean loss + regParam * |w|^2 / 2.
        model = LogisticRegression(regParam=1.0 / (p["C"] * rows), elasticNetParam=0.0,
                                   standardization=False, maxIter=p["max_iter"], tol=TOLERANCE, **common)
    elif kind == "random_forest":
        model = RandomForestClassifier(numTrees=p["trees"], maxDepth=p["depth"], minInstancesPerNode=p["min_rows"],
                                       seed=SEED, **common)
    else:
        model = BoostedTrees(maxIter=p["trees"], maxDepth=p["depth"], stepSize=p["step"],
                             subsamplingRate=p["row_share"], featureSubsetStrategy=str(p["column_share"]),
                             minInstancesPerNode=p.get("min_rows", 1), minInfoGain=p.get("min_gain", 0.0),
                             seed=SEED, **common).of(features)
    return Pipeline(stages=[*stages, model])


@dataclass(frozen=True)
class Trained:
    model: ScoringModel
    seconds: float
    rows: int
    parameters: dict


def train(df: DataFrame, kind: str, features: Sequence[str], version: str = "unversioned", **overrides) -> Trained:
    """Fit one model on a training frame; the threshold is set afterwards."""
    policy.refuse_leakage(features)
    policy.require_features(df.columns, features)
    weights = class_weights(df)
    rows = weights.negatives + weights.positives
    needed = [*features, policy.TARGET]
    fit_on = add_class_weight(df.select(*needed), weights)
    start = time.time()
    estimator = build_estimator(kind, features, rows, **overrides)
    if kind == "logistic_regression":
        pipeline = logistic.fit_pipeline(estimator.getStages(), fit_on, features)
    else:
        pipeline = estimator.fit(fit_on)
    seconds = time.time() - start
    return Trained(ScoringModel(pipeline, list(features), 0.5, version, kind), seconds, rows,
                   {**PARAMETERS[kind], **overrides})


def with_threshold(model: ScoringModel, validation: DataFrame) -> ScoringModel:
    """Put the best-F1 threshold of the validation window into the model."""
    scored = predict(validation, model, keep=[policy.TARGET])
    best = thresholds.best_f1(scored).first()
    return ScoringModel(model.pipeline, model.features, best["threshold"], model.version, model.model_type,
                        model.probability, model.metrics)


def score_windows(features: DataFrame, models: dict[str, ScoringModel],
                  windows: Sequence[str] = ("validation", "test")) -> DataFrame:
    """One stored score table (model, split, default, pd): scored once, measured often."""
    chosen = features.filter(F.col("split").isin(*windows))
    out = None
    for name, model in models.items():
        part = predict(chosen, model, keep=[policy.KEY, "split", policy.TARGET]).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return materialise(out, "scores")


def evaluate(scores: DataFrame, threshold: float) -> dict[str, float]:
    """ROC-AUC, average precision, KS, Brier, log loss and F1 at a threshold."""
    row = metrics.all_metrics(scores).first()
    at = metrics.metrics_at(scores, threshold, digits=6).first()
    return {"roc_auc": row["roc_auc"], "pr_auc": row["pr_auc"], "ks_stat": row["ks_stat"],
            "brier": row["brier"], "log_loss": row["log_loss"], "f1": at["f1"]}


def window_figures(validation: DataFrame, test: DataFrame, threshold: float) -> dict[str, float]:
    """The published figures of a model, from its scores of both windows."""
    on_validation, on_test = evaluate(validation, threshold), evaluate(test, threshold)
    return {"val_roc_auc": on_validation["roc_auc"], "val_avg_precision": on_validation["pr_auc"],
            "val_f1": on_validation["f1"], "test_roc_auc": on_test["roc_auc"],
            "test_avg_precision": on_test["pr_auc"], "test_f1": on_test["f1"], "test_brier": on_test["brier"]}


def measured(model: ScoringModel, features: DataFrame) -> ScoringModel:
    """The model with the figures of its own scores, at the best-F1 threshold of the validation window."""
    scores = score_windows(features, {model.version: model})
    validation, test = (scores.filter(F.col("split") == s) for s in ("validation", "test"))
    threshold = thresholds.best_f1(validation).first()["threshold"]
    return replace(model, threshold=threshold, metrics=window_figures(validation, test, threshold))


def train_and_evaluate(features: DataFrame, kind: str, columns: Sequence[str], version: str = "run",
                       **overrides) -> tuple[ScoringModel, DataFrame]:
    """Fit on train, threshold on validation, measure on test (G10); model and its run row."""
    trained = train(features.filter(F.col("split") == "train"), kind, columns, version, **overrides)
    scores = score_windows(features, {kind: trained.model})
    validation = scores.filter(F.col("split") == "validation")
    test = scores.filter(F.col("split") == "test")
    best = thresholds.best_f1(validation).first()
    figures = window_figures(validation, test, best["threshold"])
    model = ScoringModel(trained.model.pipeline, list(columns), best["threshold"], version, kind, metrics=figures)
    return model, run_row(features, trained, model)


def run_row(features: DataFrame, trained: Trained, model: ScoringModel, strategy: str = "time_based_issue_d") -> DataFrame:
    """Metadata of one trained model, ready to append to a runs table."""
    sizes = features.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "validation", "test")])
    return sizes.select(
        F.lit(model.version).alias("run_id"), F.lit(model.model_type).alias("model_type"),
        F.round(F.lit(model.threshold), 4).alias("threshold"), F.lit(strategy).alias("split_strategy"),
        F.array(*[F.lit(c) for c in model.features]).alias("feature_columns"),
        F.lit(json.dumps(trained.parameters, sort_keys=True)).alias("parameters"),
        *[F.round(F.lit(float(v)), 6).alias(n) for n, v in model.metrics.items()],
        F.round(F.lit(trained.seconds), 1).alias("train_seconds"), "n_train", "n_validation", "n_test")


def baseline(features: DataFrame, tuned: dict[str, float] | None = None) -> tuple[ScoringModel, DataFrame]:
    """The two-feature logistic model with coefficients and metrics (G3) and uplift."""
    columns = list(BASELINE_FEATURES)
    complete = features.select(policy.KEY, *columns, policy.TARGET, "split").dropna(subset=[*columns, policy.TARGET])
    trained = train(complete.filter(F.col("split") == "train"), "logistic_regression", columns, scaled=True)
    fitted = trained.model.pipeline.stages[-1]
    scores = score_windows(complete, {"baseline": trained.model})
    out = {f"coef_{c}": round(float(v), 4) for c, v in zip(columns, fitted.coefficients)}
    out["intercept"] = round(float(fitted.intercept), 5)
    measured = {r["split"]: r for r in metrics.all_metrics(scores, group="split").collect()}
    for window, tag in (("validation", "val"), ("test", "test")):
        for m in ("roc_auc", "pr_auc", "ks_stat", "log_loss"):
            out[f"{tag}_{m}"] = round(measured[window][m], 5)
    if tuned:
        out["test_roc_auc_delta"] = round(tuned["roc_auc"] - out["test_roc_auc"], 5)
        out["test_pr_auc_delta"] = round(tuned["pr_auc"] - out["test_pr_auc"], 5)
    row = complete.agg(F.count(F.lit(1)).alias("rows")).select(*[F.lit(v).alias(n) for n, v in out.items()], "rows")
    return trained.model, row


def uplift(results: DataFrame, baseline_name: str) -> DataFrame:
    """Every model's gain in ROC-AUC and PR-AUC over the baseline."""
    base = results.filter(F.col("model") == baseline_name).select(
        F.col("roc_auc").alias("base_roc"), F.col("pr_auc").alias("base_pr"), F.lit(1).alias("_one"))
    return (results.filter(F.col("model") != baseline_name).withColumn("_one", F.lit(1))
            .join(F.broadcast(base), "_one")
            .select("model", F.round(F.col("roc_auc") - F.col("base_roc"), 5).alias("roc_auc_delta"),
                    F.round(F.col("pr_auc") - F.col("base_pr"), 5).alias("pr_auc_delta")))


# Search space as (low, high, logarithmic).
SEARCH_SPACE = {"depth": (4, 12, False), "min_rows": (10, 200, False), "step": (0.005, 0.2, True),
                "row_share": (0.5, 1.0, False), "column_share": (0.5, 1.0, False), "min_gain": (0.0, 1.0, False)}


def draw_trials(count: int, seed: int = SEED, space: dict | None = None) -> list[dict]:
    """Seeded random draws from a bounded space."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        trial = {}
        for name, (low, high, log) in (space or SEARCH_SPACE).items():
            if isinstance(low, int):
                trial[name] = rng.randint(low, high)
            elif log:
                trial[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                trial[name] = rng.uniform(low, high)
        out.append(trial)
    return out


TRIALS = ("trial int, rung int, trees int, val_roc_auc double, val_avg_precision double, parameters string")

#: Bytes that Spark's trainer keeps of a training row for as long as a fit lasts, beside 4 a feature: its binned point, label,
#: count, prediction and error (420 in all measured with 54 features). ``boosting`` keeps less, so this is an upper bound.
ROW_BYTES = 204


def storage_bytes(spark: SparkSession) -> int:
    """Memory of all executors that cached rows may hold and no running task takes from them."""
    context = spark.sparkContext
    own = context._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    found, each = {}, context._jsc.sc().getExecutorMemoryStatus().iterator()
    while each.hasNext():
        entry = each.next()
        found[entry._1()] = entry._2()._1()
    if len(found) > 1:
        found.pop(own, None)  # the driver caches rows only where it is the one executor
    return int(sum(found.values()) * float(spark.conf.get("spark.memory.storageFraction", "0.5")))


def fits_at_once(memory: int, rows: int, columns: int, most: int) -> int:
    """How many of ``most`` boosted fits have their cached training rows in memory side by side; one at least."""
    return max(1, min(most, memory // max(1, rows * (4 * columns + ROW_BYTES))))


def search(features: DataFrame, columns: Sequence[str], trials: int, trees: int = 100,
           kind: str = "boosted_trees_balanced", space: dict | None = None, seed: int = SEED) -> DataFrame:
    """Random search maximising validation ROC-AUC; the trial table."""
    return halving_search(features, columns, trials, (trees,), 1, kind, space, seed)


def halving_search(features: DataFrame, columns: Sequence[str], trials: int = 27, rungs: Sequence[int] = (30, 90, 270),
                   keep: int = 3, kind: str = "boosted_trees_balanced", space: dict | None = None, seed: int = SEED,
                   side_by_side: int = 4) -> DataFrame:
    """Successive halving: all trials with few trees, the best 1/``keep`` of them with more, and so on.

    Features are assembled and written once for all trials, and so are binned training rows. A trial that goes on takes
    its trees along to the next rung and adds the missing ones. The trials of a rung run side by side, each in a scheduler
    pool of its own (with FAIR scheduling they share the cluster evenly), so the small jobs of one fill the gaps of
    another, but no more at a time than ``fits_at_once`` says, one at least. Draws depend on the seed
    alone, ties go to the earlier trial, so the same trials go on every time. One row a trial and rung.
    """
    if kind not in ("boosted_trees", "boosted_trees_balanced"):
        raise ValueError(f"Halving grows ensembles tree by tree, so {kind} can't be searched")
    spark = features.sparkSession
    policy.refuse_leakage(columns)
    policy.require_features(features.columns, columns)
    weights = class_weights(features.filter(F.col("split") == "train"))
    rows = add_class_weight(features.filter(F.col("split").isin("train", "validation")), weights)
    assembled = materialise(VectorAssembler(inputCols=list(columns), outputCol="assembled").transform(rows)
                            .select("assembled", WEIGHT, policy.TARGET, "split"), "assembled")
    binned = build_estimator(kind, columns, 1).getStages()[-1].bin(rows.filter(F.col("split") == "train"))
    train_rows, validation = (assembled.filter(F.col("split") == s) for s in ("train", "validation"))
    drawn, grown = draw_trials(trials, seed, space), {}
    at_once = fits_at_once(storage_bytes(spark), weights.negatives + weights.positives, len(columns), side_by_side)

    def run(number: int, size: int) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{number}")
        try:
            stage = build_estimator(kind, columns, weights.negatives + weights.positives, trees=size,
                                    **drawn[number]).getStages()[-1].on(binned, grown.get(number, ()))
            scored = stage.fit(train_rows).transform(validation)
            grown[number] = stage.grown
            row = metrics.rank_metrics(scored.select(policy.TARGET, vector_to_array("probability")[1].alias("pd"))).first()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return row["roc_auc"], row["pr_auc"]

    log, left = [], list(range(trials))
    for rung, size in enumerate(rungs):
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            found = list(pool.map(inheritable_thread_target(spark)(run), left, [size] * len(left)))
        log += [(n, rung, size, roc, pr, json.dumps({**drawn[n], "trees": size}, sort_keys=True))
                for n, (roc, pr) in zip(left, found)]
        best = sorted(zip(left, found), key=lambda x: (-(x[1][0] or 0.0), x[0]))
        left = sorted(n for n, _ in best[:max(1, len(left) // keep)])
    binned.close()
    return spark.createDataFrame(log, TRIALS)


def best_trial(trials: DataFrame) -> dict:
    """Parameters of the best trial of the last rung, the earliest on ties."""
    best = trials.agg(F.max_by("parameters", F.struct("rung", "val_roc_auc", -F.col("trial")))).first()[0]
    return json.loads(best)


def trial_history(trials: DataFrame) -> DataFrame:
    """Best value so far by trial number (G14); one row per trial, a small table."""
    so_far = Window.orderBy(*[c for c in ("rung", "trial") if c in trials.columns]).rowsBetween(Window.unboundedPreceding, 0)
    return trials.select(*[c for c in ("rung",) if c in trials.columns], "trial", "val_roc_auc", F.max("val_roc_auc").over(so_far).alias("best_so_far"))


def refit(features: DataFrame, columns: Sequence[str], parameters: dict,
          kind: str = "boosted_trees_balanced", **overrides) -> Trained:
    """Fit again on training and validation rows."""
    return train(features.filter(F.col("split").isin("train", "validation")), kind, columns, **parameters, **overrides)


def fit_with_early_stop(features: DataFrame, columns: Sequence[str], patience: int = staging.PATIENCE,
                        kind: str = "boosted_trees_balanced", version: str = "early-stop", **overrides) -> staging.Stopped:
    """Boosting on training rows, cut where the validation ROC-AUC was best before patience ran out."""
    trained = train(features.filter(F.col("split") == "train"), kind, columns, version, **overrides)
    return staging.cut_at_best(trained.model, features.filter(F.col("split") == "validation"), patience)


def compare_models(features: DataFrame, columns: Sequence[str], extra: dict[str, Trained] | None = None,
                   plan: dict | None = None) -> DataFrame:
    """All models on the same windows, one metrics row each, best ROC-AUC first.

    All models' scores go into one stored table, which is then measured in one
    pass per metric family instead of one per model.
    """
    train_rows = features.filter(F.col("split") == "train")
    fitted: dict[str, Trained] = {}
    for name, (kind, overrides) in (plan or COMPARISON).items():
        used = list(BASELINE_FEATURES) if name == "baseline_two_features" else list(columns)
        fitted[name] = train(train_rows, kind, used, **overrides)
    fitted.update(extra or {})
    clip = metrics.COMPARISON_CLIP
    scores = score_windows(features, {n: t.model for n, t in fitted.items()}).withColumn(
        "pd", F.least(F.lit(1 - clip), F.greatest(F.lit(clip), F.col("pd"))))
    validation, test = (scores.filter(F.col("split") == s) for s in ("validation", "test"))
    measured = metrics.all_metrics(test, group="model", clip=clip)
    picked = {n: thresholds.best_f1(validation.filter(F.col("model") == n)).first()["threshold"] for n in fitted}
    limits = F.create_map(*[F.lit(x) for n, t in picked.items() for x in (n, float(t))])
    limit = F.element_at(limits, F.col("model"))
    hit = F.col("pd") >= limit
    counted = test.groupBy("model").agg(
        F.count_if(hit & (F.col(policy.TARGET) == 1)).alias("tp"), F.count_if(hit & (F.col(policy.TARGET) == 0)).alias("fp"),
        F.count_if(~hit & (F.col(policy.TARGET) == 1)).alias("fn"), F.count(F.lit(1)).alias("n_test"))
    facts = F.create_map(*[x for n, t in fitted.items() for x in (F.lit(n), F.struct(
        F.lit(round(t.seconds, 3)).alias("seconds"), F.lit(t.rows).alias("rows"),
        F.lit(len(t.model.features)).alias("features")))])
    fact = F.element_at(facts, F.col("model"))
    f1 = metrics.ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return (measured.join(F.broadcast(counted), "model")
            .select("model", F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"),
                    F.round("brier", 6).alias("brier_score"), F.round("log_loss", 6).alias("log_loss"),
                    F.round(f1, 6).alias("f1"), F.round(limit, 6).alias("threshold"),
                    fact["seconds"].alias("training_seconds"), fact["rows"].cast("bigint").alias("n_train"), "n_test",
                    fact["features"].alias("feature_count"))
            .orderBy(F.desc("roc_auc"), "model"))


def comparison_summary(results: DataFrame, production: str | None = None) -> DataFrame:
    """Best ranking, best calibrated, and production pick of a comparison table."""
    row = results.agg(
        F.max_by("model", F.struct("roc_auc", "pr_auc", "model")).alias("ranking"),
        F.min_by("model", F.struct("brier_score", "log_loss", "model")).alias("calibrated_probability"),
        F.max(F.when(F.col("model") == F.lit(production), F.col("model"))).alias("kept"))
    return row.select("ranking", "calibrated_probability",
                      F.coalesce("kept", "calibrated_probability").alias("production_recommendation"))
