"""Probability calibration on the validation window.

A calibrator is one more stage after the classifier, so the base model is never
touched and the whole is one ``PipelineModel`` that can be stored and served.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.operators import isotonic, metrics
from creditloom.operators.scoring import ScoringModel
from creditloom.session import materialise

METHODS = ("sigmoid", "isotonic")
RAW = "raw_pd"
CALIBRATED = "calibrated"


def calibrate(model: ScoringModel, validation: DataFrame, method: str = "sigmoid",
              label: str = policy.TARGET) -> ScoringModel:
    """Fit a calibrator on the model's raw probabilities (J1, J2) and append it.

    The isotonic curve comes out of ``isotonic_pools``, so only the ends of its pools reach the stage that serves it.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    pick = VectorSlicer(inputCol=model.probability, outputCol=RAW, indices=[1])
    raw = pick.transform(model.pipeline.transform(validation.select(*model.features, label))).select(RAW, label)
    if method == "sigmoid":
        raw = materialise(raw, "raw")  # the fit reads it three times
        rows = raw.count()
        stage = LogisticRegression(featuresCol=RAW, labelCol=label, regParam=1.0 / rows, elasticNetParam=0.0,
                                   standardization=False, maxIter=1000, tol=1e-9, probabilityCol=CALIBRATED,
                                   rawPredictionCol="calibrated_raw", predictionCol="calibrated_label")
    else:
        stage = IsotonicRegression(featuresCol=RAW, labelCol="rate", featureIndex=0, isotonic=True,
                                   predictionCol=CALIBRATED)
        scored = raw.select(vector_to_array(RAW)[0].alias("score"), label)
        raw = isotonic.curve_points(isotonic.isotonic_pools(scored, "score", label)).select(
            array_to_vector(F.array("score")).alias(RAW), "rate")
    pipeline = PipelineModel(stages=[*model.pipeline.stages, pick, stage.fit(raw)])
    return ScoringModel(pipeline, model.features, model.threshold, f"{model.version}-{method}", model.model_type,
                        CALIBRATED, model.metrics)


def compare_variants(scores: DataFrame, variant: str = "variant", label: str = policy.TARGET) -> DataFrame:
    """The four calibration metrics per variant of a long score table."""
    out = metrics.all_metrics(scores, label=label, group=variant)
    return out.select(variant, *[F.round(c, 6).alias(c) for c in ("roc_auc", "pr_auc", "brier", "log_loss")])


def best_variant(compared: DataFrame, variant: str = "variant", raw: str = "raw") -> DataFrame:
    """Best calibrated variant by Brier, then log loss, and its gains over raw."""
    fields = ("brier", "log_loss", "roc_auc")
    row = compared.agg(
        F.min_by(F.struct(F.col(variant).alias("name"), *fields),
                 F.when(F.col(variant) != raw, F.struct("brier", "log_loss", variant))).alias("b"),
        F.max_by(F.struct(*fields), F.when(F.col(variant) == raw, F.lit(1))).alias("r"))
    return row.select(F.col("b.name").alias("best_method"),
                      F.round(F.col("r.brier") - F.col("b.brier"), 6).alias("brier_gain"),
                      F.round(F.col("r.log_loss") - F.col("b.log_loss"), 6).alias("log_loss_gain"),
                      F.round(F.col("b.roc_auc") - F.col("r.roc_auc"), 6).alias("roc_auc_delta"))
