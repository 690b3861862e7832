"""Applications to decisions.

Scoring is one narrow pass: the incoming row travels along as a struct while
its features are built and scored, so nothing has to be joined back. The same
function serves batch tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.functions.risk import risk_band
from creditloom.operators.contract import add_violations, fill_defaults
from creditloom.operators.encoding import Encodings
from creditloom.operators.features import build_features


_METADATA = ("features array<string>, threshold double, version string, model_type string, probability string, "
             "metrics map<string,double>")


@dataclass(frozen=True)
class ScoringModel:
    """A fitted pipeline with the threshold chosen on exactly its own scores."""

    pipeline: PipelineModel
    features: list[str]
    threshold: float
    version: str = "unversioned"
    model_type: str = "unknown"
    probability: str = "probability"
    metrics: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        policy.refuse_leakage(self.features, "Model metadata")


def save_scoring_model(model: ScoringModel, spark: SparkSession, path: str) -> None:
    """The pipeline and one row with all else that serving needs, the threshold first of all."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark.createDataFrame([(list(model.features), float(model.threshold), model.version, model.model_type,
                            model.probability, {k: float(v) for k, v in model.metrics.items()})],
                          _METADATA).coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def load_scoring_model(spark: SparkSession, path: str) -> ScoringModel:
    """What ``save_scoring_model`` stored; it decides as the saved model did."""
    row = spark.read.schema(_METADATA).parquet(f"{path}/metadata").first()
    return ScoringModel(PipelineModel.load(f"{path}/pipeline"), list(row["features"]), row["threshold"], row["version"],
                        row["model_type"], row["probability"], dict(row["metrics"]))


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (policy.KEY,)) -> DataFrame:
    """Exactly the model's features, in order, absent ones, NULL and NaN 0, as float."""
    have = set(df.columns)
    return df.select(*[c for c in keep if c in have], *[
        (F.coalesce(F.when(~F.isnan(F.col(f).cast("float")), F.col(f).cast("float")), F.lit(0.0).cast("float")) if f in have
         else F.lit(0.0).cast("float")).alias(f) for f in features])


def positive_probability(df: DataFrame, column: str) -> Column:
    """Probability of default from a vector or a plain column."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return F.element_at(vector_to_array(column), -1)
    return F.col(column).cast("double")


def predict(df: DataFrame, model: ScoringModel, out: str = "pd", keep: Sequence[str] | None = None) -> DataFrame:
    """Score a feature table; ``keep`` columns (default: all) survive next to ``out``."""
    policy.require_features(df.columns, model.features)
    scored = model.pipeline.transform(df)
    kept = df.columns if keep is None else list(keep)
    return scored.select(*kept, positive_probability(scored, model.probability).alias(out))


def decisions(probability: Column, threshold: float) -> dict[str, Column]:
    return {"prediction": (probability >= F.lit(float(threshold))).cast("int"), "risk_tier": risk_band(probability)}


def score_table(df: DataFrame, model: ScoringModel, encodings: Encodings) -> DataFrame:
    """Every incoming column plus default_probability, prediction, risk_tier."""
    incoming = [c for c in df.columns]
    carried = df.withColumn("_row", F.struct(*incoming))
    built = build_features(carried, encodings, serving=True)
    scored = model.pipeline.transform(align_features(built, model.features, keep=["_row"]))
    probability = scored.select("_row.*", positive_probability(scored, model.probability).alias("default_probability"))
    return probability.withColumns(decisions(F.col("default_probability"), model.threshold))


def judge_and_score(df: DataFrame, model: ScoringModel, encodings: Encodings) -> DataFrame:
    """Validate, fill and score in one pass; rejected rows keep their reasons and get no decision.

    Validity is carried as a column rather than filtered on: a filter over all
    contract rules below this many projections makes Catalyst's constraint
    propagation explode, and it would read the source twice for two outputs.
    """
    scored = score_table(fill_defaults(add_violations(df)), model, encodings)
    fine = F.size("violations") == 0
    return scored.withColumns({c: F.when(fine, F.col(c)) for c in (
        "default_probability", "prediction", "risk_tier")})


def score_applications(df: DataFrame, model: ScoringModel, encodings: Encodings) -> DataFrame:
    """One response per application (F4): a decision, or the reasons for its rejection."""
    judged = judge_and_score(df, model, encodings)
    return judged.select(
        policy.KEY, F.round("default_probability", 6).alias("default_probability"), "prediction",
        F.lit(float(model.threshold)).alias("threshold"), F.col("risk_tier").alias("risk_label"),
        F.lit(model.version).alias("model_version"), "violations")


def batch_kpis(scored: DataFrame) -> DataFrame:
    """Flagged loans, mean probability, loans in the two worst bands."""
    return scored.agg(F.count_if(F.col("prediction") == 1).alias("flagged"),
                      F.avg("default_probability").alias("mean_probability"),
                      F.count_if(F.col("risk_tier").isin("High", "Very High")).alias("high_risk"))


def model_info(df: DataFrame, model: ScoringModel) -> DataFrame:
    """One row about the model, with how many rows it is asked to score."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(model.model_type).alias("model_type"), F.lit(model.version).alias("model_version"),
        F.lit(float(model.threshold)).alias("threshold"), F.lit(len(model.features)).alias("n_features"),
        *[F.lit(float(v)).alias(n) for n, v in model.metrics.items()], "rows")
