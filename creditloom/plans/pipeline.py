"""The three stored tables of a deployment: cleaned, encodings, features; and the model on top.

Each stage reads the table before it, so a lost executor costs a re-read of the
last table and not a recomputation from raw text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.operators import calibration, cleaning, encoding, features, models, scoring, splitting
from creditloom.operators.scoring import ScoringModel
from creditloom.sources import tables


@dataclass(frozen=True)
class Layout:
    """Where the tables live below one folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def build_cleaned(raw: DataFrame, layout: Layout,
                  reference_date: str | None = cleaning.REFERENCE_DATE) -> DataFrame:
    """Raw loans to the cleaned table."""
    tables.write_table(cleaning.clean(raw, reference_date), layout.path("cleaned"))
    return raw.sparkSession.read.parquet(layout.path("cleaned"))


def build_features(spark: SparkSession, layout: Layout,
                   cutoffs: splitting.Cutoffs = splitting.Cutoffs()) -> tuple[DataFrame, encoding.Encodings]:
    """Cleaned table to encodings and the feature table, laid out by window."""
    cleaned = splitting.add_fit_flag(spark.read.parquet(layout.path("cleaned")), cutoffs)
    splitting.check_split(splitting.add_split(cleaned, cutoffs))
    learned = encoding.fit_encodings(cleaned)
    learned.save(layout.path("encodings"))
    out, _ = features.engineer_features(cleaned, learned, check=False)
    tables.write_table(splitting.add_split(out.drop("is_fit"), cutoffs), layout.path("features"), ["split"])
    stored = spark.read.parquet(layout.path("features"))
    features.validate_features(stored)
    return stored, encoding.load_encodings(spark, layout.path("encodings"))


def build_model(spark: SparkSession, layout: Layout, kind: str = "boosted_trees_balanced",
                method: str = "sigmoid", **overrides) -> ScoringModel:
    """Train on the first window, calibrate and choose the threshold on the second.

    Threshold and figures are those of the calibrated scores, stored with the model; ``load_scoring_model`` serves it.
    The runs table grows by one row.
    """
    stored = spark.read.parquet(layout.path("features"))
    columns = policy.having("feature", stored.columns, [policy.SPLIT_COLUMN, "split"])
    base, run = models.train_and_evaluate(stored, kind, columns, **overrides)
    final = models.measured(calibration.calibrate(base, stored.filter("split = 'validation'"), method), stored)
    scoring.save_scoring_model(final, spark, layout.path("model"))
    own = {**{n: F.round(F.lit(float(v)), 6) for n, v in final.metrics.items()}, "run_id": F.lit(final.version),
           "threshold": F.round(F.lit(float(final.threshold)), 4)}
    tables.write_json(run.withColumns(own), layout.path("runs"), mode="append")
    return final
