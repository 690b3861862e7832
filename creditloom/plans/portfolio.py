"""From raw loans to the portfolio report, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import cleaning, encoding, risk, splitting
from creditloom.sources.loan_view import (REFERENCE_DATE, TRAIN_END, VALIDATION_END, loan_view)

CUTOFFS = splitting.Cutoffs(TRAIN_END, VALIDATION_END)


def exposure_by_band(spark: SparkSession, folder: str) -> DataFrame:
    """Parse, learn purpose rates on the training window, blend them with the stored
    probability, and report exposure and expected loss per band of the test window."""
    raw = loan_view(spark, folder, ["loan_status", "issue_d", "loan_amnt", "purpose", "pd"])
    loans = splitting.add_fit_flag(cleaning.prepare(raw, REFERENCE_DATE), CUTOFFS)
    learned = encoding.fit_encodings(loans)
    rated = learned.apply(loans, "purpose", "purpose_rate_enc")
    tested = splitting.add_split(rated, CUTOFFS).filter(F.col("split") == "test")
    scored = tested.select("loan_id", F.col("loan_amnt").alias("ead"),
                           ((F.col("pd") + F.col("purpose_rate_enc")) / 2).alias("pd"))
    out = risk.band_distribution(scored)
    return out.select("position", "risk_band", "loans", F.round("exposure", 2).alias("exposure"),
                      F.round("expected_loss", 2).alias("expected_loss"))
