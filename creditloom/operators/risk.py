"""Portfolio risk tables (K1 to K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.bins import BUSINESS_THRESHOLDS
from creditloom.functions.numeric import missing, ratio
from creditloom.functions.risk import BAND_ORDER, DEFAULT_LGD, expected_loss, risk_band
from creditloom.operators.metrics import threshold_sweep


def add_risk(df: DataFrame, pd: str = "pd", ead: str | None = "ead", lgd: float = DEFAULT_LGD) -> DataFrame:
    """Expected loss (K1) and risk band (K2) per loan."""
    exposure = F.col(ead) if ead else None
    return df.withColumns({"expected_loss": expected_loss(F.col(pd), exposure, lgd),
                           "risk_band": risk_band(F.col(pd))})


def check_risk_inputs(df: DataFrame, pd: str = "pd", ead: str = "ead", lgd: float = DEFAULT_LGD) -> None:
    """Raise on empty input, missing values or values outside their range, one aggregate (K4)."""
    if not 0 <= lgd <= 1:
        raise ValueError(f"A loss share lies between 0 and 1, not at {lgd}")
    p, e = F.col(pd), F.col(ead)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if((p < 0) | (p > 1)).alias("p"),
                 F.count_if(e < 0).alias("e"), F.count_if(missing(p)).alias("no_p"),
                 F.count_if(missing(e)).alias("no_e")).first()
    if row["n"] == 0:
        raise ValueError("A risk table needs at least one row")
    if row["no_p"] or row["no_e"]:
        raise ValueError(f"{row['no_p']} loans have no {pd} and {row['no_e']} no {ead}")
    if row["p"]:
        raise ValueError("Probabilities must lie in [0, 1]")
    if row["e"]:
        raise ValueError("Exposure must not be negative")


def business_table(df: DataFrame, thresholds: Sequence[float] = BUSINESS_THRESHOLDS,
                   lgd: float = DEFAULT_LGD, pd: str = "pd", ead: str = "ead",
                   label: str = "default", check: bool = True) -> DataFrame:
    """Approval, default and loss figures per threshold (K3); loans below are approved."""
    if check:
        check_risk_inputs(df, pd, ead, lgd)
    loss = expected_loss(F.col(pd), F.col(ead), lgd)
    swept = threshold_sweep(df, list(thresholds), pd, label, {"el": loss})
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = tp + fp + fn + tn
    return swept.select(
        "threshold", ratio(fn + tn, rows).alias("approval_rate"), ratio(tp + fp, rows).alias("rejection_rate"),
        ratio(fn, fn + tn).alias("default_rate_approved"),
        (tp / F.greatest(tp + fn, F.lit(1))).alias("defaults_caught_rate"),
        (F.col("all_el") - F.col("el")).alias("expected_loss_approved"),
        F.col("el").alias("expected_loss_rejected"), F.col("all_el").alias("total_expected_loss"))


def portfolio_view(df: DataFrame, threshold: float, lgd: float = DEFAULT_LGD, **columns: str) -> DataFrame:
    """The business row of one threshold (K6)."""
    return business_table(df, [threshold], lgd, **columns)


def band_distribution(df: DataFrame, lgd: float = DEFAULT_LGD, pd: str = "pd", ead: str = "ead") -> DataFrame:
    """Loans, exposure and expected loss per band; every band appears, and Unknown for loans without a probability (K5).

    The loss of loans without a probability is not known: it is NULL, not 0.
    """
    grouped = (add_risk(df, pd, ead, lgd).groupBy("risk_band")
               .agg(F.count(F.lit(1)).alias("loans"), F.sum(ead).alias("exposure"),
                    F.sum("expected_loss").alias("expected_loss")))
    spine = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(b) for b in (*BAND_ORDER, "Unknown")])).alias("position", "risk_band"))
    return (spine.join(F.broadcast(grouped), "risk_band", "left")
            .withColumns({"loans": F.coalesce("loans", F.lit(0).cast("long")), "exposure": F.coalesce("exposure", F.lit(0.0)),
                          "expected_loss": F.when(F.col("loans").isNull(), F.lit(0.0)).otherwise(F.col("expected_loss"))}))
