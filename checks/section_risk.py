"""K: business risk."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.functions.bins import BUSINESS_THRESHOLDS
from creditloom.functions.risk import expected_loss, risk_band
from creditloom.operators import risk

T = frames.PREP
BAND = ("CASE WHEN pd < 0.10 THEN 'Low' WHEN pd < 0.20 THEN 'Medium' WHEN pd < 0.35 THEN 'High' "
        "WHEN pd IS NULL THEN 'Unknown' ELSE 'Very High' END")


@check("k1_expected_loss", T + "SELECT loan_id, round(pd * 0.45 * ead, 6) AS expected_loss, "
       "round(pd * 0.45, 6) AS unit_loss FROM test")
def k1(spark, d):
    df = frames.test_scores(spark, d)
    return df.select("loan_id", F.round(expected_loss(F.col("pd"), F.col("ead")), 6).alias("expected_loss"),
                     F.round(expected_loss(F.col("pd")), 6).alias("unit_loss"))


@check("k2_risk_band", T + f"SELECT loan_id, {BAND} AS risk_band FROM test")
def k2(spark, d):
    return frames.test_scores(spark, d).select("loan_id", risk_band(F.col("pd")).alias("risk_band"))


def _table(points: str, lgd: str) -> str:
    return T + f""", grid AS (SELECT unnest({points}) AS t),
l AS (SELECT *, pd * {lgd} * ead AS el FROM test)
SELECT CAST(t AS DOUBLE) AS threshold, round(count(*) FILTER (pd < t) / CAST(count(*) AS DOUBLE), 9) AS approval_rate,
  round(count(*) FILTER (pd >= t) / CAST(count(*) AS DOUBLE), 9) AS rejection_rate,
  round(coalesce(avg("default") FILTER (pd < t), 0), 9) AS default_rate_approved,
  round(coalesce(sum("default") FILTER (pd >= t), 0) / CAST(greatest(sum("default"), 1) AS DOUBLE), 9) AS defaults_caught_rate,
  round(coalesce(sum(el) FILTER (pd < t), 0), 3) AS expected_loss_approved,
  round(coalesce(sum(el) FILTER (pd >= t), 0), 3) AS expected_loss_rejected, round(sum(el), 3) AS total_expected_loss
FROM grid CROSS JOIN l GROUP BY t"""


def _rounded(df):
    df = rounded(df, 9, "approval_rate", "rejection_rate", "default_rate_approved", "defaults_caught_rate")
    return rounded(df, 3, "expected_loss_approved", "expected_loss_rejected", "total_expected_loss")


@check("k3_business_table", _table(f"{list(BUSINESS_THRESHOLDS)}::DOUBLE[]", "0.45"))
def k3(spark, d):
    return _rounded(risk.business_table(frames.test_scores(spark, d)))


@check("k4_input_checks", T + 'SELECT count(*) AS "rows", count(*) FILTER (pd < 0 OR pd > 1) AS bad_pd, '
       "count(*) FILTER (ead < 0) AS bad_ead FROM test")
def k4(spark, d):
    df = frames.test_scores(spark, d)
    risk.check_risk_inputs(df)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col("pd") < 0) | (F.col("pd") > 1)).alias("bad_pd"),
                  F.count_if(F.col("ead") < 0).alias("bad_ead"))


@check("k5_band_distribution", T + f""", b AS (SELECT {BAND} AS risk_band, ead, pd * 0.45 * ead AS el FROM test),
spine AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High'), (3, 'Very High'), (4, 'Unknown')) v(position, risk_band))
SELECT position, spine.risk_band AS risk_band, count(b.risk_band) AS loans, round(coalesce(sum(ead), 0), 3) AS exposure, round(coalesce(sum(el), 0), 3) AS expected_loss
FROM spine LEFT JOIN b ON spine.risk_band = b.risk_band GROUP BY position, spine.risk_band""")
def k5(spark, d):
    return rounded(risk.band_distribution(frames.test_scores(spark, d)), 3, "exposure", "expected_loss")


@check("k5_unknown", T + f""", g AS (SELECT ead, CASE WHEN loan_id % 7 <> 0 THEN pd END AS pd FROM test),
b AS (SELECT {BAND} AS risk_band, ead, pd * 0.45 * ead AS el FROM g),
spine AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High'), (3, 'Very High'), (4, 'Unknown')) v(position, risk_band))
SELECT position, spine.risk_band AS risk_band, count(b.risk_band) AS loans, round(coalesce(sum(ead), 0), 3) AS exposure,
  CASE WHEN count(b.risk_band) = 0 THEN 0.0::DOUBLE ELSE round(sum(el), 3) END AS expected_loss
FROM spine LEFT JOIN b ON spine.risk_band = b.risk_band GROUP BY position, spine.risk_band""")
def k5_unknown(spark, d):
    df = frames.test_scores(spark, d).withColumn("pd", F.when(F.col("loan_id") % 7 != 0, F.col("pd")))
    return rounded(risk.band_distribution(df), 3, "exposure", "expected_loss")


@check("k6_portfolio_view", _table("[0.275::DOUBLE]", "0.6"))
def k6(spark, d):
    return _rounded(risk.portfolio_view(frames.test_scores(spark, d), 0.275, 0.6))
