"""J: calibration."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks import frames, learned
from checks.registry import check
from checks.section_models import _LONG, _kept, _probability, _promise, _scored, auc_by_ranks, compared, gradient
from creditloom.operators import calibration, metrics, scoring


@check("j1_sigmoid", _promise("converged", "order_is_kept", "probabilities"))
def j1(spark, d):
    """Platt scaling: the gradient vanishes at its two coefficients, and no two scores change places."""
    base, features = learned.boosted(spark, d), learned.features(spark, d)
    validation = features.filter("split = 'validation'")
    model = calibration.calibrate(base, validation, "sigmoid")
    scored = _scored(spark, d, model)
    both = scoring.predict(scoring.predict(features.filter("split = 'test'"), base, "raw"), model, keep=["raw"])
    steps = both.distinct().select("raw", "pd", F.lag("pd").over(Window.orderBy("raw")).alias("before"))
    return _kept(scored, converged=gradient(validation, model, 1.0 / validation.count(), None) < 1e-4,
                 order_is_kept=steps.filter("pd < before").isEmpty(), probabilities=_probability())


@check("j2_isotonic", frames.PREP + "SELECT split, count(*) AS loans, CAST(0 AS BIGINT) AS outside, true AS mean_is_base_rate "
       "FROM fit WHERE split = 'validation' GROUP BY split")
def j2(spark, d):
    """On the rows it was fitted on an isotonic calibrator keeps the base rate."""
    validation = learned.features(spark, d).filter("split = 'validation'")
    model = calibration.calibrate(learned.boosted(spark, d), validation, "isotonic")
    scored = scoring.predict(validation, model, keep=["split", "default"])
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("loans"), F.count_if(_outside("pd")).alias("outside"),
        (F.abs(F.avg("pd") - F.avg("default")) < 1e-6).alias("mean_is_base_rate"))


@check("j2_isotonic_pools", frames.PREP + """,
x AS (SELECT pd, count(*) AS n, sum("default") AS y, row_number() OVER (ORDER BY pd) AS i FROM fit WHERE split = 'validation' GROUP BY pd),
c AS (SELECT i, pd, n, y, sum(n) OVER (ORDER BY i) AS cn, sum(y) OVER (ORDER BY i) AS cy FROM x),
f AS (SELECT a.i AS a, b.i AS i, min((b.cy - a.cy + a.y) / (b.cn - a.cn + a.n)::DOUBLE) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS m
      FROM c a JOIN c b ON b.i >= a.i),
r AS (SELECT i, max(m) AS rate FROM f GROUP BY i)
SELECT min(pd) AS low, max(pd) AS high, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(y) AS BIGINT) AS positives, round(rate, 9) AS rate
FROM c JOIN r USING (i) GROUP BY rate""")
def j2_pools(spark, d):
    """Pools of the stored scores, against the max-min formula of isotonic regression."""
    from creditloom.operators import isotonic
    validation = frames.scores(spark, d).filter("split = 'validation'")
    return isotonic.isotonic_pools(validation).withColumn("rate", F.round("rate", 9))


def _outside(column):
    return F.coalesce(~F.col(column).between(0, 1) | F.isnan(column), F.lit(True))


@check("j3_apply_calibrator", frames.PREP + "SELECT loan_id, true AS in_range, true AS sums_to_one, true AS label_follows, "
       "true AS served_is_second FROM fit WHERE split = 'test'")
def j3(spark, d):
    """The calibrator's own vector and label, and that what is served is the vector's second entry."""
    f = learned.features(spark, d)
    model = calibration.calibrate(learned.boosted(spark, d), f.filter("split = 'validation'"), "sigmoid")
    test = f.filter("split = 'test'")
    served = scoring.predict(test, model, keep=["loan_id"])
    both = vector_to_array(calibration.CALIBRATED)
    own = model.pipeline.transform(test).select("loan_id", both[0].alias("paid"), both[1].alias("bad"), "calibrated_label")
    return own.join(served, "loan_id").select(
        "loan_id", (~_outside("paid") & ~_outside("bad")).alias("in_range"), (F.abs(F.col("paid") + F.col("bad") - 1) < 1e-12).alias("sums_to_one"),
        (F.col("calibrated_label") == (F.col("bad") > F.col("paid")).cast("double")).alias("label_follows"),
        (F.col("pd") == F.col("bad")).alias("served_is_second"))


@check("j4_compare_variants", _LONG + "SELECT variant, roc_auc, pr_auc, brier, log_loss FROM compared")
def j4(spark, d):
    return compared(spark, d)


@check("j5_best_variant", _LONG + """SELECT b.variant AS best_method, round(r.brier - b.brier, 6) AS brier_gain,
  round(r.log_loss - b.log_loss, 6) AS log_loss_gain, round(b.roc_auc - r.roc_auc, 6) AS roc_auc_delta
FROM (SELECT * FROM compared WHERE variant <> 'raw' ORDER BY brier, log_loss, variant LIMIT 1) b CROSS JOIN (SELECT * FROM compared WHERE variant = 'raw') r""")
def j5(spark, d):
    return calibration.best_variant(compared(spark, d))


@check("j4_trained_variants", frames.PREP + "SELECT variant, count(*) AS loans, true AS auc_is_that_of_ranks, true AS brier_and_loss_hold "
       "FROM fit CROSS JOIN (VALUES ('raw'), ('sigmoid'), ('isotonic')) v(variant) WHERE split = 'test' GROUP BY variant")
def j4_trained(spark, d):
    """The variants of a trained model, measured again by plain formulas."""
    done = learned.calibrated(spark, d)
    rows = {r["variant"]: r for r in done.compared.collect()}
    p, y = F.col("pd"), F.col("default")
    clipped = F.greatest(F.lit(metrics.EPSILON), F.least(F.lit(1 - metrics.EPSILON), p))
    plain = {r["variant"]: r for r in done.scores.groupBy("variant").agg(
        F.avg((p - y) ** 2).alias("brier"), F.avg(-F.log(F.when(y == 1, clipped).otherwise(1 - clipped))).alias("loss")).collect()}
    facts = F.create_map(*[x for n, r in rows.items() for x in (F.lit(n), F.struct(
        F.lit(abs(r["roc_auc"] - auc_by_ranks(done.scores.filter(F.col("variant") == n))) < 1e-6).alias("a"),
        F.lit(abs(r["brier"] - plain[n]["brier"]) < 1e-6 and abs(r["log_loss"] - plain[n]["loss"]) < 1e-6).alias("b")))])
    fact = F.element_at(facts, F.col("variant"))
    return done.scores.groupBy("variant").agg(F.count(F.lit(1)).alias("loans")).select(
        "variant", "loans", fact["a"].alias("auc_is_that_of_ranks"), fact["b"].alias("brier_and_loss_hold"))


@check("j5_selected_calibration", _promise("lowest_brier_is_kept", "gains_are_differences", "kept_model_gives_its_scores"))
def j5_selected(spark, d):
    """The selection job: what it keeps is the best calibrated variant, with that variant's scores."""
    done = learned.calibrated(spark, d)
    rows, chosen = {r["variant"]: r for r in done.compared.collect()}, done.chosen.first()
    best = min((n for n in rows if n != "raw"), key=lambda n: (rows[n]["brier"], rows[n]["log_loss"], n))
    scored = _scored(spark, d, done.model)
    apart = (scored.select("loan_id", "pd").join(done.scores.filter(F.col("variant") == best).select("loan_id", F.col("pd").alias("was")), "loan_id")
             .agg(F.max(F.abs(F.col("pd") - F.col("was")))).first()[0])
    return _kept(scored, lowest_brier_is_kept=chosen["best_method"] == best,
                 gains_are_differences=abs(chosen["brier_gain"] - (rows["raw"]["brier"] - rows[best]["brier"])) < 2e-6
                 and abs(chosen["log_loss_gain"] - (rows["raw"]["log_loss"] - rows[best]["log_loss"])) < 2e-6,
                 kept_model_gives_its_scores=apart < 1e-12)
