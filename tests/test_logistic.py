"""Logistic regression by Newton steps, on rows of its own."""

import pytest
from pyspark.sql import functions as F

from checks.section_models import gradient
from creditloom.operators import encoding, logistic, models, scoring
from creditloom.session import fresh_path
from creditloom.sources import tables


@pytest.fixture(scope="module")
def nearly_collinear(spark):
    """Four columns, three of them all but the same, far from zero and of different size."""
    k = F.col("id")
    noise = lambda p: (k * p) % 1009 / 1009.0
    a = 5000 + 1000 * noise(37)
    rows = spark.range(4000).select(
        k.alias("loan_id"), a.alias("a"), (a * 0.03 + noise(101) * 1e-3).alias("b"), (a + 0.1 * noise(211)).alias("c"), noise(53).alias("d"),
        ((noise(37) + noise(53) + noise(419)) > 1.6).cast("int").alias("default"))
    return rows.withColumn("class_weight", F.lit(1.0) + F.col("default"))


def test_the_gradient_vanishes_after_few_passes(spark, nearly_collinear, monkeypatch):
    passes, sums = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *a: passes.append(1) or sums(*a))
    features = ["a", "b", "c", "d"]
    trained = models.train(nearly_collinear.drop("class_weight"), "logistic_regression", features, scaled=True)
    rows = encoding.add_class_weight(nearly_collinear.drop("class_weight"), encoding.class_weights(nearly_collinear))
    assert gradient(rows, trained.model, 1.0 / trained.rows) < 1e-10
    assert len(passes) < 30


@pytest.mark.parametrize("scaled", [True, False])
def test_same_model_as_spark_own(spark, nearly_collinear, scaled):
    features = ["b", "d"]
    estimator = models.build_estimator("logistic_regression", features, 4000, scaled=scaled)
    own = logistic.fit_pipeline(estimator.getStages(), nearly_collinear, features)
    other = estimator.fit(nearly_collinear)
    got, want = own.stages[-1], other.stages[-1]
    assert max(abs(x - y) for x, y in zip([*got.coefficients, got.intercept], [*want.coefficients, want.intercept])) < 1e-3
    pd = lambda p: {r["loan_id"]: r["probability"][1] for r in p.transform(nearly_collinear).collect()}
    mine, theirs = pd(own), pd(other)
    assert max(abs(mine[k] - theirs[k]) for k in mine) < 1e-5
    assert got.getRegParam() == want.getRegParam() and got.getFeaturesCol() == want.getFeaturesCol()


def test_stored_model_and_missing_values(spark, nearly_collinear):
    rows = nearly_collinear.drop("class_weight")
    model = models.train(rows, "logistic_regression", ["b", "d"], scaled=True).model
    path = fresh_path(spark, "newton")
    tables.save_model(model.pipeline, path)
    again = scoring.ScoringModel(tables.load_model(path), model.features, 0.5)
    assert scoring.predict(rows, again, "pd").exceptAll(scoring.predict(rows, model, "pd")).isEmpty()
    with pytest.raises(Exception, match="(?i)null|nan"):
        models.train(rows.withColumn("d", F.when(F.col("loan_id") != 7, F.col("d"))), "logistic_regression", ["b", "d"], scaled=True)
