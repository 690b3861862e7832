"""The stored tables of a deployment, from a gzipped raw file to a served model."""

from pyspark.sql import functions as F

from checks.frames import CUTOFFS
from creditloom import policy
from creditloom.operators import scoring
from creditloom.plans.pipeline import Layout, build_cleaned, build_features, build_model
from creditloom.session import fresh_path
from creditloom.sources import tables
from creditloom.sources.loan_view import loan_view


def test_from_raw_file_to_model(spark, folder):
    raw_path, layout = fresh_path(spark, "raw"), Layout(fresh_path(spark, "deployment"))
    tables.write_csv(loan_view(spark, folder), raw_path)
    raw = tables.read_raw_csv(spark, raw_path, partitions=4)
    cleaned = build_cleaned(raw, layout, "2002-01-01")
    assert not set(cleaned.columns) & set(policy.LEAKAGE_COLUMNS)
    assert dict(cleaned.dtypes)["annual_inc"] == "float"
    features, encodings = build_features(spark, layout, CUTOFFS)
    assert features.count() == cleaned.count()
    assert encodings.rows["state_default_rate"] == cleaned.select("addr_state").distinct().count()
    model = build_model(spark, layout, "logistic_regression", "sigmoid", scaled=True, max_iter=20)
    assert model.probability == "calibrated" and 0.01 <= model.threshold <= 0.99
    stored = scoring.load_scoring_model(spark, layout.path("model"))
    assert (stored.threshold, stored.features, stored.version, stored.probability, stored.metrics) == (
        model.threshold, model.features, model.version, model.probability, model.metrics)
    test = features.filter("split = 'test'")
    row = scoring.predict(test, stored, keep=["default"]).agg(F.min("pd"), F.max("pd"), F.count("*")).first()
    assert 0 <= row[0] < row[1] <= 1 and row[2] == test.count()
    run = spark.read.json(layout.path("runs")).first()
    assert run["run_id"] == "run-sigmoid" and run["test_brier"] == round(stored.metrics["test_brier"], 6)
    assert run["n_train"] + run["n_validation"] + run["n_test"] == features.count()


def test_first_existing_table(spark, folder):
    missing = fresh_path(spark, "missing")
    df, label = tables.read_first_existing(spark, [("features", missing), ("cleaned", f"{folder}/orders.parquet")])
    assert label == "cleaned" and df.count() > 0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, t string")
    assert [r["x"] for r in tables.nan_to_null(df).orderBy("t").collect()] == [None, 1.0]
