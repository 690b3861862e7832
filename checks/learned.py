"""Feature table, encodings and small models shared by the checks that need one.

Stored once per session and folder, as a deployment would store them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import frames
from creditloom import policy
from creditloom.operators import encoding, models, splitting
from creditloom.operators import features as fe
from creditloom.plans import jobs
from creditloom.session import materialise

_KEPT: dict = {}


def _once(spark, d, name, make):
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def cleaned(spark, d):
    return _once(spark, d, "cleaned", lambda: materialise(
        splitting.add_fit_flag(frames.cleaned(spark, d), frames.CUTOFFS), "cleaned"))


def encodings(spark, d):
    return _once(spark, d, "encodings", lambda: encoding.fit_encodings(cleaned(spark, d)))


def features(spark, d):
    def make():
        out, _ = fe.engineer_features(cleaned(spark, d), encodings(spark, d), check=False)
        return materialise(splitting.add_split(out, frames.CUTOFFS).drop("is_fit"), "features")
    return _once(spark, d, "features", make)


def columns(spark, d):
    return policy.having("feature", features(spark, d).columns, ["issue_d", "split"])


def train_rows(spark, d):
    return features(spark, d).filter(F.col("split") == "train")


#: Trees of the ensembles that many checks share, and the search that the tuning job runs.
TREES, PATIENCE, RUNGS, MOST = 60, 5, (4, 8, 16), 40
SPACE = {"depth": (2, 4, False), "min_rows": (10, 100, False), "step": (0.05, 0.3, True), "row_share": (0.5, 1.0, False)}
#: Every model of the comparison, at its own settings.
PLAN = models.COMPARISON


def logistic(spark, d):
    """The logistic model at its own settings, with threshold and figures."""
    def make():
        trained = models.train(train_rows(spark, d), "logistic_regression", columns(spark, d), "lr-1", scaled=True)
        return models.measured(trained.model, features(spark, d))
    return _once(spark, d, "logistic", make)


def forest(spark, d):
    return _once(spark, d, "forest", lambda: models.train(
        train_rows(spark, d), "random_forest", columns(spark, d), "rf-1", **models.COMPARISON["random_forest"][1]).model)


def evaluated(spark, d):
    """A boosted model with its run row."""
    return _once(spark, d, "evaluated", lambda: models.train_and_evaluate(
        features(spark, d), "boosted_trees", columns(spark, d), "run-7",
        **{**models.COMPARISON["boosted_trees"][1], "trees": TREES}))


def boosted(spark, d):
    return evaluated(spark, d)[0]


def tuned(spark, d):
    return _once(spark, d, "tuned", lambda: jobs.tune(
        features(spark, d), columns(spark, d), 9, RUNGS, 3, PATIENCE, MOST, space=SPACE))


def stopped(spark, d):
    return tuned(spark, d).stopped


def calibrated(spark, d):
    return _once(spark, d, "calibrated", lambda: jobs.select_calibration(features(spark, d), boosted(spark, d)))


def comparison(spark, d):
    return _once(spark, d, "comparison", lambda: jobs.compare(features(spark, d), columns(spark, d), plan=PLAN))


def explained(spark, d):
    return _once(spark, d, "explained", lambda: jobs.explain(
        features(spark, d).filter("split = 'test'"), boosted(spark, d)))
