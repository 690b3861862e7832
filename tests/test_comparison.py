"""The comparison of the checks runs the whole plan of models."""

from checks import learned
from creditloom.operators import models


def test_comparison_is_given_the_whole_plan(spark, folder, monkeypatch):
    plans = []
    learned.features(spark, folder)
    monkeypatch.setattr(learned, "_KEPT", {k: v for k, v in learned._KEPT.items() if k[2] != "comparison"})
    monkeypatch.setattr(learned.jobs, "compare", lambda features, columns, plan=None: plans.append(plan))
    learned.comparison(spark, folder)
    assert plans == [models.COMPARISON]


def test_summary_is_of_models_of_planned_size(spark, folder, monkeypatch):
    from checks.section_models import g11_summary
    trained, train = [], models.train
    learned.features(spark, folder)

    def small(rows, kind, columns, **settings):
        """Notes what is asked for, and fits something quick instead."""
        trained.append((kind, settings.get("trees")))
        return train(rows, "logistic_regression", list(models.BASELINE_FEATURES) if len(trained) % 2 else ["dti", "int_rate"], scaled=True)

    monkeypatch.setattr(learned, "_KEPT", {k: v for k, v in learned._KEPT.items() if k[2] != "comparison"})
    monkeypatch.setattr(models, "train", small)
    row = g11_summary(spark, folder).first()
    assert row["ranking_is_the_highest"] and row["calibrated_is_the_lowest_brier"] and row["uplift_is_over_the_baseline"]
    assert trained[2:] == [("random_forest", 80), ("boosted_trees", 180), ("boosted_trees_balanced", 250)]
