"""Training, calibration, attribution and scoring end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from checks import learned
from checks.section_scoring import applications
from creditloom.operators import attribution, calibration, contract, models, scoring
from creditloom.session import fresh_path
from creditloom.sources import tables
from creditloom.streaming.scoring import application_stream, score_stream


@pytest.fixture(scope="module")
def table(spark, folder):
    return learned.features(spark, folder)


@pytest.fixture(scope="module")
def test_rows(table):
    return table.filter("split = 'test'")


def test_logistic_separates(spark, folder, test_rows):
    out = scoring.predict(test_rows, learned.logistic(spark, folder), keep=["default"])
    row = out.groupBy().agg(F.avg(F.when(F.col("default") == 1, F.col("pd"))).alias("bad"),
                            F.avg(F.when(F.col("default") == 0, F.col("pd"))).alias("good"),
                            F.min("pd").alias("low"), F.max("pd").alias("high")).first()
    assert row["bad"] > row["good"] and 0 <= row["low"] and row["high"] <= 1


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibrator_keeps_order_and_base(spark, folder, table, test_rows, method):
    base = learned.boosted(spark, folder)
    model = calibration.calibrate(base, table.filter("split = 'validation'"), method)
    both = scoring.predict(test_rows, base, "raw", ["loan_id"]).join(scoring.predict(test_rows, model, "cal", ["loan_id"]), "loan_id")
    rows = [(r["raw"], r["cal"]) for r in both.collect()]
    rows.sort()
    assert all(0 <= c <= 1 for _, c in rows)
    assert all(b[1] >= a[1] - 1e-12 for a, b in zip(rows, rows[1:]))
    path = fresh_path(spark, "calibrated")
    tables.save_model(model.pipeline, path)
    again = scoring.ScoringModel(tables.load_model(path), model.features, 0.5, probability=model.probability)
    assert scoring.predict(test_rows, again, "cal", ["loan_id"]).count() == len(rows)


def test_unknown_names(spark, folder, table):
    with pytest.raises(ValueError, match="method must be"):
        calibration.calibrate(learned.boosted(spark, folder), table, "platt")
    with pytest.raises(ValueError, match="Unknown model"):
        models.build_estimator("svm", ["a"], 10)


def test_leaky_model_is_refused(spark, folder):
    model = learned.boosted(spark, folder)
    with pytest.raises(ValueError, match="leakage"):
        scoring.ScoringModel(model.pipeline, [*model.features, "recoveries"], 0.5)


def test_tree_contributions_add_up(spark, folder, test_rows):
    model = learned.boosted(spark, folder)
    out, base = attribution.tree_contributions(test_rows, model.pipeline, model.features)
    total = F.aggregate("drivers", F.lit(base), lambda s, d: s + d["contribution"])
    both = out.select("loan_id", (1 / (1 + F.exp(-2 * total))).alias("p")).join(
        scoring.predict(test_rows, model, keep=["loan_id"]), "loan_id")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("pd")))).first()[0] < 1e-9


def test_responses_and_rejects(spark, folder):
    apps = applications(spark, folder)
    out = scoring.score_applications(apps, learned.logistic(spark, folder), learned.encodings(spark, folder)).cache()
    assert out.count() == apps.count()
    rejected = out.filter(F.size("violations") > 0)
    assert rejected.count() > 0 and rejected.filter("prediction is not null").count() == 0
    fine = out.filter(F.size("violations") == 0)
    assert fine.filter("(default_probability >= threshold) <> (prediction = 1)").count() == 0


def test_contract_rejections(spark):
    good = dict(loan_id=1, loan_amnt=10000.0, term=36.0, int_rate=12.5, installment=334.87, grade="B", sub_grade="B3",
                home_ownership="RENT", annual_inc=60000.0, verification_status="Verified", purpose="debt_consolidation",
                addr_state="CA", dti=15.0, fico_range_low=700.0)
    bad = {"loan_amnt": None, "term": 48.0, "grade": "Z", "sub_grade": "B9"}
    rows = [good, *[{**good, k: v} for k, v in bad.items()]]
    schema = "loan_id long, " + ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in good.items() if k != "loan_id")
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = [r["violations"] for r in contract.add_violations(df).collect()]
    assert got[0] == [] and [g[0].split(":")[0] for g in got[1:]] == list(bad) and all(len(g) == 1 for g in got[1:])
    valid, rejects = contract.split_valid(df)
    assert (valid.count(), rejects.count()) == (1, 4)


def test_stream_equals_batch(spark, folder):
    source, out, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    apps = contract.fill_defaults(applications(spark, folder)).select(*contract.application_schema().names)
    apps.repartition(4, "loan_id").write.parquet(source)
    model, enc = learned.logistic(spark, folder), learned.encodings(spark, folder)
    score_stream(application_stream(spark, source, 1), model, enc, out, state).awaitTermination()
    streamed = spark.read.parquet(out).select("loan_id", F.round("default_probability", 6).alias("default_probability"), "prediction")
    batch = scoring.score_applications(apps, model, enc).select("loan_id", "default_probability", "prediction")
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0


def test_search_draws_are_repeatable():
    assert models.draw_trials(3, 1) == models.draw_trials(3, 1) != models.draw_trials(3, 2)
    for trial in models.draw_trials(20):
        for name, (low, high, _) in models.SEARCH_SPACE.items():
            assert low <= trial[name] <= high


def test_trial_history(spark):
    df = spark.createDataFrame([(0, 0.6), (1, 0.5), (2, 0.7)], "trial int, val_roc_auc double")
    assert [r["best_so_far"] for r in models.trial_history(df).orderBy("trial").collect()] == [0.6, 0.6, 0.7]


def test_kpi_stream_goes_on_after_a_stop(spark):
    from creditloom.streaming import kpis
    folder, out, state = (fresh_path(spark, n) for n in ("scored", "kpis", "state"))

    def rows(*times):
        return spark.createDataFrame([(t, 0.1 * i, i % 2, "High" if i % 3 else "Low") for i, t in enumerate(times, 1)],
                                     "t string, default_probability double, prediction int, risk_tier string").select(
            F.to_timestamp("t").alias("scored_at"), "default_probability", "prediction", "risk_tier").coalesce(1)

    def run(*times):
        rows(*times).write.mode("append").parquet(folder)
        query = kpis.kpi_stream(kpis.scored_stream(spark, folder, rows(*times).schema, 1), "1 hour", "1 hour", out, state)
        query.awaitTermination()
        return kpis.late_rows(query)

    hour = "2020-01-01 {:02d}:30:00".format
    assert run(hour(1), hour(1), hour(2)) == 0
    assert run(hour(2), hour(9)) == 0          # the second run takes the open windows up again
    assert run(hour(10), hour(1)) == 1         # long after its window
    got = {r["window_start"].hour: (r["scored"], r["flagged"], round(r["mean_probability"], 6), r["high_risk"])
           for r in kpis.kpi_table(spark, out).collect()}
    assert got == {1: (2, 1, 0.15, 2), 2: (2, 2, 0.2, 1), 9: (1, 0, 0.2, 1), 10: (1, 1, 0.1, 1)}


def test_halving_is_repeatable_and_refuses_other_models(spark, table):
    cols = ["int_rate", "fico_range_low", "dti"]
    runs = [models.halving_search(table, cols, 3, (1, 2), 3, space={"depth": (2, 3, False), "step": (0.1, 0.3, True)}, side_by_side=2)
            .orderBy("rung", "trial").collect() for _ in range(2)]
    assert runs[0] == runs[1] and [r["rung"] for r in runs[0]] == [0, 0, 0, 1]
    with pytest.raises(ValueError, match="tree by tree"):
        models.halving_search(table, cols, 2, kind="random_forest")


def test_trials_side_by_side_fit_into_memory(spark, table, monkeypatch):
    assert [models.fits_at_once(10 << 30, rows, 54, 4) for rows in (10, 5_000_000, 10_000_000, 30_000_000, 10**10)] == [4, 4, 2, 1, 1]
    assert models.fits_at_once(0, 0, 3, 4) == 1 and models.storage_bytes(spark) > 100 << 20
    running, most, fit = set(), [], models.GBTClassifier.fit

    def counted(self, rows):
        running.add(id(self))
        most.append(len(running))
        try:
            return fit(self, rows)
        finally:
            running.discard(id(self))

    monkeypatch.setattr(models, "storage_bytes", lambda spark: 1)
    monkeypatch.setattr(models.GBTClassifier, "fit", counted)
    space = {"depth": (2, 3, False)}
    trials = models.halving_search(table, ["int_rate", "fico_range_low", "dti"], 3, (1,), space=space, side_by_side=3)
    assert trials.count() == 3 and most == [1, 1, 1]


def test_threshold_report_of_a_stored_model(spark, folder, table):
    from creditloom.plans import jobs
    path, model = fresh_path(spark, "model"), learned.logistic(spark, folder)
    scoring.save_scoring_model(model, spark, path)
    strategies, against = jobs.threshold_report(spark, path, table, 0.5)
    assert strategies.count() == 6
    row = {r["metric"]: r for r in against.collect()}
    assert abs(row["f1"]["saved"] - model.metrics["test_f1"]) < 1e-6


def test_scores_that_checks_share_are_stored(spark, folder, table, test_rows):
    from checks.section_models import _scored
    model = learned.boosted(spark, folder)
    scored = _scored(spark, folder, model)
    assert not set(scored.inputFiles()) & set(table.inputFiles())  # else each look scores the window again
    assert scored.exceptAll(scoring.predict(test_rows, model, keep=["loan_id", "default", "split"])).isEmpty()
    assert scored.count() == test_rows.count()


def test_sigmoid_scores_its_rows_once(spark, folder, table, monkeypatch):
    fitted_on = []
    fit = calibration.LogisticRegression.fit
    monkeypatch.setattr(calibration.LogisticRegression, "fit", lambda self, rows: fitted_on.append(rows) or fit(self, rows))
    calibration.calibrate(learned.boosted(spark, folder), table.filter("split = 'validation'"))
    assert not set(fitted_on[0].inputFiles()) & set(table.inputFiles())


def _walk(row, trees, width):
    total = [0.0] * width
    for weight, value, left, right, feature, cut in trees:
        at = 0
        while left[at] >= 0:
            child = left[at] if row[feature[at]] <= cut[at] else right[at]
            total[feature[at]] += weight * (value[child] - value[at])
            at = child
    return total


@pytest.mark.parametrize("most", [attribution.MAX_NODES, 5])
def test_path_contributions_are_numbers_of_a_plain_walk(spark, most):
    rows = spark.range(300).selectExpr("id loan_id", "cast(id % 7 as float) a", "cast(id % 5 as float) b", "0f c",
                                       "cast((id % 7) * (id % 5) > 6 as int) default").repartition(9, "a")
    model = models.train(rows, "boosted_trees", ["a", "b", "c"], trees=3, depth=3).model
    state, base = attribution.path_contributions(rows, model.pipeline, model.features, most=most)
    assert state.columns == ["loan_id", attribution.VALUES, attribution.CONTRIBUTIONS]  # no names travel with the rows
    trees = [t for g in attribution.ensemble_groups(model.pipeline, spark) for t in g]
    got = state.collect()
    assert len(got) == 300 and base == pytest.approx(sum(t[0] * t[1][0] for t in trees))
    for r in got:
        assert list(r[2]) == _walk(r[1], trees, 3)
