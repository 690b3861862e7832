"""Metrics and threshold strategies against plain NumPy on a seeded score table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import metrics, prefix, risk, thresholds


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(42)
    y = (rng.random(2000) < 0.21).astype(int)
    p = np.round(np.clip(0.35 * y + 0.65 * rng.random(2000), 0, 1), 3)   # rounded: real ties
    return y, p


@pytest.fixture(scope="module")
def scores(spark, data):
    y, p = data
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "loan_id long, default int, pd double").repartition(3).cache()


def counts(y, p, t):
    hit = p >= t
    return int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()), int((~hit & (y == 1)).sum()), int((~hit & (y == 0)).sum())


def test_roc_auc_counts_ties_half(scores, data):
    y, p = data
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert metrics.roc_auc(scores).first()[0] == pytest.approx(pairs / (len(pos) * len(neg)), rel=1e-12)


def test_average_precision_and_ks(scores, data):
    y, p = data
    ap, last, gaps = 0.0, 0.0, []
    for t in np.unique(p)[::-1]:
        tp, fp, _, _ = counts(y, p, t)
        recall = tp / y.sum()
        ap += (recall - last) * tp / (tp + fp)
        last = recall
        gaps.append((recall - fp / (y == 0).sum(), t))
    row = metrics.rank_metrics(scores).first()
    assert row["pr_auc"] == pytest.approx(ap, rel=1e-12)
    assert row["ks_stat"] == pytest.approx(max(g for g, _ in gaps), rel=1e-12)
    assert row["ks_threshold"] == next(t for g, t in gaps if g == max(x for x, _ in gaps))


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_running_totals_do_not_depend_on_ranges(scores, data, ranges):
    y, p = data
    for r in prefix.score_table(scores, ranges=ranges).collect():
        tp, fp, fn, tn = counts(y, p, r["score"])
        assert (r["tp"], r["fp"], r["positives"], r["negatives"]) == (tp, fp, tp + fn, fp + tn)


def test_no_global_window_over_scores(scores):
    plan = prefix.score_table(scores, ranges=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(range_no" in plan


def test_sweep_matches_direct_counts(scores, data):
    y, p = data
    rows = metrics.threshold_sweep(scores, np.linspace(0.001, 0.999, 200)).collect()
    assert len(rows) == 200
    for r in rows:
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == counts(y, p, r["threshold"])


def test_grid_points_on_scores(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.2), (1, 0.4)], "default int, pd double")
    rows = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.threshold_sweep(df, [0.2, 0.3, 0.4, 0.9]).collect()}
    assert rows == {0.2: (2, 1), 0.3: (1, 0), 0.4: (1, 0), 0.9: (0, 0)}


def test_strategies(scores, data):
    y, p = data
    rows = {r["strategy"]: r for r in thresholds.compare_all(scores, np.linspace(0.001, 0.999, 200)).collect()}
    assert sorted(rows, key=lambda s: rows[s]["position"]) == list(thresholds.STRATEGIES)
    assert rows["max_precision"]["recall"] >= 0.5 - 1e-4
    assert rows["max_recall"]["precision"] >= 0.35 - 1e-4
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 2000 for r in rows.values())
    for name, row in rows.items():
        single = thresholds.strategy(scores, name, np.linspace(0.001, 0.999, 200)).first()
        assert single["threshold"] == row["threshold"], name


def test_infeasible(scores):
    with pytest.raises(thresholds.Infeasible):
        thresholds.strategy(scores, "max_recall", min_precision=1.01)
    with pytest.raises(ValueError, match="Unknown strategy"):
        thresholds.strategy(scores, "best")


def test_useless_scores(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.9)], "default int, pd double")
    row = metrics.rank_metrics(df).first()
    assert (row["roc_auc"], row["ks_stat"], row["ks_threshold"]) == (0.0, 0.0, float("inf"))


def test_calibration_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.1000001), (1, 1.0)], "default int, pd double")
    rows = {r["bin"]: r["rows"] for r in metrics.calibration_uniform(df, 10).collect()}
    assert rows == {0: 2, 1: 1, 9: 1}


def test_histogram_matches_numpy(scores, data):
    y, p = data
    rows = {r["bin"]: r for r in metrics.score_histogram(scores, 50).collect()}
    want, edges = np.histogram(p, bins=50)
    density, _ = np.histogram(p, bins=50, density=True)
    assert [rows[i]["rows"] if i in rows else 0 for i in range(50)] == list(want)
    assert [rows[i]["density"] if i in rows else 0 for i in range(50)] == pytest.approx(list(density))


RISK = [(0, 0.05, 10000.0), (1, 0.15, 12000.0), (0, 0.30, 15000.0), (1, 0.60, 20000.0)]


def test_business_table(spark):
    df = spark.createDataFrame(RISK, "default int, pd double, ead double")
    low, high = risk.business_table(df, [0.2, 0.5]).orderBy("threshold").collect()
    assert (low["approval_rate"], low["rejection_rate"]) == (0.5, 0.5)
    assert low["default_rate_approved"] == 0.5 and low["defaults_caught_rate"] == 0.5
    assert high["approval_rate"] == 0.75
    total = 0.45 * (500 + 1800 + 4500 + 12000)
    assert low["total_expected_loss"] == pytest.approx(total)
    assert low["expected_loss_approved"] + low["expected_loss_rejected"] == pytest.approx(total)


def test_bands(spark):
    df = spark.createDataFrame([(p,) for p in (0.05, 0.10, 0.20, 0.35, float("nan"), None)], "pd double")
    got = [r["risk_band"] for r in risk.add_risk(df, ead=None).collect()]
    assert got == ["Low", "Medium", "High", "Very High", "Unknown", "Unknown"]


def test_every_band_is_listed(spark):
    df = spark.createDataFrame([(0.05, 100.0)], "pd double, ead double")
    rows = risk.band_distribution(df).orderBy("position").collect()
    assert [(r["risk_band"], r["loans"]) for r in rows] == [
        ("Low", 1), ("Medium", 0), ("High", 0), ("Very High", 0), ("Unknown", 0)]


@pytest.mark.parametrize("partitions", ["1", "4"])
@pytest.mark.parametrize("gap", [None, float("nan")])
def test_no_unscored_loan_goes_missing(spark, gap, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(1, 0.9, 1.0), (0, 0.2, 1.0), (1, 0.4, 1.0), (0, gap, 1.0), (1, gap, 1.0)],
                                   "default int, pd double, ead double")
        for faulty in (lambda: metrics.roc_auc(df), lambda: metrics.probability_metrics(df),
                       lambda: metrics.confusion_at(df, 0.5), lambda: metrics.threshold_sweep(df, [0.5])):
            with pytest.raises(Exception, match="missing in some rows"):
                faulty().collect()
        row = metrics.threshold_sweep(df, [0.3], count_unscored=True).first()
        assert (row.tp, row.fp, row.fn, row.tn, row.unscored) == (2, 0, 0, 1, 2)
        with pytest.raises(ValueError, match="2 loans have no pd"):
            risk.business_table(df)
        assert sum(r["loans"] for r in risk.band_distribution(df).collect()) == 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("rows, text", [([], "at least one"), ([(0, 1.2, 1.0)], "Probabilities"), ([(0, 0.2, -1.0)], "Exposure")])
def test_risk_inputs(spark, rows, text):
    df = spark.createDataFrame(rows, "default int, pd double, ead double")
    with pytest.raises(ValueError, match=text):
        risk.business_table(df)
