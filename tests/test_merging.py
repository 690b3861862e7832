"""Mergeable partial results against NumPy: isotonic pools, co-moments, binned densities, heavy hitters, staged scores."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import learned
from creditloom.operators import comoments, isotonic, lookup, metrics, models, profiling, scoring, staging
from creditloom.operators.comoments import CoMoments


# --- isotonic pools

def max_min(scores, labels):
    """The definition: at each score the largest over starts of the smallest over ends of the mean between them."""
    x = np.unique(scores)
    n = np.array([(scores == v).sum() for v in x])
    y = np.array([labels[scores == v].sum() for v in x])
    cn, cy = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(y)])
    return x, np.array([max(min((cy[b + 1] - cy[a]) / (cn[b + 1] - cn[a]) for b in range(i, len(x)))
                            for a in range(i + 1)) for i in range(len(x))])


def pool_all(scores, labels):
    x, place = np.unique(scores, return_inverse=True)
    return isotonic.pool(x.tolist(), x.tolist(), np.bincount(place).tolist(), np.bincount(place, labels).astype(int).tolist())


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_pools_follow_the_definition(pairs):
    scores, labels = np.array([p[0] / 12 for p in pairs]), np.array([p[1] for p in pairs])
    x, want = max_min(scores, labels)
    got = np.concatenate([[y / n] * int(((x >= a) & (x <= b)).sum()) for a, b, n, y in pool_all(scores, labels)])
    assert np.allclose(got, want)
    assert np.all(np.diff([y / n for *_, n, y in pool_all(scores, labels)]) > 0)


@pytest.mark.parametrize("kind", ["rising", "falling", "noise", "ties", "one"])
@pytest.mark.parametrize("ranges", [1, 2, 7, 16])
def test_ranges_merge_to_the_pools_of_all(spark, kind, ranges):
    rng = np.random.default_rng(len(kind))
    n = 3_000
    scores = {"ties": rng.integers(0, 9, n) / 9, "one": np.full(n, 0.5)}.get(kind, rng.random(n))
    rate = {"rising": scores, "falling": 1 - scores}.get(kind, np.full(n, 0.3))
    labels = (rng.random(n) < rate).astype(int)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "pd double, default int").repartition(5)
    got = [tuple(r)[:4] for r in isotonic.isotonic_pools(df, ranges=ranges).orderBy("low").collect()]
    assert got == [tuple(p) for p in pool_all(scores, labels)]


def test_a_million_scores(spark):
    df = spark.range(1_000_000, numPartitions=8).select(
        (F.pmod(F.xxhash64("id"), F.lit(400_000)) / 400_000).alias("pd"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("u"))
    df = df.select("pd", (F.col("u") < 1000 * F.col("pd") * F.col("pd")).cast("int").alias("default"))
    pools = isotonic.isotonic_pools(df, ranges=12).orderBy("low").toPandas()
    rows = df.toPandas()
    want = pool_all(rows["pd"].to_numpy(), rows["default"].to_numpy())
    assert pools[["low", "high", "rows", "positives"]].to_numpy().tolist() == [list(map(float, p)) for p in want]
    assert np.all(np.diff(pools["rate"]) > 0) and pools["rows"].sum() == 1_000_000


def test_pools_of_odd_rows(spark):
    schema = "pd double, default int"
    assert isotonic.isotonic_pools(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(0.2, 1), (0.2, 0), (0.1, None), (0.9, 1)], schema)
    assert [tuple(r) for r in isotonic.isotonic_pools(df).orderBy("low").collect()] == [(0.2, 0.2, 2, 1, 0.5), (0.9, 0.9, 1, 1, 1.0)]
    with pytest.raises(Exception, match="Score pd"):
        isotonic.isotonic_pools(spark.createDataFrame([(None, 1)], schema)).count()


# --- co-moments

@given(st.integers(0, 5_000), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_merged_co_moments_equal_numpy(seed, parts):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, 4)) * [1, 1e-3, 1e4, 1] + [0, 1e6, -5, 3]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 7.0
    x[0, 3] = np.nan
    total = CoMoments.of(np.zeros((0, 4)))
    for part in np.array_split(x, parts):
        total = total.merged(CoMoments.unpacked(CoMoments.of(part).packed()))
    found = total.correlations()
    for a in range(4):
        for b in range(4):
            both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            if 3 in (a, b) or both.sum() < 2:
                assert math.isnan(found[a, b])
            else:
                assert abs(found[a, b] - np.corrcoef(x[both, a], x[both, b])[0, 1]) < 1e-7


def test_correlations_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, 2, None, 5.0, 1), (2.0, 4, None, 5.0, 0), (3.0, 7, 1.0, 5.0, 1), (None, 1, None, 5.0, 0),
                                (float("nan"), 3, None, 5.0, 1)], "a double, b int, c double, d double, y int")
    found = {(r["feature"], r["other"]): r["correlation"] for r in comoments.correlation_table(df, ["a", "b", "c", "d"]).collect()}
    assert abs(found["b", "a"] - np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1]) < 1e-12
    assert all(found[k] is None for k in found if k != ("b", "a"))
    assert comoments.correlation_with(df.filter("false"), ["a"], "y").first()["correlation"] is None


# --- density

def test_density_stays_within_its_bound(spark):
    rng = np.random.default_rng(4)
    rows = [(float(v), float(round(abs(w) * 50)), int(y)) for v, w, y in zip(rng.normal(size=900), rng.standard_cauchy(900), rng.random(900) < .3)]
    df = spark.createDataFrame(rows, "a double, b double, default int")
    got = profiling.density_by_class(df, ["a", "b"], points=150, nodes=16, most=0).toPandas()
    for (feature, label), part in got.groupby(["feature", "default"]):
        x = np.array([r[0 if feature == "a" else 1] for r in rows if r[2] == label])
        h = 0.3 * x.std(ddof=1)
        z = (part["x"].to_numpy()[:, None] - x[None, :]) / h
        direct = np.exp(-0.5 * z * z).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
        assert len(part) == 150 and part["error_bound"].min() > 0
        assert np.abs(direct - part["density"]).max() <= part["error_bound"].max()


# --- heavy hitters

def test_hot_keys_are_found_and_counted(spark):
    df = spark.range(60_000, numPartitions=7).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).when(F.col("id") % 41 == 0, F.lit(None)).when(F.col("id") % 500 == 3, F.lit("warm"))
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"))
    found = {r["key"]: r["rows"] for r in lookup.hot_keys(df, "key", share=1000).collect()}
    assert found == {"hot": 24_000, "warm": df.filter("key = 'warm'").count()}
    assert lookup.hot_keys(df.filter("false"), "key").count() == 0


@pytest.mark.parametrize("known", [True, False])
def test_no_task_gets_a_hot_key(spark, known):
    df = spark.range(40_000, numPartitions=4).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 7_000)).alias("key_in"))
    table = spark.range(7_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").cast("double").alias("value"))
    if known:
        table = table.unionByName(spark.createDataFrame([("hot", -7.0)], "key string, value double"))
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = lookup.attach(df, table, 7_001, "key_in", "v", -1.0, broadcast_rows=10).withColumn("task", F.spark_partition_id())
        rows = joined.collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(rows) == 40_000
    assert all(r["v"] == ((-7.0 if known else -1.0) if r["key_in"] == "hot" else float(r["key_in"][1:])) for r in rows)
    sizes = sorted(np.unique([r["task"] for r in rows], return_counts=True)[1])
    assert max(sizes) < 2 * np.median(sizes)


# --- staged scores

def test_stages_equal_cut_models(spark, folder):
    stopped = learned.stopped(spark, folder)
    model = models.train(learned.train_rows(spark, folder), "boosted_trees_balanced", learned.columns(spark, folder), trees=6,
                         depth=3, step=0.3).model
    validation = learned.features(spark, folder).filter("split = 'validation'")
    whole = model.pipeline.stages[-1]
    staged = {r["stage"]: r["roc_auc"] for r in staging.staged_auc(validation, model.pipeline, model.features).collect()}
    assert sorted(staged) == list(range(1, 7))
    for count in (1, 3, 6):
        cut = scoring.ScoringModel(type(model.pipeline)(stages=[*model.pipeline.stages[:-1], staging.first_trees(whole, count)]),
                                   model.features, 0.5)
        scored = scoring.predict(validation, cut, keep=["default"])
        assert abs(metrics.roc_auc(scored).first()[0] - staged[count]) < 1e-9
    assert stopped.model.pipeline.stages[-1].getNumTrees == stopped.best_stage
    with pytest.raises(ValueError, match="trees, not"):
        staging.first_trees(whole, 7)


def test_patience(spark):
    def run(values, patience):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "stage int, roc_auc double")
        rows = staging.with_patience(df, patience).orderBy("stage").collect()
        return [r["best_stage"] for r in rows], [r["went_on"] for r in rows]
    assert run([.5, .6, .6, .55, .7], 2) == ([1, 2, 2, 2, 5], [True, True, True, True, False])
    assert run([.5, .6, .6, .55, .7], 3) == ([1, 2, 2, 2, 5], [True] * 5)


# --- groups with one class

def test_one_class_groups_have_no_rank_metrics(spark):
    df = spark.createDataFrame([("a", 0.1, 0), ("a", 0.4, 1), ("b", 0.2, 0), ("b", 0.3, 0), ("c", 0.5, 1)],
                               "g string, pd double, default int")
    rows = {r["g"]: r for r in metrics.all_metrics(df, group="g").collect()}
    assert rows["a"]["roc_auc"] == 1.0 and rows["b"]["roc_auc"] is None and rows["c"]["roc_auc"] is None
    assert rows["b"]["pr_auc"] is None and rows["b"]["brier"] is not None
    assert metrics.roc_auc(df.filter("default = 0")).first()[0] is None


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_curves_refuse_missing_scores(spark, bad):
    df = spark.createDataFrame([(0.1, 0), (bad, 1)], "pd double, default int")
    for curve in (metrics.score_histogram, metrics.calibration_uniform, metrics.calibration_quantile):
        with pytest.raises(Exception, match="Score pd"):
            curve(df).collect()


def test_histogram_of_flat_and_edge_scores(spark):
    df = spark.createDataFrame([("a", 0.5)] * 3 + [("b", v / 8) for v in range(9)] + [(None, 0.1)], "g string, pd double")
    rows = metrics.score_histogram(df, 8, group="g").collect()
    assert [(r["bin"], r["rows"], r["density"]) for r in rows if r["g"] == "a"] == [(0, 3, 3.0)]
    assert {r["bin"]: r["rows"] for r in rows if r["g"] == "b"} == {i: 1 + (i == 7) for i in range(8)}
    assert [(r["bin"], r["rows"]) for r in rows if r["g"] is None] == [(0, 1)]
