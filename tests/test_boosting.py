"""Boosted trees on binned rows, held against a plain walk through all splits and against Spark's own trainer."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from creditloom.operators import boosting, models
from creditloom.operators.attribution import ensemble_groups
from creditloom.session import fresh_path

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Few values a feature, so that no bins are chosen from a sample."""
    return spark.range(4000).selectExpr(
        "id loan_id", "cast(pmod(hash(id, 1), 9) as float) a", "cast(pmod(hash(id, 2), 7) as float) b",
        "cast(pmod(hash(id, 3), 5) as float) c").withColumn(
        "default", F.expr("int(a * b + 3 * c + pmod(hash(loan_id, 4), 20) > 30)")).repartition(7, "loan_id").cache()


def _trees(spark, pipeline):
    return [t for group in ensemble_groups(pipeline, spark) for t in group]


def _apart(spark, rows, **settings):
    """The same fit in one task and over several."""
    out = []
    for most in (boosting.TASK_ROWS, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(boosting, "TASK_ROWS", most)
            patch.setattr(boosting, "BLOCK_ROWS", 1_000_000 if most else 700)
            out.append(_trees(spark, models.train(rows, "boosted_trees_balanced", NAMES, **settings).model.pipeline))
    return out


def _same(left, right):
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert x[0] == y[0] and all(np.array_equal(p, q, equal_nan=True) for p, q in zip(x[2:], y[2:]))
        np.testing.assert_allclose(x[1], y[1], rtol=1e-9, atol=1e-12)


def test_trees_are_those_of_sparks_trainer(spark, rows):
    settings = dict(maxIter=12, maxDepth=3, stepSize=0.3, minInstancesPerNode=20, labelCol="default", seed=1)
    assembled = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    own, spark_own = (cls(**settings).fit(assembled) for cls in (boosting.BoostedTrees, GBTClassifier))
    assert own.numFeatures == 3 and own.getNumTrees == 12 and list(own.treeWeights) == list(spark_own.treeWeights)
    pd = [[r[0][1] for r in m.transform(assembled).orderBy("loan_id").select("probability").collect()] for m in (own, spark_own)]
    np.testing.assert_allclose(pd[0], pd[1], atol=1e-9)
    np.testing.assert_allclose(own.featureImportances.toArray(), spark_own.featureImportances.toArray(), atol=1e-9)


def test_one_task_or_many_grow_the_same_trees(spark, rows):
    one, many = _apart(spark, rows, trees=13, depth=4, step=0.2, row_share=1.0, column_share=0.7)
    _same(one, many)


def test_sums_too_many_for_the_driver_meet_in_a_shuffle(spark, rows, monkeypatch):
    settings = dict(trees=3, depth=4, step=0.2, row_share=0.8, column_share=0.7)
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    on_driver = _trees(spark, models.train(rows, "boosted_trees_balanced", NAMES, **settings).model.pipeline)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 3000)
    _same(on_driver, _trees(spark, models.train(rows, "boosted_trees_balanced", NAMES, **settings).model.pipeline))


@pytest.mark.parametrize("most", [boosting.TASK_ROWS, 0])
def test_a_fit_goes_on_from_its_first_trees(spark, rows, monkeypatch, most):
    monkeypatch.setattr(boosting, "TASK_ROWS", most)

    def stage(trees):
        return models.build_estimator("boosted_trees", NAMES, 1, trees=trees, depth=3).getStages()[-1]

    binned = stage(1).bin(rows)
    few, whole = stage(2).on(binned), stage(5).on(binned)
    few.fit(rows), whole.fit(rows)
    grown, seen, grow = stage(5).on(binned, few.grown), [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda source, plan, number: seen.append(number) or grow(source, plan, number))
    grown.fit(rows)
    assert most or seen == [2, 3, 4]
    for x, y in zip(grown.grown, whole.grown):
        assert np.array_equal(x.feature, y.feature) and np.array_equal(x.cut, y.cut)
        np.testing.assert_allclose(x.value, y.value, rtol=1e-9, atol=1e-12)
    binned.close()


def test_model_is_stored_and_read_as_sparks(spark, rows):
    assembled = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    model = boosting.BoostedTrees(maxIter=3, maxDepth=2, labelCol="default", seed=1).fit(assembled)
    path = fresh_path(spark, "boosted")
    model.save(path)
    again = GBTClassificationModel.load(path)
    pd = [[r[0][1] for r in m.transform(assembled).orderBy("loan_id").select("probability").collect()] for m in (model, again)]
    assert pd[0] == pd[1]


def test_bad_rows_are_refused(spark, rows):
    stage = models.build_estimator("boosted_trees", NAMES, 1, trees=1).getStages()[-1]
    for bad, message in ((rows.withColumn("default", F.lit(2)), "Labels"), (rows.limit(0), "no rows"),
                         (rows.withColumn("a", F.when(F.col("a") > 2, F.col("a"))), "NULL or NaN")):
        with pytest.raises(Exception, match=message):
            stage.fit(bad)


def test_cuts_lie_between_values_at_equal_weights():
    assert list(boosting.find_cuts(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 32)) == [1.5, 2.5]
    assert list(boosting.find_cuts(np.ones(5), np.ones(5), 32)) == []
    cuts = boosting.find_cuts(np.arange(1000.0), np.ones(1000), 32)
    assert len(cuts) == 31 and np.abs(np.diff(cuts) - 1000 / 32).max() <= 1


def test_trials_share_their_rows_and_go_on(spark, monkeypatch):
    """Rows are binned once for all trials, and a trial's first trees are grown once for all rungs."""
    table = spark.range(2000).selectExpr("id loan_id", "cast(pmod(hash(id, 1), 9) as float) a", "cast(pmod(hash(id, 2), 7) as float) b",
                                         "int(pmod(hash(id, 1), 9) + pmod(hash(id, 3), 9) > 8) default",
                                         "if(id % 4 = 0, 'validation', 'train') split")
    binned, started, bin_rows, boosted = [], [], boosting.bin_rows, boosting.boosted
    monkeypatch.setattr(boosting, "bin_rows", lambda *x: binned.append(1) or bin_rows(*x))
    monkeypatch.setattr(boosting, "boosted", lambda rows, plan, start, every: started.append((len(start), plan.trees))
                        or boosted(rows, plan, start, every))
    models.halving_search(table, ["a", "b"], 3, (2, 4), 3, space={"depth": (2, 3, False)})
    assert len(binned) == 1 and sorted(started) == [(0, 2), (0, 2), (0, 2), (2, 4)]
