import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions.wording import value_text
from creditloom.operators import attribution, explanation, profiling


@pytest.mark.parametrize("value", [0.0, 1839.4, 1000.0, 29.0, 24.25, 720.0, 9.996, 1.0, 0.5, 0.0123456, 0.000123, 0.0000123, -3.14159, -2500.7, 999.96])
def test_value_text(spark, value):
    want = f"{value:,.0f}" if abs(value) >= 1000 else f"{value:.1f}" if abs(value) >= 10 else f"{value:.3g}"
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(value_text(F.col("v"))).first()[0] == want


def loan(spark):
    drivers = [("int_rate", 24.5, 0.4), ("fico_range_low", 720.0, -0.2), ("term_60", 1.0, 0.1)]
    return spark.createDataFrame([(7, drivers)], "loan_id long, drivers array<struct<feature:string,value:double,contribution:double>>")


def test_local_text(spark):
    row = explanation.explanation_text(explanation.local_drivers(loan(spark), 2)).first()
    assert [d["feature"] for d in row["top_positive_drivers"]] == ["int_rate", "term_60"]
    assert row["explanation_text"].split("\n") == [
        explanation.HIGHER_HEADING,
        "1. Interest rate is high (24.5), which increases predicted default risk.",
        "2. 60-month loan term is 60 months (1), which increases predicted default risk.", "",
        explanation.LOWER_HEADING,
        "1. FICO score is strong (720.0), which reduces predicted default risk."]


def test_direction_notes(spark):
    rows = [(i, float(i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "loan_id long, a double, b double").withColumn("c", F.lit(3.0))
    out = attribution.linear_contributions(df, {"a": 1.0, "b": -2.0, "c": 1.0}, {"a": 4.5, "b": 4.5, "c": 3.0})
    got = {r["feature"]: (r["rank"], r["direction_note"]) for r in explanation.global_importance(out).collect()}
    assert got == {"b": (1, explanation.LOWERS), "a": (2, explanation.RAISES), "c": (3, explanation.UNSTABLE)}


def test_density_matches_direct_sum(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=300), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, default int").repartition(3)
    got = sorted((r["default"], r["point"], r["x"], r["density"])
                 for r in profiling.density_by_class(df.withColumnRenamed("x", "v"), ["v"], points=50).collect())
    for label in (0, 1):
        v = x[y == label]
        reach, h = v.max() - v.min(), 0.3 * v.std(ddof=1)
        grid = np.linspace(v.min() - 0.5 * reach, v.max() + 0.5 * reach, 50)
        want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
        mine = [g for g in got if g[0] == label]
        np.testing.assert_allclose([g[2] for g in mine], grid, atol=1e-12)
        np.testing.assert_allclose([g[3] for g in mine], want, rtol=1e-9)


def test_profile_exact(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0)], "t string, n double")
    got = {r["feature"]: (r["data_type"], r["non_null"], r["distinct"]) for r in profiling.column_profile(df).collect()}
    assert got == {"t": ("string", 2, 1), "n": ("double", 2, 2)}
    approx = {r["feature"]: r["distinct"] for r in profiling.column_profile(df, approximate=True).collect()}
    assert approx == {"t": 1, "n": 2}
