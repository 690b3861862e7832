"""Raw text cells, clipping, imputation and the whole cleaning chain."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions import parse
from creditloom.operators import cleaning, quantiles


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def values(df):
    return [r[0] for r in df.collect()]


def test_term(spark):
    df = column(spark, [" 36 months", " 60 months", None, "none"])
    assert values(df.select(parse.parse_term(F.col("c")))) == [36, 60, None, None]


def test_emp_length(spark):
    df = column(spark, ["10+ years", "< 1 year", "2 years", "5 years", "n/a", None])
    assert values(df.select(parse.parse_emp_length(F.col("c")))) == [10, 0, 2, 5, None, None]


def test_percent(spark):
    df = column(spark, ["13.5%", "7.99%", "N/A", None])
    assert values(df.select(parse.parse_percent(F.col("c")))) == [13.5, 7.99, None, None]


def test_numeric_percent_passes_through(spark):
    df = spark.createDataFrame([(13.5, "36")], "int_rate double, term string")
    assert cleaning.parse_columns(df).first()["int_rate"] == 13.5


def test_month(spark):
    df = column(spark, ["Jan-2015", "bad-date", None])
    assert values(df.select(parse.parse_month(F.col("c")))) == [datetime.date(2015, 1, 1), None, None]


@pytest.mark.parametrize("text, reference, months", [
    ("Jan-2019", "2019-07-01", 6), ("Jan-2019", "2019-01-15", 0), ("bad-date", "2019-01-01", None)])
def test_credit_history(spark, text, reference, months):
    df = spark.createDataFrame([(text,)], "earliest_cr_line string")
    out = cleaning.parse_columns(df, reference)
    assert "earliest_cr_line" not in out.columns
    assert out.first()["cr_history_months"] == months


def test_history_to_issue_date(spark):
    df = spark.createDataFrame([("Jan-2010", "Jan-2011")], "earliest_cr_line string, issue_d string")
    assert cleaning.parse_columns(df, None).first()["cr_history_months"] == 12


def test_status_filter_and_target(spark):
    df = column(spark, [*cleaning.LABELLED_STATUS, "Current", None]).withColumnRenamed("c", "loan_status")
    rows = cleaning.add_target(cleaning.keep_labelled(df)).collect()
    assert {r["loan_status"]: r["default"] for r in rows} == cleaning.LABELLED_STATUS


def test_unusable_columns_go(spark):
    df = spark.createDataFrame([(1, "x", 2.0, 3.0)], "loan_id long, desc string, recoveries double, loan_amnt double")
    assert cleaning.drop_unusable(df).columns == ["loan_id", "loan_amnt"]


def raw_loans(spark, n=400):
    rows = [(i, "Charged Off" if i % 4 == 0 else "Fully Paid", " 36 months" if i % 5 else None, "10%",
             None if i % 7 == 0 else float(i), float(i * i), "A" if i % 3 else None, "Jan-2015") for i in range(n)]
    return spark.createDataFrame(rows, "loan_id long, loan_status string, term string, int_rate string, "
                                       "dti double, annual_inc double, grade string, issue_d string")


def test_whole_chain_against_pandas(spark):
    raw = raw_loans(spark)
    out = cleaning.clean(raw).toPandas().set_index("loan_id").sort_index()
    pdf = raw.toPandas().set_index("loan_id").sort_index()
    dti = pdf["dti"].clip(0, 100)
    income = pdf["annual_inc"].clip(0, pdf["annual_inc"].quantile(0.99))
    np.testing.assert_allclose(out["dti"], dti.fillna(dti.median()), rtol=1e-6)
    np.testing.assert_allclose(out["annual_inc"], income, rtol=1e-6)
    assert set(out["grade"]) == {"A", "Unknown"}
    assert not out.isna().any().any()
    assert str(out["dti"].dtype) == "float32"


def test_fit_rows_only(spark):
    prepared = cleaning.prepare(raw_loans(spark))
    fit = cleaning.fit_cleaning(prepared, F.col("loan_id") < 50)
    assert fit.caps["annual_inc"] < 49 * 49
    assert fit.medians["term"] == 36


@pytest.mark.parametrize("finish", [3, 20, 1000])
@pytest.mark.parametrize("kind", ["distinct", "heavy", "constant"])
def test_exact_quantiles(spark, finish, kind):
    rng = np.random.default_rng(1)
    data = {"distinct": rng.normal(size=700), "heavy": np.where(rng.random(700) < 0.4, 5.0, rng.integers(0, 40, 700)),
            "constant": np.full(700, 2.5)}[kind]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "c double").repartition(4)
    qs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    found = quantiles.exact_quantiles(df, {"c": qs}, finish_values=finish)["c"]
    np.testing.assert_allclose([found[q].value for q in qs], np.quantile(data, qs), rtol=1e-12)


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,)], "c double")
    assert quantiles.exact_quantiles(df, {"c": [0.5]}) == {}


def test_only_columns_with_gaps_are_sketched(spark, monkeypatch):
    """Whole columns need no median, so no sketch of them is made; the fit is that of a search in few rows."""
    df = spark.range(3_000).select(
        F.col("id").alias("loan_id"), F.col("id").cast("double").alias("annual_inc"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("dti"), *[F.col("id").cast("double").alias(f"x{i}") for i in range(5)])
    expected = cleaning.fit_cleaning(df)
    sketched, plain = [], F.percentile_approx

    def counted(*args):
        sketched.append(str(args[0]))
        return plain(*args)
    monkeypatch.setattr(F, "percentile_approx", counted)
    monkeypatch.setattr(quantiles.exact_quantiles, "__defaults__", (None, 10))
    assert cleaning.fit_cleaning(df) == expected
    assert set(expected.medians) == {"dti"} and set(expected.caps) == {"annual_inc"}
    assert sketched and not any(f"x{i}" in s for s in sketched for i in range(5))


def test_only_usable_cells_are_stored_before_cleaning(spark):
    raw = spark.createDataFrame([(1, "Fully Paid", "L1", "other", 5.0, 7.0), (2, "Current", "L2", None, 6.0, 7.0), (3, None, "L3", None, 6.0, 7.0)],
                                "loan_id long, loan_status string, id string, desc string, loan_amnt double, recoveries double")
    kept = cleaning.keep_usable(raw)
    assert kept.columns == ["loan_id", "loan_status", "loan_amnt"] and [r.loan_id for r in kept.collect()] == [1]
    assert cleaning.clean(kept).collect() == cleaning.clean(raw).collect()
