import datetime

import pytest
from pyspark.sql import functions as F

from creditloom.operators import splitting
from creditloom.policy import PolicyError

D = datetime.date


def dated(spark, *days):
    return spark.createDataFrame([(i, d, float(i), i % 2) for i, d in enumerate(days, 1)],
                                 "loan_id long, issue_d date, loan_amnt double, default int")


def test_boundaries(spark):
    df = dated(spark, D(2015, 12, 31), D(2016, 1, 1), D(2016, 12, 31), D(2017, 1, 1))
    got = [r["split"] for r in splitting.add_split(df).orderBy("loan_id").collect()]
    assert got == ["train", "validation", "validation", "test"]


def test_frames_lose_the_date(spark):
    parts = splitting.time_split(dated(spark, D(2015, 6, 1), D(2016, 6, 1), D(2017, 6, 1)))
    assert [p.first()["loan_amnt"] for p in parts] == [1.0, 2.0, 3.0]
    assert all("issue_d" not in p.columns for p in parts)


def test_empty_window_is_refused(spark):
    with pytest.raises(PolicyError, match="into the validation window"):
        splitting.time_split(dated(spark, D(2015, 6, 1), D(2017, 6, 1)))


def test_undated_rows_are_refused(spark):
    with pytest.raises(PolicyError, match="1 loans have no readable"):
        splitting.time_split(dated(spark, D(2015, 6, 1), D(2016, 6, 1), D(2017, 6, 1), None))


def test_unknown_strategy(spark):
    with pytest.raises(PolicyError, match="is not supported"):
        splitting.add_fit_flag(dated(spark, D(2015, 1, 1)), strategy="random")


@pytest.mark.parametrize("n", [0, 1, 137, 500, 900])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(500).withColumnRenamed("id", "loan_id").repartition(5)
    if n == 0:
        n = 499
    first = {r[0] for r in splitting.sample_rows(df, n).collect()}
    second = {r[0] for r in splitting.sample_rows(df.repartition(2), n).collect()}
    assert len(first) == min(n, 500) and first == second
    by_hash = df.withColumn("h", splitting.sample_hash(F.col("loan_id"), 42)).orderBy("h").limit(n)
    assert first == {r[0] for r in by_hash.collect()}


def test_other_seed_other_sample(spark):
    df = spark.range(500).withColumnRenamed("id", "loan_id")
    a = {r[0] for r in splitting.sample_rows(df, 50, seed=1).collect()}
    assert a != {r[0] for r in splitting.sample_rows(df, 50, seed=2).collect()}


def test_sample_writes_little_more_than_it_takes(spark, monkeypatch):
    written = []
    plain = splitting.materialise
    monkeypatch.setattr(splitting, "materialise", lambda df, name: written.append(plain(df, name)) or written[-1])
    df = spark.range(200_000, numPartitions=8).withColumnRenamed("id", "loan_id")
    assert splitting.sample_rows(df, 20_000).count() == 20_000
    assert len(written) == 1 and 20_000 <= written[0].count() <= 22_000
    with_gaps = df.limit(50).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS loan_id FROM range(30)"))
    assert splitting.sample_rows(with_gaps, 50).count() == 50 and splitting.sample_rows(with_gaps, 0).count() == 0
