"""How often sources are read, and how wide a scan's aggregation gets; on rows of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import contract, profiling, quantiles
from creditloom.session import fresh_path
from creditloom.sources import tables


def counted_source(spark, rows):
    """Rows that count how often they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return rows.mapInArrow(through, rows.schema), seen


def test_describe_reads_its_source_once(spark):
    rows = spark.range(3000).select(((F.col("id") * 37) % 1009).cast("double").alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("b"))
    source, seen = counted_source(spark, rows)
    got = {r["feature"]: r for r in profiling.describe(source, ["a", "b"]).collect()}
    assert seen.value == 3000
    a = np.array([(i * 37) % 1009 for i in range(3000)], dtype=float)
    assert got["a"]["p50"] == np.quantile(a, 0.5) and got["b"]["count"] == 2400


def test_split_valid_reads_its_source_once(spark):
    rows = spark.range(100).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 4 != 0, F.lit(36.0)).alias("term"))
    source, seen = counted_source(spark, rows)
    valid, rejects = contract.split_valid(source)
    assert valid.count() + rejects.count() == 100
    assert rejects.filter(F.array_contains("violations", "term: required")).count() == 25
    assert seen.value == 100


@pytest.mark.parametrize("finish_values", [1, 50, 4_000_000])
def test_quantiles_with_ties_nulls_and_signs(spark, finish_values):
    values = [None if i % 11 == 0 else float((i * 7919) % 503 - 250) / (1 + i % 3) for i in range(5000)] + [0.0, -0.0] * 20
    df = spark.createDataFrame([(v, 1.0 if v is None else 2.0) for v in values], "a double, b double")
    fractions = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = quantiles.exact_quantiles(df, {"a": fractions, "b": fractions}, finish_values=finish_values)
    have = np.array([v for v in values if v is not None])
    assert all(abs(found["a"][q].value - np.quantile(have, q)) < 1e-12 for q in fractions)
    assert all(found["b"][q].value == np.quantile([1.0 if v is None else 2.0 for v in values], q) for q in fractions)


def test_bracket_counts_are_few_values_a_task(spark):
    """Sums per place, whatever the number of brackets, instead of four aggregates a bracket."""
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    [(counts, bounds)] = quantiles._counts_between(df, [(F.col("a"), {10.0, 20.0, 500.5})])
    assert bounds.tolist() == [10.0, 20.0, 500.5] and counts.tolist() == [10, 1, 9, 1, 480, 0, 499]


def test_csv_copy_in_many_pieces_is_not_dealt_out_again(spark):
    path = fresh_path(spark, "csv")
    tables.write_csv(spark.range(2000).repartition(6).select(F.col("id").alias("loan_id"), F.md5(F.col("id").cast("string")).alias("desc")), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "4096")
        many = tables.read_raw_csv(spark, path, partitions=4)
        assert many.rdd.getNumPartitions() > 4 and many.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    few = tables.read_raw_csv(spark, path, partitions=40)
    assert few.rdd.getNumPartitions() == 40 and few.count() == 2000
