"""Encodings learned from the fit window (E6 to E11, E22, E23) and their table (A5).

All learned encodings come out of one scan: each row contributes one narrow
record per encoded column, pre-aggregated on the map side, so that a hot
category never concentrates in one task. The result is written once and every
later step (global rate, smoothing, frequencies, fallbacks) works on that table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from creditloom import policy
from creditloom.operators.lookup import attach
from creditloom.session import materialise

# Source column, feature name and smoothing weight.
TARGET_ENCODINGS = {"purpose": ("purpose_rate_enc", 300.0),
                    "addr_state": ("state_default_rate", 500.0)}
FREQUENCY_ENCODINGS = {"emp_title": "emp_title_log_freq"}
GLOBAL_RATE = "global_default_rate"
SERVING_RATE = 0.2     # fixed value: used when nothing was learned

TABLE_SCHEMA = T.StructType([
    T.StructField("encoding", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("fit_n", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("strategy", T.StringType())])


def fit_rate(df: DataFrame) -> float:
    """Default rate of the fit rows."""
    return df.agg(F.avg(F.when(F.col("is_fit"), F.col(policy.TARGET)))).first()[0]


def key_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fit rows and fit defaults per category of every column, one scan."""
    entries = F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).cast("string").alias("key"))
                        for c in columns])
    y = F.col(policy.TARGET).cast("bigint")
    return (df.select(F.col("is_fit"), y.alias("y"), F.inline(entries))
            .groupBy("source", "key")
            .agg(F.count_if("is_fit").alias("fit_n"),
                 F.coalesce(F.sum(F.when(F.col("is_fit"), F.col("y"))), F.lit(0)).alias("fit_y")))


def smoothed_rates(df: DataFrame, key: str, k: float, global_rate: float) -> DataFrame:
    """(sum + k g) / (n + k) per category; unseen categories get g."""
    counts = key_counts(df, [key]).filter(F.col("key").isNotNull())
    return counts.select("key", "fit_n", _smooth(k, F.lit(global_rate)).alias("value"))


def _smooth(k: float, g):
    return (F.when(F.col("fit_n") == 0, g)
            .otherwise((F.col("fit_y") + F.lit(k) * g) / (F.col("fit_n") + F.lit(k))))


@dataclass(frozen=True)
class Encodings:
    """The learned table with the few scalars planning needs."""

    table: DataFrame
    rows: dict[str, int]
    fallbacks: dict[str, float]

    @property
    def global_rate(self) -> float:
        return self.fallbacks.get(GLOBAL_RATE, SERVING_RATE)

    def save(self, path: str) -> None:
        (self.table.write.mode("overwrite").option("compression", "snappy").parquet(path))

    def apply(self, df: DataFrame, source: str, out: str) -> DataFrame:
        if out not in self.rows:
            return df
        part = self.table.filter((F.col("encoding") == out) & F.col("key").isNotNull())
        return attach(df, part, self.rows[out], source, out, self.fallbacks[out])


def describe_encodings(table: DataFrame) -> Encodings:
    """Read sizes and fallbacks off a learned table: one row per encoding."""
    rows = (table.groupBy("encoding")
            .agg(F.count("key").alias("n"), F.max(F.when(F.col("key").isNull(), F.col("value"))).alias("f"))
            .collect())
    return Encodings(table, {r["encoding"]: r["n"] for r in rows},
                     {r["encoding"]: r["f"] for r in rows})


def load_encodings(spark: SparkSession, path: str) -> Encodings:
    return describe_encodings(spark.read.schema(TABLE_SCHEMA).parquet(path))


def fit_encodings(df: DataFrame, strategy: str = "time_based_issue_d") -> Encodings:
    """Learn every encoding from rows flagged ``is_fit``.

    A row with a NULL key carries the fallback of its encoding.
    """
    sources = [c for c in (*TARGET_ENCODINGS, *FREQUENCY_ENCODINGS) if c in df.columns]
    if not sources:
        rate = fit_rate(df)
        table = (df.sparkSession.range(1)
                 .select(F.lit(GLOBAL_RATE).alias("encoding"), F.lit(None).cast("string").alias("key"),
                         F.lit(0).cast("bigint").alias("fit_n"), F.lit(rate).alias("value"),
                         F.lit(strategy).alias("strategy")))
        return describe_encodings(table)
    counts = materialise(key_counts(df, sources), "key-counts")
    totals = {r["source"]: r for r in counts.groupBy("source").agg(
        F.sum("fit_n").alias("n"), F.sum("fit_y").alias("y"),
        F.sum(F.when(F.col("key").isNotNull(), F.col("fit_n"))).alias("keyed"),
        F.min(F.when((F.col("fit_n") > 0) & F.col("key").isNotNull(), F.col("fit_n"))).alias("least"),
    ).collect()}
    first = totals[sources[0]]
    rate = first["y"] / first["n"] if first["n"] else SERVING_RATE

    def frequency(n: float, keyed: int):
        return F.log1p((n / F.lit(float(keyed))).cast("float").cast("double"))

    parts = []
    fallback_rows = [(GLOBAL_RATE, rate)]
    keyed_counts = counts.filter(F.col("key").isNotNull())
    for c, (name, k) in TARGET_ENCODINGS.items():
        if c in sources:
            parts.append(keyed_counts.filter(F.col("source") == c).select(
                F.lit(name).alias("encoding"), "key", "fit_n",
                _smooth(k, F.lit(rate)).cast("double").alias("value")))
            fallback_rows.append((name, rate))
    frequency_floor = []
    for c, name in FREQUENCY_ENCODINGS.items():
        if c in sources:
            keyed, least = totals[c]["keyed"] or 0, totals[c]["least"]
            if keyed:
                parts.append(keyed_counts.filter((F.col("source") == c) & (F.col("fit_n") > 0)).select(
                    F.lit(name).alias("encoding"), "key", "fit_n",
                    frequency(F.col("fit_n"), keyed).alias("value")))
                frequency_floor.append((name, frequency(F.lit(least), keyed)))
            else:
                frequency_floor.append((name, F.lit(0.0)))
    fallback = F.array(*[F.struct(F.lit(n).alias("encoding"), F.lit(float(v)).alias("value"))
                         for n, v in fallback_rows],
                       *[F.struct(F.lit(n).alias("encoding"), v.alias("value"))
                         for n, v in frequency_floor])
    table = (df.sparkSession.range(1).select(F.inline(fallback))
             .select("encoding", F.lit(None).cast("string").alias("key"),
                     F.lit(0).cast("bigint").alias("fit_n"), "value"))
    for part in parts:
        table = table.unionByName(part)
    table = table.withColumn("strategy", F.lit(strategy))
    return describe_encodings(materialise(table, "encodings"))


def label_indexes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sorted distinct values of each column with their 0-based index.

    The distinct values are range-sorted and written once; each written part
    then numbers its own rows, and the part totals (one row per part) give the
    offsets. No task ever holds more than one part.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label"))
                        for c in columns])
    distinct = (df.select(F.inline(entries)).filter(F.col("label").isNotNull())
                .distinct().orderBy("column_name", "label")
                .withColumn("part", F.spark_partition_id()))
    stored = materialise(distinct, "labels")
    sizes = stored.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("column_name", "part",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("column_name", "part").orderBy("label")
    return (stored.withColumn("n", F.row_number().over(within) - 1)
            .join(F.broadcast(offsets), ["column_name", "part"])
            .select("column_name", "label", (F.col("n") + F.col("offset")).cast("double").alias("label_index")))


def apply_label_indexes(df: DataFrame, indexes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace labels by their index as float; unseen labels share index 0."""
    stored = materialise(indexes, "label-index")
    sizes = {r["column_name"]: r["n"] for r in
             stored.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in columns:
        part = stored.filter(F.col("column_name") == c).select(
            F.col("label").alias("key"), F.col("label_index").alias("value"),
            F.lit(1).cast("bigint").alias("fit_n"))
        df = attach(df.withColumn(c, F.col(c).cast("string")), part, sizes.get(c, 0), c, "_index", 0.0)
        df = df.withColumn(c, F.col("_index").cast("float")).drop("_index")
    return df


@dataclass(frozen=True)
class ClassWeights:
    negatives: int
    positives: int

    @property
    def weights(self) -> tuple[float, float]:
        n = self.negatives + self.positives
        return n / (2 * self.negatives), n / (2 * self.positives)

    @property
    def imbalance(self) -> float:
        return self.negatives / self.positives


def class_weights(df: DataFrame, label: str = policy.TARGET) -> ClassWeights:
    """Balanced weights n / (2 n_class) and the negative-to-positive ratio."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("neg"),
                 F.count_if(F.col(label) == 1).alias("pos")).first()
    return ClassWeights(row["neg"], row["pos"])


def add_class_weight(df: DataFrame, weights: ClassWeights, label: str = policy.TARGET,
                     out: str = "class_weight") -> DataFrame:
    w0, w1 = weights.weights
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))
