"""Running totals over globally ordered scores, without a global window.

Scores are pre-aggregated per distinct value, cut into ranges of about equal
row count, summed inside each range, and shifted by the totals of the ranges
above. Only the range totals (a few rows per range) are ever put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.functions.bins import grid_bucket
from creditloom.functions.numeric import present

SKETCH_ACCURACY = 10_000


def range_edges(df: DataFrame, column: str, ranges: int) -> list[float]:
    """Edges that cut the values into ranges of about equal row count.

    At most ``ranges`` numbers reach the driver. Being plain constants from then
    on, they give every re-run task the same assignment of rows to ranges.
    """
    if ranges < 2:
        return []
    fractions = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), fractions,
                                       F.lit(SKETCH_ACCURACY))).first()[0]
    return sorted(set(found or []))


def default_ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def score_table(df: DataFrame, score: str = "pd", label: str = "default",
                group: str | None = None, ranges: int | None = None) -> DataFrame:
    """One row per distinct score with what lies at or above it.

    Columns: [group], score, pos, neg (at this score), tp, fp (at or above it),
    positives, negatives (in all). A NULL or NaN score fails the job.
    """
    edges = range_edges(df, score, ranges or default_ranges(df))
    keys = [group] if group else []
    counts = (df.select(*keys, present(F.col(score).cast("double"), f"Score {score}").alias("score"), F.col(label).alias("y"))
              .groupBy(*keys, "score")
              .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")))
    return running_counts(counts, edges, group)


def running_counts(counts: DataFrame, edges: list[float], group: str | None = None) -> DataFrame:
    """``score_table`` of rows ([group], score, pos, neg), one a score, cut at ``edges``."""
    keys = [group] if group else []
    if edges:
        counts = grid_bucket(counts, "score", edges, "range_no")
    else:
        counts = counts.withColumn("range_no", F.lit(0))

    totals = counts.groupBy(*keys, "range_no").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    whole = Window.partitionBy(*keys)
    above = whole.orderBy(F.desc("range_no")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "range_no",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("p").over(whole).alias("positives"), F.sum("n").over(whole).alias("negatives"))
    within = (Window.partitionBy(*keys, "range_no").orderBy(F.desc("score"))
              .rowsBetween(Window.unboundedPreceding, 0))
    return (counts.withColumns({"tp_in": F.sum("pos").over(within), "fp_in": F.sum("neg").over(within)})
            .join(F.broadcast(offsets), [*keys, "range_no"])
            .select(*keys, "score", "pos", "neg",
                    (F.col("tp_in") + F.col("p_above")).alias("tp"),
                    (F.col("fp_in") + F.col("n_above")).alias("fp"),
                    "positives", "negatives"))
