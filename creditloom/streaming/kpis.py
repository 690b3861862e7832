"""KPIs of scored applications per window of time, kept up by a stream (F6 on F8's output).

The state is one small row of sums per window; the watermark lets it go once a window is over. Every batch writes the
windows that changed, with their sums so far, so the last row of a window is its figure. What comes after the watermark
has passed its window is dropped and shows up in ``late_rows``. State, offsets and output lie in shared storage: a query
started again on the same checkpoint goes on where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

EVENT_TIME = "scored_at"
#: What a window keeps; sums and counts only, so windows can be added up.
SUMS = ("scored", "with_probability", "flagged", "high_risk", "probability_sum")


def scored_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Scored applications from parquet files as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_sums(scored: DataFrame, window: str, event_time: str = EVENT_TIME) -> DataFrame:
    """The sums behind the KPIs per window, for a table or a stream."""
    return (scored.groupBy(F.window(event_time, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("scored"), F.count("default_probability").alias("with_probability"),
                 F.count_if(F.col("prediction") == 1).alias("flagged"),
                 F.count_if(F.col("risk_tier").isin("High", "Very High")).alias("high_risk"),
                 F.sum("default_probability").alias("probability_sum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *SUMS))


def kpi_stream(scored: DataFrame, window: str, watermark: str, out: str, checkpoint: str,
               event_time: str = EVENT_TIME) -> StreamingQuery:
    """Keep the sums of each window up to date in ``out``; stop when caught up.

    ``out`` gets one folder per batch, written over when a batch is repeated after a failure, so nothing is ever counted
    twice.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    sums = windowed_sums(scored.withWatermark(event_time, watermark), window, event_time)
    return (sums.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def kpi_table(spark: SparkSession, out: str) -> DataFrame:
    """The latest figures of each window (F6): scored, flagged, mean probability, high risk."""
    last = (spark.read.parquet(out).groupBy("window_start", "window_end")
            .agg(F.max_by(F.struct(*SUMS), F.col("batch")).alias("s")).select("window_start", "window_end", "s.*"))
    return last.select("window_start", "window_end", "scored", "flagged",
                       F.try_divide("probability_sum", "with_probability").alias("mean_probability"), "high_risk")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed their window, over the query's batches so far."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
