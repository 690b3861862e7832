"""Applications that arrive as files: validated, scored, appended (F8).

Scoring keeps no state, so the stream runs the very transformation the batch
runs. Checkpoint and output live in shared storage; a restarted query continues
where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from creditloom.operators.contract import application_schema
from creditloom.operators.encoding import Encodings
from creditloom.operators.scoring import ScoringModel, judge_and_score
from creditloom.sources.tables import nan_to_null


def application_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Applications from parquet files as they appear in a folder; NaN becomes NULL."""
    return nan_to_null(spark.readStream.schema(application_schema()).option("maxFilesPerTrigger", files_per_trigger)
                       .parquet(folder))


def score_stream(applications: DataFrame, model: ScoringModel, encodings: Encodings, out: str,
                 checkpoint: str) -> StreamingQuery:
    """Append scored applications, and rejected ones with reasons, to ``out``; stop when caught up.

    Valid and rejected rows go through one sink, told apart by ``violations``,
    so the source is read once.
    """
    judged = judge_and_score(applications, model, encodings)
    return (judged.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
