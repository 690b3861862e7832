"""A bounded, repeatable sample of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def crc32_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key's decimal text, modulo ``folds``; null keys have no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds if isinstance(key, str) else (
        F.crc32(key.cast("string").cast("binary")) % folds)


def sampled(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """label, rank, doc_id, text (whole) of at most ``per_label`` rows a label, those with the smallest hash of doc_id.

    ``labels`` has doc_id and label. Ranking runs on keys alone: each task sends at most ``per_label`` keys a label.
    """
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = (labels.select(F.col("doc_id").cast("long"), F.col("label").cast("string"))
              .where("doc_id is not null and label is not null")
              .withColumn("rank", rank).where(F.col("rank") <= per_label))
    # at most labels x per_label rows of three numbers
    return (docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
            .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "label", "text"])
            .select("label", "rank", "doc_id", "text"))
