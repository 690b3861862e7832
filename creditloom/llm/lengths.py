"""Token counts: an exact histogram of encoded lengths, and suffix sums that answer for every context limit."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.memo import per_process, slices, small_batches

CACHED_PIECES = 200_000
#: Neighbouring lengths whose sums are taken together before the running sums.
BLOCK = 1_024


class _PieceLengths(dict):
    """Tokens of a piece of text, encoded when first met; the cache is emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece.encode()))
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = n
        return n


def piece_counter(ranks: bytes, pattern: str):
    """Function from text to its number of tokens under a rank file and the pattern that splits text before merging."""
    import regex
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding("lengths", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    lengths = _PieceLengths(encoding._core_bpe.encode_single_piece).__getitem__
    pieces = regex.compile(pattern).findall
    return lambda text: sum(map(lengths, pieces(text)))


def _counter(shared):
    def run(batches):
        rule = shared.value
        count = per_process("lengths", rule, lambda: piece_counter(*rule))
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([count(t) if t else 0 for t in batch.columns[-1].to_pylist()], pa.int64())],
                [*batch.schema.names[:-1], "n_tokens"])
    return run


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens of every row of ``docs`` (doc_id, text); a null text has 0 tokens."""
    small_batches(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counter(shared), "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: exact counts, combined in each task before the shuffle."""
    return lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as context limit: what fits, what is cut and what is left.

    n_tokens (the limit), n_docs of this very length, docs_at_most, docs_longer, share_at_most (so the limit is the
    quantile of that share), tokens_whole (in texts that fit), tokens_truncated (all texts, each cut at the limit) and
    tokens_lost. Between two limits the answer follows from the lower row: each of its docs_longer adds one token per
    step. An empty histogram gives no rows.
    """
    sums = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                            F.floor(F.col("n_tokens") / BLOCK).alias("block"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    zero = F.lit(0).cast("long")
    tops = totals.select("block", F.coalesce(F.sum("block_docs").over(above), zero).alias("docs_above"),
                         F.coalesce(F.sum("block_tokens").over(above), zero).alias("tokens_above"))
    whole = totals.agg(F.sum("block_docs").alias("all_docs"), F.sum("block_tokens").alias("all_tokens"))
    suffix = (sums.withColumns({"docs_in": F.coalesce(F.sum("n_docs").over(inside), zero),
                                "tokens_in": F.coalesce(F.sum("tokens").over(inside), zero)})
              .join(tops, "block").join(F.broadcast(whole))
              .withColumns({"docs_longer": F.col("docs_in") + F.col("docs_above"),
                            "tokens_longer": F.col("tokens_in") + F.col("tokens_above")}))
    lost = F.col("tokens_longer") - F.col("docs_longer") * F.col("n_tokens")
    return suffix.select(
        "n_tokens", "n_docs", (F.col("all_docs") - F.col("docs_longer")).alias("docs_at_most"), "docs_longer",
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("share_at_most"),
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_whole"),
        (F.col("all_tokens") - lost).alias("tokens_truncated"), lost.alias("tokens_lost"))


def at_limits(histogram: DataFrame, wanted: list[int]) -> DataFrame:
    """The figures of ``limits`` for any limits, whether or not a text has that length; quantiles need share_at_most."""
    over = F.greatest(F.col("n_tokens") - F.col("limit"), F.lit(0))
    asked = F.explode(F.array(*[F.lit(int(w)).cast("long") for w in wanted])).alias("limit")
    return histogram.select("*", asked).groupBy("limit").agg(
        F.sum(F.when(F.col("n_tokens") <= F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_at_most"),
        F.sum(F.col("n_docs") * F.least("n_tokens", "limit")).alias("tokens_truncated"),
        F.sum(F.col("n_docs") * over).alias("tokens_lost"))
