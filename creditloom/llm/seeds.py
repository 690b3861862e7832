"""Benchmark decontamination by spaced seeds.

A mask reads some of the words of a window and ignores the others, so its hash survives substitutions at the ignored
places. Seeds of the benchmark and of the texts are joined on their hashes; each hit gives a diagonal (place in the text
less place in the item), on which the words are compared one by one. An overlap is a long stretch there that is mostly equal,
or a whole item; how many of its words have to be equal depends on its length.

Texts and items are told apart by what they say (128 and 64 bits of it), never by their ids: repeated ids hide nothing, and
each different text is compared once however many rows hold it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.hashing import batch_words, sequence_hash, windows
from creditloom.llm.memo import release, small_batches
from creditloom.session import materialise

#: 1: the word counts; 0: it is ignored. A stretch without a hit has at most 2 k + 3 equal words beside k unequal ones,
#: as a run of 3 is followed by two unequal words or none; no overlap that is accepted below is like that.
MASKS = ("1111", "11101")
#: Equal words that a part of an item needs, and their least share of the stretch.
LEAST_EQUAL = 12
LEAST_SHARE = 0.75
#: What an unequal word costs: at this price a stretch is worth 0 or more if LEAST_SHARE of it is equal.
PENALTY = 3
#: Words below which an item has to be there as it is, and up to which SHORT_SHARE of it has to be equal.
WHOLE_WORDS, SHORT_WORDS, SHORT_SHARE = 8, 12, 0.8
#: log2 of the bits of the table that texts are sifted with before the join: 16 per benchmark seed, within these limits.
SIFT_BITS = (20, 30)
BROADCAST_ROWS = 1_000_000
#: Items of fewer words are too short for a mask: a text has to be the item, word for word.
SHORTEST = min(map(len, MASKS))
_PLACES = [tuple(i for i, c in enumerate(mask) if c == "1") for mask in MASKS]


def _seeds_of(words: np.ndarray) -> list[np.ndarray]:
    """One array per mask, all that fit; of fewer words than the shortest mask has, the words as a whole."""
    if 0 < len(words) < SHORTEST:
        return [np.array([sequence_hash(words)], dtype=np.uint64)]
    return [windows(words, places) ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))
            for k, places in enumerate(_PLACES)]


def _benchmark_seeds(batches):
    for batch in batches:
        keys = batch.column(0)
        for row, words, _, _ in batch_words(batch.column(1)):
            for found in _seeds_of(words):
                if len(found):
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(np.full(n, keys[row].as_py())),
                         pa.array(np.arange(n, dtype=np.int64))], ["seed", "item_key", "item_at"])


def _sift_table(seeds: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """Two bits per benchmark seed. Its size is bounded by SIFT_BITS; a full table lets more through to the join."""
    bits = min(SIFT_BITS[1], max(SIFT_BITS[0], (16 * max(1, count)).bit_length()))
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    both = seeds.select(F.explode(F.array(
        F.shiftrightunsigned("seed", 64 - bits),
        F.shiftrightunsigned("seed", 24).bitwiseAND(F.lit((1 << bits) - 1)))).alias("bit")).distinct()
    # whole bytes of the table, added up in Spark: at most 2**(bits - 3) small rows
    filled = both.groupBy(F.shiftright("bit", 3).alias("byte")).agg(
        F.expr("sum(shiftleft(1, cast(bit & 7 as int)))").alias("value"))
    for row in filled.toLocalIterator():
        table[row.byte] = row.value
    return bits, table


def _sifter(shared):
    def run(batches):
        release()
        bits, table = shared.value

        def marked(at):
            return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

        for batch in batches:
            ids, seeds, places = [], [], []
            for row, words, _, _ in batch_words(batch.column(1)):
                for found in _seeds_of(words):
                    if not len(found):
                        continue
                    at = np.flatnonzero(marked(found >> np.uint64(64 - bits)))
                    if len(at):
                        second = (found[at] >> np.uint64(24)) & np.uint64((1 << bits) - 1)
                        at = at[marked(second) == 1]
                    if len(at):
                        ids.append(np.full(len(at), row))
                        seeds.append(found[at].view(np.int64))
                        places.append(at)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(ids))), pa.array(np.concatenate(seeds)),
                     pa.array(np.concatenate(places).astype(np.int64))], ["mark", "seed", "doc_at"])
    return run


def best_stretch(equal: np.ndarray, penalty: int = PENALTY) -> tuple[int, int, int]:
    """(start, end, equal words) of the stretch with most equal words among those with at least as many as ``penalty`` x
    unequal words. It starts and ends with equal words.

    Seeking the largest difference instead would miss a long stretch of just that share beside a short perfect one.
    """
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -penalty))])
    count = np.concatenate([[0], np.cumsum(equal)])
    first = np.searchsorted(-np.minimum.accumulate(total), -total)  # longest stretch that ends here
    found = count - count[first]
    end = int(np.argmax(found))
    if not found[end]:
        return 0, 0, 0
    inside = np.flatnonzero(equal[first[end]:end]) + first[end]
    return int(inside[0]), int(inside[-1]) + 1, len(inside)


def least_of_whole(words: int) -> int:
    """Equal words that make a copy of a whole item of so many words."""
    if words < WHOLE_WORDS:
        return words
    return math.ceil((SHORT_SHARE if words <= SHORT_WORDS else LEAST_SHARE) * words)


def overlap(equal: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """(start, end, equal words) of the overlap on one diagonal, or None: the whole item or a part of it."""
    start, end, n = best_stretch(equal)
    if n >= LEAST_EQUAL:
        return start, end, n
    places = np.flatnonzero(equal)
    if len(places) and len(places) >= least_of_whole(item_words):
        return int(places[0]), int(places[-1]) + 1, len(places)
    return None


def _verify(batches):
    for batch in batches:
        names = ["mark", "item_id", "doc_start", "n_words", "n_equal"]
        texts, items = batch.column(2), batch.column(3)
        pairs = batch.column(4).to_pylist()
        words = {row: w for row, w, _, _ in batch_words(texts)}
        wanted = {row: w for row, w, _, _ in batch_words(items)}
        rows, out = [], []
        for row, diagonals in enumerate(pairs):
            doc, item = words[row], wanted[row]
            best = None
            if len(item) < SHORTEST:
                diagonals = [0] if len(doc) == len(item) else []
            for diagonal in diagonals:
                a, b = max(0, diagonal), min(len(doc), diagonal + len(item))
                if b <= a:
                    continue
                found = overlap(doc[a:b] == item[a - diagonal:b - diagonal], len(item))
                if found and (best is None or found[2] > best[2]):
                    best = (a + found[0], found[1] - found[0], found[2])
            if best:
                rows.append(row)
                out.append(best)
        kept = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept),
                                          *(pa.array([r[k] for r in out], pa.int64()) for k in range(3))], names)


def _mark(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.concat(F.hex(F.xxhash64(text)), F.lit("-"), F.hex(F.xxhash64(F.lit("second"), text)))


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _mark(F.col("text")).alias("mark"))


def _overlapping(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(mark, item_id, doc_start, n_words, n_equal) for each different text and benchmark item that it overlaps."""
    small_batches(docs.sparkSession)
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item"))
             .where("item is not null").withColumn("item_key", F.xxhash64("item")))
    different = items.select("item_key", "item").dropDuplicates()
    seeds = materialise(different.mapInArrow(_benchmark_seeds, "seed long, item_key long, item_at long"), "seeds")
    shared = docs.sparkSession.sparkContext.broadcast(_sift_table(seeds, seeds.count()))
    texts = _marked(docs).select("mark", "text").where("text is not null")
    hits = texts.mapInArrow(_sifter(shared), "mark string, seed long, doc_at long")
    pairs = materialise(hits.join(seeds, "seed").select("mark", "item_key", (F.col("doc_at") - F.col("item_at")).alias("d"))
                        .groupBy("mark", "item_key").agg(F.sort_array(F.collect_set("d")).alias("diagonals")), "pairs")
    # The plan depends on this count, the result doesn't.
    small = pairs.count() <= BROADCAST_ROWS
    found = texts.join(F.broadcast(pairs) if small else pairs, "mark").join(items, "item_key")
    return (found.select("mark", "item_id", "text", "item", "diagonals").dropDuplicates(["mark", "item_id", "item"])
            .mapInArrow(_verify, "mark string, item_id long, doc_start long, n_words long, n_equal long")
            .groupBy("mark", "item_id").agg(
                F.max(F.struct("n_equal", (-F.col("doc_start")).alias("at"), "n_words")).alias("best"))
            .select("mark", "item_id", (-F.col("best.at")).alias("doc_start"), "best.n_words", "best.n_equal"))


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, doc_start, n_words, n_equal: the best overlap of each document with each benchmark item it overlaps.

    Null texts and texts without words overlap nothing; an item of fewer than four words overlaps texts that are just
    it. Items without item_id are left out here. Rows that repeat a doc_id, and all rows without one, are one document, and rows that repeat an item_id one item: of
    their overlaps the one with most equal words counts, then the earliest, then the longest. Places count words from 0.
    """
    found = materialise(_overlapping(docs, benchmark).where("item_id is not null"), "overlaps")
    return (_marked(docs).select("doc_id", "mark").join(_few(found), "mark").groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_equal", (-F.col("doc_start")).alias("at"), "n_words")).alias("best"))
        .select("doc_id", "item_id", (-F.col("best.at")).alias("doc_start"), "best.n_words", "best.n_equal"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose own text overlaps a benchmark item, whatever the ids of either."""
    leaks = materialise(_overlapping(docs, benchmark).select(F.col("mark").alias("leak")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"), _mark(F.col("text")).alias("mark"))
    return rows.join(_few(leaks), F.col("mark") == F.col("leak"), "left_anti").select("row.*")
