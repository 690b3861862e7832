"""Line dedup with two Bloom filters.

Tasks put the hash of every long line of a text into a filter of lines seen once; a line that it already holds goes into a
filter of lines seen twice. Filters of two tasks merge into bits of either, and what both have seen once counts as seen
twice. A hash that the merged second filter lacks is in one text only. The others, the suspected repeats, are all that
is shuffled: their 128-bit names confirm exactly in how many documents a line lies, and in which it stays.

The filters only decide what is confirmed, never the result. They take BITS_PER_LINE bits a line up to ``max_bits``; a
corpus of more lines fills them, and then more of its lines (24 bytes each) are shuffled for confirmation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from creditloom.session import materialise

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
BITS_PER_LINE = 16
MIN_BITS = 1 << 19
#: The filter that is sent to all tasks takes at most 64 MB.
MAX_BITS = 1 << 29
PROBES = 2
#: Filters are merged in pieces of 64 KB, and at most so many tasks fill one.
SEGMENT = 1 << 16
BUILD_TASKS = 256
BLOCK = 1 << 20
#: Entries (16 bytes and their row) up to which a table of keys is broadcast.
BROADCAST_ROWS = 1_000_000
SALTS = 64
#: A line is hot if so many suspected rows hold it for each row that a broadcast may have: at most SALTS such lines a million.
HOT_ROWS = 100_000
#: White space at both ends of a line, and the letters that count as their lower case.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _first_hash(key: Column) -> Column:
    return F.xxhash64(key)


def line_names(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, names): the 128-bit names (a, b) of the different long lines of each text with any."""
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), line_key),
                                     lambda k: F.char_length(k) >= least_chars))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), keys.alias("keys"))
            .where("doc_id is not null and size(keys) > 0")
            .select("doc_id", F.transform("keys", lambda k: F.struct(
                _first_hash(k).alias("a"), F.xxhash64(F.lit("second"), k).alias("b"))).alias("names")))


# --- the two filters

def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of a hash: disjoint groups of its bits, scrambled."""
    h = hashes.view(np.uint64)
    second = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return [(x >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64) for x in (h, second)][:PROBES]


def _holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), dtype=bool)
    for at in _probes(hashes, len(table) * 8):
        found &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def _put(table: np.ndarray, hashes: np.ndarray) -> None:
    for at in _probes(hashes, len(table) * 8):
        np.bitwise_or.at(table, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _hashes(column) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _fill(bits: int):
    """The segments of a task's two filters, compressed."""
    def run(batches):
        once, twice = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            found = _hashes(batch.column(0))
            for start in range(0, len(found), BLOCK):
                own, times = np.unique(found[start:start + BLOCK], return_counts=True)
                _put(twice, own[(times > 1) | _holds(once, own)])
                _put(once, own)
        pack = zstandard.ZstdCompressor(level=1).compress
        for segment in range(len(once) // SEGMENT):
            part = slice(segment * SEGMENT, (segment + 1) * SEGMENT)
            if once[part].any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([segment], pa.int64()), "once": pa.array([pack(once[part].tobytes())], pa.binary()),
                    "twice": pa.array([pack(twice[part].tobytes())], pa.binary())})
    return run


def _merge(batches):
    """Merged second filters of segments that come one after the other."""
    unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    now, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict({"segment": pa.array([now], pa.int64()),
                                           "twice": pa.array([pack(twice.tobytes())], pa.binary())})

    for batch in batches:
        for segment, more, again in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != now:
                if now is not None:
                    yield done()
                now, once, twice = segment, np.zeros(SEGMENT, np.uint8), np.zeros(SEGMENT, np.uint8)
            more = np.frombuffer(unpack(more), np.uint8)
            twice |= np.frombuffer(unpack(again), np.uint8) | (once & more)
            once |= more
    if now is not None:
        yield done()


def seen_twice(names: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter of hashes that more than one row of ``names`` may hold."""
    lines = names.agg(F.sum(F.size("names"))).first()[0] or 0
    bits = MIN_BITS
    while bits < min(max_bits, BITS_PER_LINE * lines):
        bits *= 2
    hashes = names.select(F.col("names.a").alias("a"))
    merged = (hashes.coalesce(BUILD_TASKS).mapInArrow(_fill(bits), "segment long, once binary, twice binary")
              .repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment long, twice binary"))
    table = np.zeros(bits // 8, dtype=np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for row in merged.toLocalIterator():
        table[row["segment"] * SEGMENT:(row["segment"] + 1) * SEGMENT] = np.frombuffer(unpack(bytes(row["twice"])), np.uint8)
    return table


def _suspects(shared):
    def run(batches):
        for batch in batches:
            flat = pc.list_flatten(batch.column(1))
            rows = pc.list_parent_indices(batch.column(1)).to_numpy(zero_copy_only=False)
            a = flat.field("a").to_numpy(zero_copy_only=False)
            keep = _holds(shared.value, a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[keep])), pa.array(a[keep]),
                 pa.array(flat.field("b").to_numpy(zero_copy_only=False)[keep])], ["doc_id", "a", "b"])
    return run


# --- confirmation

def repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS,
                   max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Suspected rows (doc_id, a, b), and the lines in enough documents: a, b, documents, rows, stays (the largest doc_id)."""
    names = materialise(line_names(docs, least_chars), "names")
    shared = docs.sparkSession.sparkContext.broadcast(seen_twice(names, max_bits))
    # two rows with one doc_id are one document; the first step spreads a frequent line over all tasks
    suspects = materialise(names.mapInArrow(_suspects(shared), "doc_id long, a long, b long")
                           .dropDuplicates(["a", "b", "doc_id"]), "suspects")
    repeats = materialise(suspects.groupBy("a", "b").agg(F.count("*").alias("documents"), F.max("doc_id").alias("stays"))
                          .where(F.col("documents") >= least_documents), "repeats")
    return suspects, repeats


def _gone(suspects: DataFrame, repeats: DataFrame, broadcast_rows: int) -> DataFrame:
    """(doc_id, gone): the lines that each document loses, by their first hash.

    Few repeated lines are broadcast. Of more, the hot ones (at most one for every HOT_ROWS suspected rows) are broadcast
    and the others, none of them frequent, are shuffled.
    """
    if repeats.count() <= broadcast_rows:
        found = suspects.join(F.broadcast(repeats), ["a", "b"])
    else:
        hot = F.broadcast(repeats.where(F.col("documents") > HOT_ROWS))
        cold = repeats.where(F.col("documents") <= HOT_ROWS)
        found = (suspects.join(hot, ["a", "b"])
                 .unionByName(suspects.join(hot, ["a", "b"], "left_anti").join(cold.hint("shuffle_merge"), ["a", "b"])))
    return found.where("doc_id <> stays").groupBy("doc_id").agg(F.collect_list("a").alias("gone"))


@F.pandas_udf(ArrayType(BooleanType()))
def _stays(hashes: pd.Series, gone: pd.Series) -> pd.Series:
    """For each line of a text whether it stays; null where none goes."""
    return pd.Series([None if g is None else ~np.isin(h, g) for h, g in zip(hashes, gone)], dtype=object)


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS,
                        max_bits: int = MAX_BITS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with their remaining text, n_lines (before) and n_dropped; columns of docs with these two names give way.

    Lines are what newlines separate; a null or empty text has one empty line and its text becomes empty. A line's key
    is the line without white space at its ends, A-Z in lower case. A key of at least ``least_chars`` code points in at
    least ``least_documents`` documents loses its lines everywhere but in the largest doc_id that holds it, where all of
    them stay. Rows that repeat a doc_id are one document, each with its own text. A row without doc_id is no document:
    it counts for nothing and keeps its lines. Inside one text lines are told apart by 64 bits, among texts by 128.
    """
    suspects, repeats = repeated_lines(docs, least_chars, least_documents, max_bits)
    gone = materialise(_gone(suspects, repeats, broadcast_rows), "gone")
    size = gone.agg(F.sum(1 + F.size("gone"))).first()[0] or 0
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.struct("*").alias("row"))
    gone = gone.withColumnRenamed("doc_id", "key")
    joined = rows.join(F.broadcast(gone) if size <= broadcast_rows else gone, "key", "left")

    def name(line):
        key = line_key(line)
        return F.when(F.char_length(key) >= least_chars, _first_hash(key))
    stays = _stays(F.when(F.col("gone").isNotNull(), F.transform(_lines(F.col("row.text")), name)), F.col("gone"))
    marked = joined.select("row", _lines(F.col("row.text")).alias("lines"), stays.alias("stays"))
    kept = F.when(F.col("stays").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line, i: F.get("stays", i)))
    split = marked.select("row", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return split.select(*own, F.array_join("kept", "\n").alias("text"), "n_lines",
                        (F.col("n_lines") - F.size("kept")).alias("n_dropped"))


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped",
                          F.sha2("text", 256).alias("kept_sha256"))
