"""N-gram Jaccard join by rare-first prefix filtering.

Each text becomes its set of 5-word shingle hashes; equal sets form one class. All sets are put into one global order:
shingles outside the list of frequent ones first (by hash), then the frequent ones by rising count. Two sets of
similarity t share an element among the first n - ceil(t*n) + 1, so only these prefixes are dealt out by token.

Candidates come from rounds over the tokens that several classes share:

1. star: in each token's bucket every class meets one leader, the class with the fewest rare shingles. Members of a
   large group of near copies are joined to its centre by a number of pairs linear in the group.
2. centre: the largest component among a token's classes, over all its buckets, sends its class with the fewest rare
   shingles to meet every class of the token that is in another component. This is repeated while it links any, and
   takes in copies that lay too far from their own bucket's leader, again by one pair a class and token.
3. cross: classes of one token that are still not in one component meet each other.

A link inside a component changes no component, so all rounds together lose none that matters. A pair passes the length
filter, the positional filter (what can still follow the shared token in both) and the suffix filter (shingle counts
in 64 parts of the hash space bound the symmetric difference from below), is made once and verified once on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.components import connected_components
from creditloom.llm.hashing import batch_words, shingle_set
from creditloom.llm.memo import release, small_batches
from creditloom.session import materialise

SHINGLE = 5
PERCENT = 80
#: Length of the list of frequent shingles; a proven bound of 4 MB for its broadcast. It only orders the tokens.
FREQUENT = 1 << 18
#: Shingles counted together in a task before counts below LOCAL_LEAST are left out of the list.
COUNT_BLOCK = 1 << 20
LOCAL_LEAST = 3
#: A set of n shingles is counted in the largest power of two of parts that leaves at least so many in each.
PART_SHINGLES = 4
#: Frequent tokens are spread over so many buckets, each with its own leader.
SALTS = 8
#: Rows of a key table (16 bytes each) up to which it is broadcast; what is wider is left to Spark, which knows the size of
#: each written table.
BROADCAST_ROWS = 1_000_000
_EMITTED = 100_000


def _as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _count_frequent(batches):
    """(hash, count) of shingles found in at least LOCAL_LEAST texts of one block."""
    release()
    held, size = [], 0

    def flush():
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= LOCAL_LEAST
        return pa.RecordBatch.from_arrays(
            [pa.array(_as_long(keys[often])), pa.array(counts[often].astype(np.int64))], ["token", "texts"])

    for batch in batches:
        for _, words, _, _ in batch_words(batch.column(0)):
            found = shingle_set(words, SHINGLE)
            if len(found):
                held.append(found)
                size += len(found)
            if size >= COUNT_BLOCK:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def frequent_shingles(docs: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The ``limit`` most frequent shingles and their counts, sorted by hash."""
    counts = docs.select("text").mapInArrow(_count_frequent, "token long, texts long")
    top = (counts.groupBy("token").agg(F.sum("texts").alias("texts"))
           .orderBy(F.desc("texts"), "token").limit(limit).toPandas())
    tokens = top["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["texts"].to_numpy(dtype=np.int64)[order]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _profiler(shared, percent: int):
    """One row per text; a set that this task has sent before comes without its prefix."""
    def run(batches):
        release()
        keys, counts = shared.value
        sent: set[int] = set()
        for batch in batches:
            ids, sids, sizes, loose, rares, prefixes, parts = [], [], [], [], [], [], []
            id_column = batch.column(0)
            for row, words, _, _ in batch_words(batch.column(1)):
                found = shingle_set(words, SHINGLE)
                n = len(found)
                sid = int.from_bytes(_digest(found), "little", signed=True) if n else None
                ids.append(id_column[row])
                sids.append(sid)
                sizes.append(n)
                if not n or sid in sent or not id_column[row].is_valid:
                    loose.append(0), rares.append(0), prefixes.append(None), parts.append(None)
                    continue
                if len(sent) < _EMITTED:
                    sent.add(sid)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    weight = np.where(keys[at] == found, counts[at], 0)
                else:
                    weight = np.zeros(n, dtype=np.int64)
                rare = int(np.count_nonzero(weight == 0))
                order = np.lexsort((found, weight))[:prefix_length(n, percent)]
                loose.append(rare * 1_000_000 // n)
                rares.append(rare)
                prefixes.append(_as_long(found[order]))
                parts.append(_part_counts(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(loose, pa.int64()), pa.array(rares, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(parts, pa.binary()), batch.column(2)],
                ["doc_id", "sid", "n", "loose", "rare", "prefix", "parts", "mark"])
    return run


def _part_counts(found: np.ndarray) -> bytes:
    """Shingles in each part of the hash space, a byte each; nothing if a part holds more than a byte can say."""
    bits = max(0, (len(found) // PART_SHINGLES).bit_length() - 1)
    place = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), dtype=np.int64)
    counts = np.bincount(place, minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _least_difference(left: bytes, right: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their part counts."""
    if not left or not right:
        return 0
    short, long = sorted((np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)), key=len)
    return int(np.abs(long.astype(np.int64).reshape(len(short), -1).sum(axis=1) - short).sum())


def _digest(found: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_64_digest(found.tobytes())


def profiles(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, sid, n, loose, rare, prefix, parts, mark): sid names the shingle set, null for an empty one, mark the text."""
    keep = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _mark(F.col("text")).alias("mark"))
    return materialise(rows.mapInArrow(
        _profiler(keep, percent), "doc_id long, sid long, n long, loose long, rare long, prefix array<long>, "
                                  "parts binary, mark string"), "profiles")


def _buckets(profile: DataFrame) -> DataFrame:
    """Prefix rows of tokens that more than one class may share, each with its bucket's leader."""
    rows = (profile.where("prefix is not null")
            .select("sid", "n", "loose", "rare", F.posexplode("prefix").alias("pos", "token"))
            .withColumn("salt", F.when(F.col("pos") >= F.col("rare"), F.pmod("sid", F.lit(SALTS))).otherwise(-1)))
    within = Window.partitionBy("token", "salt").orderBy("loose", "sid")
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = rows.withColumns({
        "leader": F.first("sid").over(whole), "leader_n": F.first("n").over(whole),
        "leader_pos": F.first("pos").over(whole), "last": F.last("sid").over(whole),
        "before": F.lag("sid").over(within)})  # tasks may send one class's prefix each: the copies are neighbours
    return materialise(marked.where("salt >= 0 or leader <> last").where("before is null or before <> sid")
                       .select("token", "salt", "sid", "n", "pos", "loose", "leader", "leader_n", "leader_pos"),
                       "buckets")


def _may_link(n1, p1, n2, p2, percent: int):
    """Length and positional filter on a shared token at positions p1 and p2 (from 0)."""
    n1, p1, n2, p2 = F.col(n1), F.col(p1), F.col(n2), F.col(p2)
    length = F.lit(100) * F.least(n1, n2) >= F.lit(percent) * F.greatest(n1, n2)
    most = F.least(n1 - p1, n2 - p2)
    return length & (most * (100 + percent) >= F.lit(percent) * (n1 + n2))


def _star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a: leader, b: member). Leaders have fewer rare shingles everywhere, so no pair comes both ways round."""
    near = (buckets.where("sid <> leader").where(_may_link("n", "pos", "leader_n", "leader_pos", percent))
            .select(F.col("leader").alias("a"), F.col("sid").alias("b")))
    heads = buckets.where("salt >= 0 and sid = leader")
    best = heads.groupBy("token").agg(F.min_by(F.struct("sid", "n", "pos"), F.struct("loose", "sid")).alias("top"))
    between = (heads.join(best, "token")
               .select("sid", "n", "pos", F.col("top.sid").alias("other"), F.col("top.n").alias("other_n"),
                       F.col("top.pos").alias("other_pos"))
               .where("sid <> other").where(_may_link("n", "pos", "other_n", "other_pos", percent))
               .select(F.col("other").alias("a"), F.col("sid").alias("b")))
    return near.unionByName(between).distinct()


def _open_rows(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows, with their component, of tokens whose classes are in several."""
    rows = (rows.select("token", "sid", "n", "pos", "loose").join(_small(groups), F.col("sid") == F.col("node"), "left")
            .select("token", "sid", "n", "pos", "loose", F.coalesce("component", "sid").alias("grp")))
    return materialise(rows.join(_small(materialise(_mixed(rows), "mixed")), "token"), "open")


def _mixed(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
            .where("low <> high").select("token"))


def _still_open(open_rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The open rows after components grew, and those of them whose token holds a class that changed its component.

    A component is named by its smallest class, so a token without such a change has the centre and the pairs it had before.
    """
    now = materialise(open_rows.withColumnRenamed("grp", "was").join(_small(groups), F.col("sid") == F.col("node"), "left")
                      .select("token", "sid", "n", "pos", "loose", "was", F.coalesce("component", "sid").alias("grp")), "regrouped")
    moved = materialise(now.where("grp <> was").select("token").distinct(), "moved")
    now = now.drop("was")
    changed = now.join(_small(moved), "token")
    still = materialise(_mixed(changed), "mixed")
    shut = materialise(moved.join(still, "token", "left_anti"), "shut")
    return now.join(_small(shut), "token", "left_anti"), materialise(changed.join(_small(still), "token"), "changed")


def _centre_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): a stands for the largest component among a token's classes, b is a class outside of it."""
    within = open_rows.groupBy("token", "grp").agg(
        F.count("*").alias("size"), F.min_by(F.struct("sid", "n", "pos"), F.struct("loose", "sid")).alias("head"))
    best = materialise(within.groupBy("token").agg(F.max_by(F.struct("grp", "head"), F.struct("size", "grp")).alias("top")), "centres")
    return (open_rows.join(best, "token").where("grp <> top.grp")
            .select("sid", "n", "pos", F.col("top.head.sid").alias("a"), F.col("top.head.n").alias("a_n"),
                    F.col("top.head.pos").alias("a_pos"))
            .where(_may_link("n", "pos", "a_n", "a_pos", percent)).select("a", F.col("sid").alias("b")).distinct())


def _cross_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    x = open_rows.select("token", F.col("sid").alias("a"), F.col("n").alias("n1"), F.col("pos").alias("p1"),
                         F.col("grp").alias("g1"))
    y = open_rows.select("token", F.col("sid").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("p2"),
                         F.col("grp").alias("g2"))
    return (x.join(y, "token").where("a < b and g1 <> g2").where(_may_link("n1", "p1", "n2", "p2", percent))
            .select("a", "b").distinct())


def _suffix_filter(percent: int):
    """Drop pairs whose counts in the parts of the hash space already differ too much."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = np.array([_least_difference(x.as_py(), y.as_py())
                              for x, y in zip(batch.column(4), batch.column(5))], dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            # overlap >= percent*total/(100+percent)  <=>  difference <= total*(100-percent)/(100+percent)
            keep = apart * (100 + percent) <= total * (100 - percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)),
                                              batch.column(1).filter(pa.array(keep))], ["a", "b"])
    return run


def _sets(batches):
    """(sid, other, items) of texts whose set is the class ``sid``."""
    release()
    for batch in batches:
        sids, others, found = [], [], []
        wanted, beside = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for row, words, _, _ in batch_words(batch.column(0)):
            own = shingle_set(words, SHINGLE)
            if len(own) and int.from_bytes(_digest(own), "little", signed=True) == wanted[row]:
                sids.append(wanted[row])
                others.append(beside[row])
                found.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(others, pa.int64()),
                                          pa.array(found, pa.binary())], ["sid", "other", "items"])


def _verifier(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(a, keep) if k], pa.int64()),
                 pa.array([v for v, k in zip(b, keep) if k], pa.int64())], ["a", "b"])
    return run


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the suffix filter and then hold on whole sets."""
    side = classes.select("sid", "n", "parts")
    left = side.select(F.col("sid").alias("a"), F.col("n").alias("n1"), F.col("parts").alias("c1"))
    right = side.select(F.col("sid").alias("b"), F.col("n").alias("n2"), F.col("parts").alias("c2"))
    pairs = _small(materialise(pairs, "pairs"))
    rest = materialise(pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "n2", "c1", "c2")
                       .mapInArrow(_suffix_filter(percent), "a long, b long"), "candidates")
    # sets are made anew from the texts where these are read: one is shuffled per pair, and one per leader
    places = classes.select("sid", F.col("first_id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")

    def sets(wanted: DataFrame) -> DataFrame:
        near = _small(materialise(wanted.join(places, "sid").select("doc_id", "sid", "other"), "wanted"))
        return texts.join(near, "doc_id").select("text", "sid", "other").mapInArrow(
            _sets, "sid long, other long, items binary")

    leaders = sets(rest.select(F.col("a").alias("sid"), F.col("a").alias("other")).distinct())
    members = sets(rest.select(F.col("b").alias("sid"), F.col("a").alias("other")))
    x = leaders.select(F.col("sid").alias("a"), F.col("items").alias("x"))
    y = members.select(F.col("other").alias("a"), F.col("sid").alias("b"), F.col("items").alias("y"))
    return materialise(y.join(x, "a").select("a", "b", "x", "y")
                       .mapInArrow(_verifier(percent), "a long, b long").distinct(), "links")


def _linked(buckets: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all classes that have a link."""
    links = _verified(_star_pairs(buckets, percent), classes, docs, percent)
    groups = materialise(connected_components(links), "groups")
    open_rows = changed = _open_rows(buckets, groups)
    tried = None
    while True:
        pairs = materialise(_centre_pairs(changed, percent), "centre-pairs")
        fresh = pairs if tried is None else materialise(pairs.join(tried, ["a", "b"], "left_anti"), "fresh-pairs")
        found = _verified(fresh, classes, docs, percent) if not fresh.isEmpty() else None
        if found is None or found.isEmpty():
            break
        links = links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(fresh)
        groups = materialise(connected_components(links), "groups")
        open_rows, changed = _still_open(open_rows, groups)
    cross = _verified(_cross_pairs(open_rows, percent), classes, docs, percent)
    return groups if cross.isEmpty() else materialise(connected_components(links.unionByName(cross)), "groups")


def _grouped(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The profiles of ``docs`` and, for each class, sid, n_class, component_id and stays: the class of its first document."""
    small_batches(docs.sparkSession)
    profile = profiles(docs, percent)
    has_id = profile.where("doc_id is not null and sid is not null")
    classes = materialise(has_id.groupBy("sid").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_class"), F.max("n").alias("n"),
        F.max("parts").alias("parts")), "classes")
    groups = _linked(_buckets(profile), classes, docs, percent)
    # only classes with a link have to look their group up; the others are groups of their own
    linked = classes.join(_small(groups), F.col("sid") == F.col("node")).select("sid", "first_id", "component")
    first = materialise(linked.groupBy("component").agg(F.min(F.struct("first_id", "sid")).alias("first")), "first")
    named = materialise(linked.join(_small(first), "component").select(
        "sid", F.col("first.first_id").alias("component_id"), F.col("first.sid").alias("stays")), "named")
    return profile, classes.select("sid", "first_id", "n_class").join(_small(named), "sid", "left").select(
        "sid", "n_class", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("stays", "sid").alias("stays"))


def similar_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_class for every row of ``docs`` (doc_id, text; others are ignored).

    component_id is the smallest doc_id reachable over links of at least ``percent`` similarity, n_class the number of
    rows with the very same set. A null or wordless text has no shingle and is linked with nothing; a row without
    doc_id has a null component_id and links nothing. Rows that repeat a doc_id are judged each by its own text.
    """
    profile, named = _grouped(docs, percent)
    return profile.select("doc_id", "sid", F.col("n").alias("n_shingles")).join(named, "sid", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(F.col("sid").isNotNull() & F.col("doc_id").isNotNull(), F.col("n_class")).alias("n_class"))


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of similar texts, with the columns of ``docs``.

    The row with the smallest doc_id stays; of rows that share this id the class that sorts first, and of these the text
    that does. Each row is judged by its doc_id and text together, so a row is never lost for what another row of its id
    holds, and of wholly repeated rows one stays. Rows without doc_id or without a word are in no group and stay.
    """
    profile, named = _grouped(docs, percent)
    grouped = (profile.where("doc_id is not null and sid is not null").select("doc_id", "sid", "mark")
               .join(named.select("sid", "component_id", "stays"), "sid"))
    heads = materialise(grouped.where("doc_id = component_id and sid = stays").groupBy("doc_id", "sid").agg(
        F.min("mark").alias("mark"), F.count("*").alias("n")), "heads")
    kept = heads.select("doc_id", F.col("mark").alias("kept_mark")).distinct()
    gone = materialise(grouped.select("doc_id", "mark").distinct().join(
        kept, (grouped["doc_id"] == kept["doc_id"]) & (F.col("mark") == F.col("kept_mark")), "left_anti"), "gone")
    again = materialise(heads.where("n > 1").select("doc_id", "mark"), "again")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _mark(F.col("text")).alias("mark"))
    rows = rows.join(_small(gone), ["doc_id", "mark"], "left_anti")
    single = rows.join(_small(again), ["doc_id", "mark"], "left_anti")
    double = rows.join(_small(again), ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    return single.unionByName(double).select("row.*")


def _mark(text: Column) -> Column:
    """128 bits that stand for a text, null included."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(F.hex(F.xxhash64(text)), F.lit("-"), F.hex(F.xxhash64(F.lit("second"), text)))


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
