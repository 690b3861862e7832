"""Toxicity by compression distance.

Two zstandard dictionaries are made separately: one of the words and stems that toxic text uses far more often per word,
one of the commonest ordinary ones. A word is coded in a fixed carrier (repeated, so that the coder doesn't store it raw)
under both; how often a saving of so many bytes on a word of such a length occurs in either class of the fit sample
calibrates the evidence. Each text is judged by the window of WINDOW words that holds most evidence in different words,
less the log of its number of windows, so that chance hits of long texts don't add up. This is calibrated to a probability.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from creditloom.llm.memo import per_process, release, slices, small_batches
from creditloom.llm.sampling import crc32_fold, sampled
from creditloom.session import materialise

#: Labelled texts per class that the model is fitted on; they are read whole.
FIT_TEXTS = 2_000
DICTIONARY_BYTES = 32_768
#: Letters of the stems tried as dictionary entries; longer words count with their first LONGEST letters.
STEM, SHORTEST, LONGEST = (4, 12), 3, 24
#: A toxic entry is so many times as frequent per word as in ordinary text, in LEAST_TEXTS texts at least, and the log
#: of the ratio times its texts reaches SURE. Of nested stems the longest with this share of the uses stays.
CONTRAST, LEAST_TEXTS, SURE, SAME = 6.0, 3, 12.0, 0.8
ENTRIES = 8_000
ORDINARY = 400
WINDOW = 200
LEVEL = 6
#: A cell counts as evidence if toxic text has it so many times as often, on LEAST_USES words at least.
LEAST_RATIO, LEAST_USES = 4.0, 3
CACHED_WORDS = 150_000
#: Different entries counted in a task before they are passed on.
COUNTED = 200_000
REJECT = 0.7
_PUNCTUATION = {ord(c): " " for c in ".,;:!?\"'()[]{}<>*#$%&|/\\=+~^`_"}
_CARRIER, _END = 4, b" ~~~~~~~~~~~ ;"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().translate(_PUNCTUATION).split()


def _blocks(words: list[str]) -> list[set[str]]:
    """The different words of each block of WINDOW words."""
    return [set(words[i:i + WINDOW]) for i in range(0, len(words), WINDOW)]


def _entries_of(word: str) -> set[str]:
    """A word and its stems."""
    if len(word) < SHORTEST:
        return set()
    return {word[:LONGEST]} | {word[:k] for k in range(STEM[0], min(len(word), STEM[1] + 1))}


def _count_entries(batches):
    """label, entry, uses, texts of parts of the sample; the entry "" counts all words and texts."""
    def flushed(uses, texts):
        keys = list(uses)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([uses[k] for k in keys], pa.int64()), pa.array([texts[k] for k in keys], pa.int64())],
            ["label", "entry", "uses", "texts"])
    release()
    uses, texts = Counter(), Counter()
    for batch in slices(batches):
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {""}
            uses[label, ""] += 0
            for block in _blocks(words_of(text)):
                uses[label, ""] += len(block)
                for word in block:
                    own = _entries_of(word)
                    seen |= own
                    for entry in own:
                        uses[label, entry] += 1
            for entry in seen:
                texts[label, entry] += 1
            if len(uses) >= COUNTED:
                yield flushed(uses, texts)
                uses, texts = Counter(), Counter()
    yield flushed(uses, texts)


def _stems(uses: dict[str, int]) -> list[str]:
    """The entries of ``uses`` without those that another stands for, the commonest last."""
    def prefixes(entry):
        return (entry[:k] for k in range(STEM[0], len(entry)))
    going_on = {p for e in uses for p in prefixes(e) if p in uses and uses[e] >= SAME * uses[p]}
    left = set(uses) - going_on
    return sorted((e for e in left if not any(p in left for p in prefixes(e))), key=lambda e: (uses[e], e))


def _dictionary(words: list[str], size: int) -> bytes:
    body = b"".join(b" " + w.encode() + b" " for w in words)[-size:]
    return b" " * (size - len(body)) + body + _END


class _Coder:
    """Bytes that the toxic dictionary saves against the ordinary one, for one word."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard

        def coder(content):
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False,
                                            write_checksum=False, write_dict_id=False).compress
        self.toxic, self.ordinary = coder(toxic), coder(ordinary)

    def cell(self, word: str) -> tuple[int, int]:
        own = word.encode()
        window = b" " + b" ".join([own] * _CARRIER) + b" "
        return min(len(own), 24), len(self.ordinary(window)) - len(self.toxic(window))


class _Evidence(dict):
    """Evidence of a word, coded when first met; the cache is emptied when full."""

    def __init__(self, coder: _Coder, weights: dict):
        super().__init__()
        self.coder, self.weights = coder, weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = self.weights.get(self.coder.cell(word), 0.0)
        return found


def text_evidence(words: list[str], evidence) -> float:
    """Most evidence of different words in one window, less the log of the number of windows; 0 at least.

    Windows start every half window.
    """
    half = WINDOW // 2
    count = len(range(0, max(1, len(words) - half), half))
    hits: dict[int, dict[str, float]] = {}
    for i, word in enumerate(words):
        if found := evidence(word):
            for k in (i // half - 1, i // half):
                if 0 <= k < count:
                    hits.setdefault(k, {})[word] = found
    best = max((sum(h.values()) for h in hits.values()), default=0.0)
    return max(0.0, best - math.log(count))


def _count_cells(shared):
    def run(batches):
        release()
        coder = _Coder(*shared.value)
        found: Counter = Counter()
        known: dict[str, tuple[int, int]] = {}
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in (w for block in _blocks(words_of(text)) for w in block):
                    if word not in known:
                        if len(known) >= CACHED_WORDS:
                            known.clear()
                        known[word] = coder.cell(word)
                    found[(label, *known[word])] += 1
        columns = list(zip(*((*k, n) for k, n in found.items()))) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            ["label", "size", "saved", "uses"])
    return run


def _weigh(shared):
    def run(batches):
        release()
        toxic, ordinary, weights = shared.value
        evidence = _Evidence(_Coder(toxic, ordinary), weights).__getitem__
        for batch in slices(batches):
            found = [text_evidence(words_of(t), evidence) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["label", "evidence"])
    return run


def _rising(pairs: list[tuple[float, int]], prior: float) -> list[tuple[float, float]]:
    """Steps (evidence from, probability), pooled so that they never fall; each pool leans on one prior case."""
    pools: list[list[float]] = []
    for x, y in sorted(pairs):
        if pools and pools[-1][0] == x:
            pools[-1][1] += y
            pools[-1][2] += 1
        else:
            pools.append([x, y, 1])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, y1, n1 = pools.pop()
            pools[-1][1] += y1
            pools[-1][2] += n1
    best, steps = 0.0, []
    for x, y, n in pools:
        best = max(best, (y + prior) / (n + 1))
        steps.append((x, best))
    return steps


def fit(sample: DataFrame) -> dict | None:
    """Model from label ("0" or "1") and text; None if one class is missing.

    Whole texts are reduced to counts in tasks; only the entries kept, the cells and one number a text come to the driver.
    """
    context = sample.sparkSession.sparkContext
    sample = sample.select("label", "text")
    toxic, plain = F.col("label") == "1", F.col("label") == "0"
    counts = materialise(
        sample.mapInArrow(_count_entries, "label string, entry string, uses long, texts long").groupBy("entry").agg(
            *[F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0)).alias(n) for n, v, c in
              (("own", "uses", toxic), ("other", "uses", plain), ("texts", "texts", toxic), ("plain_texts", "texts", plain))]),
        "toxic-entries")
    total = counts.where("entry = ''").first()
    if not total or not total.texts or not total.plain_texts:
        return None
    words = {"1": max(1, total.own), "0": max(1, total.other)}
    log_ratio = F.log((F.col("own") / words["1"]) / ((F.col("other") + 0.5) / words["0"]))
    sure = F.col("texts") * log_ratio
    chosen = (counts.where((F.col("entry") != "") & (F.col("texts") >= LEAST_TEXTS) & (log_ratio > math.log(CONTRAST))
                           & (sure > SURE)).orderBy(sure.desc(), "entry").limit(ENTRIES).collect())
    stems = _stems({r.entry: r.own for r in chosen})
    common = counts.where("entry != '' and other > 0").orderBy(F.desc("other"), "entry").limit(ORDINARY + ENTRIES)
    kept = set(stems)
    ordinary = [r.entry for r in common.select("entry").collect()
                if not any(r.entry[:k] in kept for k in range(1, len(r.entry) + 1))][:ORDINARY][::-1]
    size = min(DICTIONARY_BYTES, max(8, sum(len(w.encode()) + 2 for w in stems)))
    pair = (_dictionary(stems, size), _dictionary(ordinary, size))
    cells = (sample.mapInArrow(_count_cells(context.broadcast(pair)), "label string, size long, saved long, uses long")
             .groupBy("label", "size", "saved").agg(F.sum("uses").alias("uses")).collect())
    uses = {(r.label, r.size, r.saved): r.uses for r in cells}
    weights = {}
    for (label, *cell), n in uses.items():
        ratio = ((n + 0.5) / words["1"]) / ((uses.get(("0", *cell), 0) + 0.5) / words["0"])
        if label == "1" and n >= LEAST_USES and cell[1] > 0 and ratio > LEAST_RATIO:
            weights[tuple(cell)] = math.log(ratio)
    # at most FIT_TEXTS numbers a class
    found = sample.mapInArrow(_weigh(context.broadcast((*pair, weights))), "label string, evidence double").collect()
    prior = total.texts / (total.texts + total.plain_texts)
    return {"toxic": pair[0], "ordinary": pair[1], "weights": weights, "prior": prior,
            "steps": _rising([(round(r.evidence, 6), int(r.label)) for r in found], prior)}


def probability(model: dict, evidence: float) -> float:
    found = 0.0
    for start, p in model["steps"]:
        if evidence + 1e-6 < start:
            break
        found = p
    return found


def _scorer(shared, name: str = "score"):
    def run(batches):
        model = shared.value
        if model:
            evidence = per_process("toxicity", model, lambda: _Evidence(
                _Coder(model["toxic"], model["ordinary"]), model["weights"])).__getitem__
        for batch in slices(batches):
            scores = [probability(model, text_evidence(words_of(t), evidence)) if model else 0.0
                      for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], name])
    return run


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, fit_texts: int = FIT_TEXTS):
    """Model fitted on at most ``fit_texts`` texts a class outside the held-out fold."""
    learn = labels.where(crc32_fold("doc_id", folds) != held).where("toxic in (0, 1)").select(
        "doc_id", F.col("toxic").cast("string").alias("label"))
    return fit(materialise(sampled(docs, learn, fit_texts), "toxic-sample"))


def score(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, reject: float = REJECT) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    A null or empty text has no evidence and gets the lowest score. Without labels of both classes every score is 0.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels, folds, held))
    fold = crc32_fold("doc_id", folds)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold == held).alias("held_out"), "text")
            .mapInArrow(_scorer(shared), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= reject).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more; the columns stay."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels))
    schema = StructType([*docs.schema.fields, StructField("__score", DoubleType())])
    return (docs.select("*", F.col("text").alias("__text")).mapInArrow(_scorer(shared, "__score"), schema)
            .where(F.col("__score") < reject).select(*docs.columns))
