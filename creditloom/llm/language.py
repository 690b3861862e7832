"""Language of a text by compression.

Each language has one zstandard raw-content dictionary made of sample text. A text is cut into windows, every window is
coded with every dictionary, and the language with the smallest total wins. A narrow win is marked as not reliable.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.memo import per_process, slices, small_batches
from creditloom.llm.sampling import crc32_fold, sampled

#: Labelled texts per language that a dictionary is made from, and its bytes.
FIT_TEXTS = 200
DICTIONARY_BYTES = 65_536
WINDOW_BYTES = 512
#: Bytes that one text gives to a dictionary at most, from all over the text, so that no text fills it alone.
TEXT_BYTES = 16_384
LEVEL = 6
#: A window below this is repeated up to it, as the coder stores very short input raw.
SHORT_BYTES = 64
#: Bytes of lead that make odds of e to 1.
LEAD_BYTES = 6.0
#: A score below this is a narrow win.
RELIABLE = 0.9
UNKNOWN = "und"


_MARKS = {ord(c): " " for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"}


def _plain(text: str) -> str:
    return " ".join(text.lower().translate(_MARKS).split())


def _pieces(size: int):
    """Each sample text as plain text of at most ``size`` bytes: windows at equal distances over all of it."""
    def run(batches):
        for batch in slices(batches):
            found = []
            for text in batch.column(3).to_pylist():
                words = _plain(text)
                data = words.encode()
                count = size // WINDOW_BYTES
                if len(data) > size:
                    step = len(data) / count
                    data = b" ".join(data[int(i * step):int(i * step) + WINDOW_BYTES - 1] for i in range(count))
                found.append(data.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(found, pa.string())],
                                             ["label", "rank", "doc_id", "text"])
    return run


def learn(docs: DataFrame, labels: DataFrame, fit_texts: int, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries from whole texts; each comes to the driver as windows of at most TEXT_BYTES bytes."""
    rows = sampled(docs, labels, fit_texts).mapInArrow(
        _pieces(TEXT_BYTES), "label string, rank int, doc_id long, text string").collect()
    return dictionaries([(r.label, r.text) for r in sorted(rows, key=lambda r: (r.label, r.rank, r.text))], size)


def dictionaries(sample: list[tuple[str, str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Language -> dictionary content, the last ``size`` bytes of its sample texts in lower case."""
    texts: dict[str, list[str]] = {}
    for lang, text in sample:
        texts.setdefault(lang, []).append(_plain(text))
    return {lang: "\n".join(t).encode()[-size:] for lang, t in sorted(texts.items()) if sum(map(len, t)) >= 8}


def _coders(contents: dict[str, bytes]):
    import zstandard
    coders = {}
    for lang, content in contents.items():
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=LEVEL)
        coders[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False,
                                                write_checksum=False, write_dict_id=False)
    return coders


def code_lengths(text: str, coders) -> dict[str, int]:
    """Total coded bytes of the whole text under each dictionary."""
    data = _plain(text).encode()
    if len(data) < SHORT_BYTES:
        data = b" ".join([data] * -(-SHORT_BYTES // (len(data) + 1)))
    windows = [data[i:i + WINDOW_BYTES] for i in range(0, len(data), WINDOW_BYTES)]
    return {lang: sum(len(coder.compress(w)) for w in windows) for lang, coder in coders.items()}


def judge(text: str | None, coders) -> tuple[str, float, bool]:
    """(language, score, reliable); a text without letters is ``und`` with score 0."""
    if not text or not coders or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, False
    totals = code_lengths(text, coders)
    best = min(totals, key=lambda lang: (totals[lang], lang))
    score = 1.0 / sum(math.exp(-min(700.0, (n - totals[best]) / LEAD_BYTES)) for n in totals.values())
    return best, min(1.0, score), score >= RELIABLE


def _predictor(shared):
    def run(batches):
        contents = shared.value
        coders = per_process("language", contents, lambda: _coders(contents))
        for batch in slices(batches):
            found = [judge(text, coders) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "reliable"])
    return run


def identify(docs: DataFrame, folds: int = 5, held: int = 0, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, reliable for each row of ``docs`` (doc_id, text, lang).

    Dictionaries come from at most ``fit_texts`` texts a language outside the held-out fold. A null, empty or letterless
    text gives ``und`` with score 0, as does everything if no language can be learned. Ties go to the first name.
    """
    small_batches(docs.sparkSession)
    fold = crc32_fold("doc_id", folds)
    found = learn(docs, docs.where(fold != held).select("doc_id", F.col("lang").alias("label")), fit_texts)
    shared = docs.sparkSession.sparkContext.broadcast(found)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold == held).alias("held_out"), "text").mapInArrow(
        _predictor(shared), "doc_id long, held_out boolean, lang_pred string, score double, reliable boolean")
