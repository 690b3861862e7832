"""BPE by dynamic programming over prefixes.

The encoding of every prefix of a word ends in exactly one token. For each prefix the automaton over the vocabulary gives
the tokens that end there, longest first; the one that is compatible with the last token of the prefix before it is
stored. Following these back from the end of the word gives the ids that merging pair by pair would give.

Two neighbouring tokens are compatible if merging would never have joined symbols across their border: undo the merges
of both sides, latest first, and see whether the pair at the border could have merged before the undone merge.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.memo import per_process, slices, small_batches

CACHED_CHUNKS = 150_000
CACHED_PAIRS = 400_000
#: White space of the vocabulary's own patterns; str.split() takes these and the four separators below.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder for a vocabulary of words with end marks (lower case, no white space)."""

    def __init__(self, spec: dict):
        import ahocorasick
        import regex
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        self.text = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        merges = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        #: merge of two ids -> (its rank, id made); id -> (rank of its merge, left, right), rank -1 for a single symbol
        self.joins: dict[tuple[int, int], int] = {}
        self.made = {i: (-1, i, i) for i in vocab.values()}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.joins.setdefault((left, right), rank)
            if self.made[whole][0] < 0:
                self.made[whole] = (rank, left, right)
        symbols = byte_symbols()
        self.inner = {b: s for b, s in symbols.items()}
        self.final = {chr(b): chr(ord(s) + 0x1000) for b, s in symbols.items()}
        # one character per symbol, the marked last symbol of a word 0x1000 higher
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            marked = token.endswith(self.end) and token != self.end
            core = token[:-len(self.end)] if marked else token
            key = core[:-1] + chr(ord(core[-1]) + 0x1000) if marked else core
            self.automaton.add_word(key, (len(key), i))
        self.automaton.make_automaton()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", _SPACES)).findall
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.spaces = re.compile(f"[{_SPACES}]+").split
        self.checked: dict[tuple[int, int], bool] = {}
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.known_pieces: dict[str, tuple[bytes, str]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` side by side are how their joint text is encoded."""
        known = self.checked.get((left, right))
        if known is not None:
            return known
        a, b = left, right
        before = len(self.made) + 1  # a merge across the border at a rank below this would have come first
        verdict = None
        while verdict is None:
            rank = self.joins.get((a, b))
            if rank is not None and rank < before:
                verdict = False
                break
            rank_a, rank_b = self.made[a][0], self.made[b][0]
            if rank_a < 0 and rank_b < 0:
                verdict = True
            elif rank_a > rank_b:
                # within a, joining its halves came at rank_a; the border pair wins only if strictly earlier
                before, a = rank_a, self.made[a][2]
            else:
                # the border pair lies left of b's own merge, so it also wins at the same rank
                before, b = rank_b + 1, self.made[b][1]
        if len(self.checked) >= CACHED_PAIRS:
            self.checked.clear()
        self.checked[left, right] = verdict
        return verdict

    def word_ids(self, piece: str) -> list[int]:
        """Ids of one piece of the split text."""
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        body = data[:-1].translate(self.inner) + self.final[data[-1]]
        n = len(body)
        last = [-1] * (n + 1)
        start_of = [0] * (n + 1)
        known, compatible = self.checked.get, self.compatible
        for at, (size, token) in self.automaton.iter(body):
            end = at + 1
            if last[end] < 0:
                start = end - size
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    verdict = known((before, token))
                    if verdict is None:
                        verdict = compatible(before, token)
                    if not verdict:
                        continue
                last[end], start_of[end] = token, start
        out = []
        while n:
            out.append(last[n])
            n = start_of[n]
        out.reverse()
        return out

    def _piece(self, piece: str) -> tuple[bytes, str]:
        found = self.known_pieces.get(piece)
        if found is None:
            ids = self.word_ids(piece)
            found = array("I", ids).tobytes(), " ".join([self.text[i] for i in ids])
            if len(piece) <= 64:
                if len(self.known_pieces) >= CACHED_CHUNKS:
                    self.known_pieces.clear()
                self.known_pieces[piece] = found
        return found

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        if not text.isascii():
            # characters are put into lower case one by one, so a final capital sigma has no form of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        lower = text.lower()
        if lower.isalpha():
            return [self._piece(lower)]
        if lower[-1:] in (",", ".") and lower[:-1].isalpha():
            return [self._piece(lower[:-1]), self._piece(lower[-1])]
        return [self._piece(piece) for piece in self.pieces(lower)]

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids and decoded text of a run without white space."""
        if self.split_special and any(map(chunk.__contains__, self.special)):
            parts = []
            for k, part in enumerate(self.split_special(chunk)):
                parts += [(array("I", [self.special[part]]).tobytes(), part)] if k % 2 else self._plain(part)
        else:
            parts = self._plain(chunk)
        found = parts[0] if len(parts) == 1 else (
            b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHED_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        text = text or ""
        if _SEPARATORS.search(text):
            chunks = [c for c in self.spaces(text) if c]
        else:
            chunks = text.split()
        get, make = self.chunks.get, self._chunk
        parts = [get(c) or make(c) for c in chunks]
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]])

    def decode(self, ids) -> str:
        return " ".join([self.text[i] for i in ids])


def _tokenizer(content: str) -> WordBpe:
    return per_process("word_bpe", hashlib.sha256(content.encode()).digest(), lambda: WordBpe(json.loads(content)))


def _encoder(shared, with_ids: bool):
    def run(batches):
        encode = _tokenizer(shared.value).encode
        for batch in slices(batches):
            counts, ids, shas, decoded = [], [], [], []
            for text in batch.columns[-1].to_pylist():
                own, back = encode(text)
                counts.append(len(own) // 4)
                shas.append(hashlib.sha256(own).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    ids.append(own)
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
                       pa.array(decoded, pa.string())]
            names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_documents(docs: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids as little-endian 32-bit integers) for each row of ``docs``.

    A null or empty text has no ids. The vocabulary file is read on the driver and sent once to each executor.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoder(shared, with_ids), schema)


def decode_ids(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, text for each row with ``ids``: tokens with their end marks, between single spaces."""
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        tokens = _tokenizer(shared.value)
        for batch in batches:
            texts = [tokens.decode(memoryview(b).cast("I")) if b is not None else None
                     for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
