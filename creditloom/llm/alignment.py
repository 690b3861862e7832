"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers cut the same bytes, so each token is an interval of bytes. All tokens of A and B are sorted by start; the
running maximum of their ends shows where a group breaks: at a start that reaches it, no earlier token goes on, so both
tokenizers end there. Inside a group the tokens whose bytes overlap are linked.

Neither tokenizer joins the end of a word with a single space behind it, so a group always breaks before that space. A text
is cut there, and what is aligned are its words with the space before them: all new words of some rows together, as
one run of bytes, and each word once as long as a task remembers it.

Texts are encoded once. The table written then has each text's figures and its different id pairs with their number; the
number of documents that hold a pair, and each A id's best pair, come from that table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.bpe import byte_symbols
from creditloom.llm.memo import per_process, slices, small_batches
from creditloom.session import materialise

#: Words that a task remembers with their alignment, and their greatest length.
CACHED_WORDS, CACHED_LENGTH = 300_000, 64
#: Fixed value: how byte-level vocabularies split a text into pieces.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class no version of Unicode changes: such words may take the faster encoder.
_PLAIN = re.compile(r"[\n -~À-ɏ]+").fullmatch
#: Single spaces inside a text: white space on neither side.
_SPACES = re.compile(r"(?<=\S) (?=\S)")
#: Pairs whose counts are sent to all tasks (17 bytes each, 36 MB); the counts of rarer pairs are joined.
BROADCAST_PAIRS = 1 << 21
BYTE_MARK = "▁"

FIELDS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<long>")


def _merged(entry: str, order: dict[tuple[str, str], int]) -> list[str]:
    """What the list of merges makes of the symbols of ``entry``."""
    parts = list(entry)
    while len(parts) > 1:
        rank, at = min((order.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the groups and links of a text."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(spec_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        back = {ord(s): b for b, s in byte_symbols().items()}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            known = all(ord(c) in back for c in entry)
            self.bytes_a[i] = bytes(back[ord(c)] for c in entry) if known else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BYTE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.width_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        ids = [str(i) for i in range(len(self.bytes_a))] + [str(i) for i in range(len(self.bytes_b))]
        #: every id as text behind each separator
        self.shown = [mark + i for mark in ";|," for i in ids]

        #: a piece with a space behind something else would join words
        self.cut = not any(BYTE_MARK in p.lstrip(BYTE_MARK) for i, p in enumerate(pieces) if not self.b.is_control(i))
        self.words: dict[str, tuple | None] = {}
        self.quick = self._by_ranks(json.loads(spec_a))

    def _by_ranks(self, spec: dict):
        """A faster encoder of plain words, if it is sure to give the same ids; else None.

        It joins two tokens whenever the bytes of both are an entry, the entry with the lowest id first, and the library
        only pairs in its list of merges, the first in the list first. If ids rise along the list and every entry is
        what the list makes of its own bytes, then whenever two tokens make an entry they are its pair in the list: up
        to there both have made the same of these bytes. How plain words are split doesn't depend on Unicode tables.
        """
        import tiktoken
        model = spec["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        made = [vocab[x + y] for x, y in merges]
        splitter = spec["pre_tokenizer"]
        if (made != sorted(made) or model.get("ignore_merges") or model.get("dropout") or spec["normalizer"] is not None
                or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True)):
            return None
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {self.bytes_a[i]: i for t, i in vocab.items() if t not in special}
        order = {(x, y): k for k, (x, y) in enumerate(merges)}
        if not all(_merged(x + y, order) == [x + y] for x, y in merges):
            return None
        return tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A and of B of each word, and whether both give back the bytes of the word behind a space."""
        quick = self.quick
        plain = [quick is not None and _PLAIN(w) is not None for w in words]
        rest = iter(self.a.encode_batch_fast([" " + w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        left = [quick(" " + w) if p else next(rest).ids for w, p in zip(words, plain)]
        right = self.b.encode(words, num_threads=1)
        same = [True] * len(words)
        raw = (" " + " ".join(words)).encode()
        for ids, entries, widths in ((left, self.bytes_a, self.width_a), (right, self.bytes_b, self.width_b)):
            # all at once: the same bytes in all, and as many in each word; only where that fails one by one
            ends = np.cumsum(widths[np.fromiter(chain.from_iterable(ids), dtype=np.int64)])[np.cumsum(list(map(len, ids))) - 1]
            if b"".join(map(entries.__getitem__, chain.from_iterable(ids))) != raw or not np.array_equal(
                    ends, np.cumsum([len(w.encode()) + 1 for w in words])):
                same = [s and b"".join(map(entries.__getitem__, i)) == b" " + w.encode() for s, i, w in zip(same, ids, words)]
        return left, right, same

    def groups(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, group) of all tokens, those of A before those of B, sorted by group, then side, then place."""
        width = np.concatenate([self.width_a[left], self.width_b[right]])
        ends = np.concatenate([np.cumsum(width[:len(left)]), np.cumsum(width[len(left):])])
        side = np.repeat([0, 1], [len(left), len(right)])
        order = np.lexsort((side, ends - width))
        reach = np.maximum.accumulate(ends[order])
        group = np.zeros(len(order), dtype=np.int64)
        np.cumsum((ends - width)[order][1:] >= reach[:-1], out=group[1:])
        by_side = np.lexsort((side[order], group))
        return order[by_side], group[by_side]

    def links(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in A and place in B of every pair of tokens whose bytes overlap, by place in A."""
        ends_a, ends_b = np.cumsum(self.width_a[left]), np.cumsum(self.width_b[right])
        first = np.searchsorted(ends_b, ends_a - self.width_a[left], "right")
        size = np.searchsorted(ends_b - self.width_b[right], ends_a, "left") - first
        start = np.cumsum(size) - size
        return np.repeat(np.arange(len(left)), size), np.arange(size.sum()) - np.repeat(start - first, size)

    def align(self, words: list[str]) -> list[tuple[int, str, bytes] | None]:
        """(tokens of A, groups as text, linked id pairs) of each word; None where the bytes differ."""
        out: list[tuple | None] = [None] * len(words)
        if not words:
            return out
        left_ids, right_ids, same = self.encode(words)
        known = [k for k, s in enumerate(same) if s]
        n_a, n_b = ([len(ids[k]) for k in known] for ids in (left_ids, right_ids))
        left, right = (np.fromiter(chain.from_iterable(ids[k] for k in known), dtype=np.int64) for ids in (left_ids, right_ids))
        order, group = self.groups(left, right)
        shown = self.written(np.concatenate([left, right])[order], (order >= len(left)).astype(np.int64), group)
        a, b = self.links(left, right)
        pairs = (left[a] * len(self.bytes_b) + right[b]).tobytes()
        # groups and links lie word after word
        ends = np.cumsum(np.array(n_a, dtype=np.int64) + np.array(n_b, dtype=np.int64)).tolist()
        link_ends = (8 * np.searchsorted(a, np.cumsum(n_a, dtype=np.int64), "left")).tolist()
        start = link_start = 0
        for k, n, end, link_end in zip(known, n_a, ends, link_ends):
            out[k] = n, "".join(shown[start:end])[1:], pairs[link_start:link_end]
            start, link_start = end, link_end
        return out

    def documents(self, texts: list[str | None]):
        """(tokens of A, of B, groups, groups as text, linked id pairs) of each text, from its words; None without tokens."""
        cut = [_SPACES.split(t) if t and self.cut else [t] if t else [] for t in texts]
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        new = list(set().union(*cut).difference(self.words))
        self.words.update(zip(new, self.align(new)))
        known = self.words.__getitem__
        for words in cut:
            parts = list(map(known, words))
            if not parts or None in parts:
                yield None
                continue
            n_a, shown, pairs = zip(*parts)
            left, text = sum(n_a), ";".join(shown)
            groups = text.count(";") + 1  # each holds one bar, and a comma between any two tokens of a side
            yield left, text.count(",") + 2 * groups - left, groups, text, np.frombuffer(b"".join(pairs), dtype=np.int64)
        for word in new:
            if len(word) > CACHED_LENGTH:
                del self.words[word]

    def written(self, token: np.ndarray, side: np.ndarray, group: np.ndarray) -> list[str]:
        """Each token as text behind its separator, as in ``;a1,a2|b1;a3|b2,b3``."""
        mark = np.full(len(token), 2)
        mark[1:][side[1:] != side[:-1]] = 1
        mark[1:][group[1:] != group[:-1]] = 0
        mark[:1] = 0
        ids = len(self.bytes_a) + len(self.bytes_b)
        codes = mark * ids + side * len(self.bytes_a) + token
        return list(map(self.shown.__getitem__, codes.tolist()))


def _aligner(shared) -> Aligner:
    spec, model = shared.value
    key = hashlib.sha256(spec.encode() + model).digest()
    return per_process("aligner", key, lambda: Aligner(spec, model))


def _align(shared, with_groups: bool):
    def run(batches):
        own = _aligner(shared)
        nothing = (0, 0, 0, 0, "", [], []) + (("",) if with_groups else ())
        for batch in slices(batches):
            rows = []
            for found in own.documents(batch.column(1).to_pylist()):
                if found is None:
                    rows.append(nothing)
                    continue
                *counts, text, pairs = found
                rows.append((*counts, len(pairs), hashlib.sha256(text.encode()).hexdigest(), *np.unique(pairs, return_counts=True))
                            + ((text,) if with_groups else ()))
            columns = list(zip(*rows)) or [()] * len(nothing)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())] + [pa.string()] * with_groups
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"] + ["groups"] * with_groups
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names)
    return run


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times (and groups) for each row of ``docs``.

    A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model; both are read on the driver and sent
    once to each executor. ``pairs`` are the different linked ids (A id x size of B + B id), ``times`` how often each is
    linked. A null or empty text, or one that either tokenizer doesn't give back byte for byte, has no tokens.
    """
    small_batches(docs.sparkSession)
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _align(shared, with_groups), FIELDS + ", groups string" * with_groups)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, documents (rows of ``aligned`` that hold it) and best: whether no pair of its A id has more."""
    counts = materialise(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")),
                         "pairs").withColumn("a", F.expr(f"pair div {int(size_b)}"))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # one row for each entry of A's vocabulary at most
    return counts.join(F.broadcast(most), "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _count(shared):
    """Sums over a row's links of the counts sent along; pairs that aren't among them go on."""
    def run(batches):
        keys, documents, best = shared.value
        for batch in batches:
            *head, pairs, times = batch.columns
            size = pc.list_value_length(pairs).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            pairs, times = (pc.list_flatten(c).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
                            for c in (pairs, times))
            at = np.searchsorted(keys, pairs)
            at[at == len(keys)] = 0
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)

            def sums(value):
                return pa.array(np.diff(np.concatenate([[0], np.cumsum(value, dtype=np.int64)])[cuts]))

            there = np.flatnonzero(known)
            counted = np.zeros((2, len(pairs)), dtype=np.int64)
            counted[:, there] = times[there] * np.stack([best[at[there]], documents[at[there]]])
            left = pa.array(np.concatenate([[0], np.cumsum(~known)])[cuts].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*head, sums(counted[0]), sums(counted[1]), pa.ListArray.from_arrays(left, pa.array(pairs[~known])),
                 pa.ListArray.from_arrays(left, pa.array(times[~known]))],
                [*batch.schema.names[:-2], "n_best", "count_sum", "pairs", "times"])
    return run


def _least_documents(counts: DataFrame, limit: int) -> int:
    """The smallest power of two such that at most ``limit`` pairs are in so many documents; 1 if all pairs are few enough."""
    power = F.floor(F.log2(F.col("documents"))).alias("power")
    total, least = 0, 1 << 62
    for power, n in sorted((tuple(r) for r in counts.groupBy(power).count().collect()), reverse=True):
        total += n
        if total > limit:
            return least
        least = 1 << power
    return 1


def count_links(aligned: DataFrame, size_b: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum.

    n_best counts the links whose pair has its A id's highest count, count_sum adds up the counts of all links. The counts
    of the most frequent pairs go to all tasks, those of the others are joined: none of them is in many documents.
    """
    counts = materialise(pair_counts(aligned, size_b), "counts")
    least = _least_documents(counts, broadcast_pairs)
    sent = counts.where(F.col("documents") >= least).toPandas().sort_values("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(
        tuple(sent[c].to_numpy(np.int64) for c in ("pair", "documents", "best")))
    head = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in head]
                       + ["n_best long", "count_sum long", "pairs array<long>", "times array<long>"])
    counted = aligned.select(*[f.name for f in head], "pairs", "times").mapInArrow(_count(shared), schema)
    if least == 1:
        return counted.drop("pairs", "times")
    counted = materialise(counted, "counted")
    # rows with the same doc_id and groups have the same links, so they are added up once
    far = (counted.where("size(pairs) > 0").dropDuplicates(["doc_id", "groups_sha256"])
           .select(F.col("doc_id").alias("doc"), F.col("groups_sha256").alias("sha"),
                   F.explode(F.arrays_zip("pairs", "times")).alias("link"))
           .select("doc", "sha", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
           .join(counts.where(F.col("documents") < least), "pair").groupBy("doc", "sha")
           .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
                F.sum(F.col("times") * F.col("documents")).alias("more_sum")))
    return counted.join(far, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("groups_sha256") == F.col("sha")), "left").select(
        *[f.name for f in head], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False,
                    broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Alignment of each row of ``docs`` and how common its links are in all of them.

    doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (and groups), n_best, count_sum. Each row is a document of its own,
    repeated ones and those without doc_id too; other columns are ignored. Rows without tokens have zeros and empty texts.
    """
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return count_links(materialise(align(docs, path_a, path_b, with_groups), "aligned"), size_b, broadcast_pairs)
