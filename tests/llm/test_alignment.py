"""Cross-tokenizer alignment against a byte-by-byte brute force, and its counts against counters."""

import collections
import hashlib
import random

import public_tokenizers
import pytest

from creditloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = "doc_id long, text string, pairs string, n_a string, groups_sha256 string, head long"


def brute(rows, groups=False):
    import json

    import sentencepiece
    from tokenizers import Tokenizer
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    shift = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    free = iter(range(256, 512))
    shift |= {chr(next(free)): b for b in range(256) if b not in shift.values()}
    entries = {i: t for t, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
    docs = []
    for doc, text in rows:
        raw = b" " + (text or "").encode()
        a = [(i, bytes(shift[c] for c in entries[i])) for i in tok.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in sp.encode(text or "")]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append((doc, 0, 0, 0, [], ""))
            continue
        owner = [[], []]                      # for each byte the place of its token on either side
        for side, tokens in zip(owner, (a, b)):
            for k, (_, x) in enumerate(tokens):
                side += [k] * len(x)
        links = sorted(set(zip(*owner)))
        cuts = [k for k in range(1, len(raw)) if all(side[k] != side[k - 1] for side in owner)] + [len(raw)]
        shown, start = [], 0
        for cut in cuts:
            shown.append("|".join(",".join(str(t[k][0]) for k in sorted(set(side[start:cut])))
                                  for side, t in zip(owner, (a, b))))
            start = cut
        docs.append((doc, len(a), len(b), len(cuts), [(a[x][0], b[y][0]) for x, y in links], ";".join(shown)))
    holders = collections.Counter(p for d in docs for p in set(d[4]))
    top = collections.Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    return sorted([(doc, n_a, n_b, n, len(links), sum(holders[p] == top[p[0]] for p in links), sum(holders[p] for p in links),
                    shown if groups else hashlib.sha256(shown.encode()).hexdigest() if shown else "")
                   for doc, n_a, n_b, n, links, shown in docs], key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def result(spark, rows, last="groups_sha256", **how):
    table = spark.createDataFrame([(d, t, "p", "q", "r", 1) for d, t in rows], FIELDS)
    done = alignment.align_documents(table, A, B, **how)
    return sorted((tuple(r) for r in done.select(*COLUMNS, last).collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark, folder):
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    odd = ["", None, " ", "  two  spaces ", "a▁b", "<0x41> <s> </s> <|endoftext|>", "\x00\x01", "naïve café 東京 😀", "\n\t x",
           "é ﬁ ½", "x" * 5_000, " ".join(f"word{i % 90}" for i in range(20_000)), "tie tie tie", "the, and the; and"]
    rng = random.Random(8)
    marks = list("aéß東 😀▁1٣'\".,-\n\t\u00a0\u3000\u0301\u200d\x1c\x85") + ["  ", " ", " ", " the", "'s", " x ", "<s>", "\u180e", "ɐ", "ß", "ȿ", "÷", "\x7f"]
    odd += ["".join(rng.choices(marks, k=rng.randint(1, 30))) for _ in range(600)]
    return given + [(1_000 + i, t) for i, t in enumerate(odd)] + [(None, "no id"), (None, "no id"), (None, None),
                                                                  (1_012, "tie tie tie"), (1_012, "another text of that id")]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 300, 0])
def test_alignment_equals_brute_force(spark, rows, broadcast_pairs):
    assert result(spark, rows, broadcast_pairs=broadcast_pairs) == brute(rows)


def test_groups_are_returned_as_text(spark, rows):
    assert result(spark, rows[:80], "groups", with_groups=True) == brute(rows[:80], groups=True)


def test_forgotten_words_are_aligned_again(spark, rows, monkeypatch):
    own = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = [t for _, t in rows]

    def taken(found):
        return [f and (*f[:4], f[4].tolist()) for f in found]
    whole = taken(own.documents(texts))
    monkeypatch.setattr(alignment, "CACHED_WORDS", 50)
    monkeypatch.setattr(alignment, "CACHED_LENGTH", 3)
    assert [f for t in texts for f in taken(own.documents([t]))] == whole
    own.cut = False
    own.words.clear()
    assert taken(own.documents(texts)) == whole


def test_empty_table(spark):
    assert result(spark, []) == []
