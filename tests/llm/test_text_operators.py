"""Text operators against brute force, exact round trips, held-out accuracy and awkward tables."""

import collections
import hashlib
import json
import re
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import bpe, chat, hashing, jaccard, language, lengths, outliers, pii, seeds, toxicity, urls
from creditloom.llm.components import connected_components

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, n long"
WORDS = re.compile("[^ \t-\r]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, clashing column names."""
    long_text = " ".join(f"word{i % 900}" for i in range(60_000))
    rows = [(1, None, None, None, None, 1.0, 1), (2, "", "en", None, 0, None, 2), (3, " \n\t ", None, "s", 4, 2.0, 3),
            (4, long_text, "en", "s", len(long_text), 2.0, 4), (5, long_text, "en", "s", 1, 2.0, 4),
            (6, "one", "en", "s", 3, 0.0, 5), (6, "one", "en", "s", 3, 0.0, 5), (None, "a b c d e f g", "de", "t", 1, 0.0, 6),
            (8, "é😀 A@b.co +49 30 1234567", "fr", "t", 1, 0.0, 7)]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


def small(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- hashing

@given(st.lists(st.text("aB \t\né", max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_hashes_follow_words(texts):
    import pyarrow as pa
    seen = {}
    for row, words, starts, ends in hashing.batch_words(pa.array(texts)):
        expected = WORDS.findall(lower(texts[row]))
        assert len(words) == len(expected)
        raw = texts[row].encode()
        assert [lower(raw[a:b].decode()) for a, b in zip(starts, ends)] == expected
        for h, w in zip(words.tolist(), expected):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# --- op10

def brute_groups(rows, percent=80):
    sets = {}
    for key, text in rows:
        w = WORDS.findall(lower(text or ""))
        sets[key] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def test_jaccard_groups_equal_brute_force(spark, folder):
    docs = small(spark, folder, "documents")
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 400, 150)]
    near = []
    for k in range(120):  # a group of near copies of one text, some chained, some just too far
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"new{k}_{at}"
        near.append((10_000 + k, " ".join(words)))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs).collect()}
    assert got == want
    kept = {r.doc_id for r in jaccard.one_of_each_group(docs).select("doc_id").collect()}
    assert kept == {c for _, c in want.values()}


def test_jaccard_awkward_rows(odd, empty):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(odd).collect())
    assert got[(1, 0, 1)] == got[(2, 0, 2)] == got[(3, 0, 3)] == 1
    assert got[(4, 900, 4)] == got[(5, 900, 4)] == 1 and got[(6, 1, 6)] == 2 and got[(None, 3, None)] == 1
    kept = jaccard.one_of_each_group(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert jaccard.similar_groups(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- op9

def test_decontamination_tolerates_substitutions(spark, odd, empty):
    item = [f"b{i}" for i in range(30)]
    touched = list(item)
    touched[9] = touched[21] = "other"
    rows = [(1, "x y " + " ".join(item) + " z"), (2, " ".join(touched)), (3, " ".join(item[:9])), (4, "clean " * 40), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, "b1 b2"), (9, None), (None, " ".join(item))],
                                      "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.doc_start, r.n_words, r.n_equal) for r in seeds.overlaps(docs, benchmark).collect()}
    assert got == {(1, 7): (2, 30, 30), (2, 7): (0, 30, 28)}
    assert [r.doc_id for r in seeds.without_benchmark(docs, benchmark).orderBy("doc_id").collect()] == [3, 4, 5]
    assert seeds.without_benchmark(odd, benchmark).count() == odd.count()
    assert seeds.overlaps(empty, benchmark).count() == 0


def test_decontamination_finds_planted_passages(spark, folder):
    docs, benchmark = small(spark, folder, "documents"), small(spark, folder, "benchmark")
    items = [r.text for r in benchmark.collect()]
    whole = {r.doc_id for r in docs.collect() if any(t in r.text for t in items)}
    found = {r.doc_id for r in seeds.overlaps(docs, benchmark).collect()}
    assert whole <= found


def test_every_accepted_overlap_has_a_seed():
    def seeded(equal):
        return any(all(equal[i + j] for j, c in enumerate(m) if c == "1")
                   for m in seeds.MASKS for i in range(len(equal) - len(m) + 1))
    for n in range(4, 17):  # whole items, and parts of 12 to 16 words; longer ones hold even more equal words a gap
        for bits in range(1 << n):
            equal = [bool(bits >> i & 1) for i in range(n)]
            if sum(equal) >= 0.75 * n and seeds.overlap(np.array(equal), n):
                assert seeded(equal), equal


def test_short_and_edited_items_are_found(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (4, 9, 11, 15, 17, 20, 27)}
    changed = {4: (), 9: (4,), 11: (2, 8), 15: (2, 7, 12), 17: (3, 8, 13), 20: (3, 7, 11, 15), 27: (3, 7, 11, 15, 19, 23)}
    rows, other = [], ["so", "it", "goes"]
    for n, words in items.items():
        rows.append((n, " ".join(other + words + other)))
        rows.append((100 + n, " ".join(other + [f"x{k}" if k in changed[n] else w for k, w in enumerate(words)] + other)))
    rows.append((900, " ".join(items[9][:6] + ["y"] * 30)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_equal for r in seeds.overlaps(docs, benchmark).collect()}
    assert got == {(n, n): n for n in items} | {(100 + n, n): n - len(changed[n]) for n in items}


@given(st.lists(st.booleans(), max_size=40))
def test_best_stretch_equals_brute_force(equal):
    start, end, n = seeds.best_stretch(np.array(equal, dtype=bool))
    best = max((sum(equal[i:j]) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
                if 4 * sum(equal[i:j]) >= 3 * (j - i)), default=0)
    assert n == best == sum(equal[start:end]) and 4 * n >= 3 * (end - start)


def test_long_overlap_with_a_worse_whole_keeps_its_core():
    core = np.tile([True, True, True, True, False], 8)  # 80 % equal
    around = np.tile([True, True, False], 60)  # 67 %
    equal = np.concatenate([around, core, around])
    start, end, n = seeds.overlap(equal, len(equal))
    assert n >= 32 and n >= seeds.LEAST_SHARE * (end - start)


# --- op1, op6

def test_language_accuracy_and_awkward_rows(spark, folder, odd, empty):
    docs = small(spark, folder, "documents")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in language.identify(odd).collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[4].lang_pred in ("en", "de", "fr")
    assert language.identify(empty).count() == 0


def test_toxicity_finds_words_of_the_toxic_class(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(300):
        words = [f"plain{i}" for i in rng.integers(0, 60, 40)]
        if k % 5 == 0:
            words[7], words[20] = "vilethug", "lowbrute"
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 5 == 0), 1))
    docs = spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.score(docs, marks).collect()}
    assert all(got[k].predicted == int(k % 5 == 0) for k in range(300))
    assert got[900].predicted == got[901].predicted == 0
    kept = toxicity.without_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == 300 - 60 + 2
    assert toxicity.without_toxic(docs, marks.where("toxic = 0")).count() == docs.count()


def test_toxicity_learns_stems_and_rare_words(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for k in range(400):
        words = [f"plain{i}" for i in rng.integers(0, 60, 60)]
        if k % 5 == 0:  # no such word is in three texts, only their stem is
            for at in (7, 20, 41):
                words[at] = "réeux" + "".join(rng.choice(list("bcdfghklm"), 5))
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, marks).collect()}
    assert all(got[k] == int(k % 5 == 0) for k in range(400))


def test_chance_hits_of_long_texts_do_not_add_up():
    hit = {"bad": 4.0, "ill": 4.0}
    clean = ["plain"] * 20_000
    clean[::400] = ["bad"] * 50
    short = ["plain"] * 100
    short[3], short[9] = "bad", "ill"
    weigh = lambda words: toxicity.text_evidence(words, lambda w: hit.get(w, 0.0))
    assert weigh(clean) == 0.0 and weigh(short) == weigh(["plain"] * 50 + short[:50]) == 8.0
    assert weigh(["plain"] * 20_000 + short) > 0.0 and weigh([]) == 0.0


def test_fit_reads_texts_beyond_their_first_20000_characters(spark):
    rng = np.random.default_rng(4)
    long_start = " ".join(f"plain{i}" for i in rng.integers(0, 60, 3_000))
    rows = [(k, f"{long_start} {'vilethug lowbrute' if k % 3 == 0 else 'plain1 plain2'}") for k in range(60)]
    docs = spark.createDataFrame(rows + [(99, "plain3 vilethug lowbrute plain4")], "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.toxicity_model(docs, marks)
    assert b"vilethug" in model["toxic"] and b"lowbrute" in model["toxic"]
    texts = spark.createDataFrame([(k, "first words " * 4_000 + "zebra " * 4_000, "aa") for k in range(9)],
                                  "doc_id long, text string, lang string")
    found = language.learn(texts, texts.selectExpr("doc_id", "lang as label"), 9)
    assert b"first" in found["aa"] and b"zebra" in found["aa"]


# --- op2, op3

@pytest.fixture(scope="module")
def word_bpe():
    return bpe.WordBpe(json.load(open(public_tokenizers.path("word_bpe_49k.json"))))


@given(st.text(st.characters(max_codepoint=0x24FF, exclude_categories=("Cs", "Cn")), max_size=60) | st.text("aAé'stlvm<|endoftext|> Σσİ\x1ć日", max_size=60))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_the_library(word_bpe, text):
    from tokenizers import Tokenizer
    global _LIBRARY
    _LIBRARY = globals().get("_LIBRARY") or Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = _LIBRARY.encode(text, add_special_tokens=False).ids
    ids, back = word_bpe.encode(text)
    assert list(array("I", ids)) == want
    assert back == _LIBRARY.decode(want, skip_special_tokens=False) == word_bpe.decode(want)


def test_bpe_rows(odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.encode_documents(odd, path, with_ids=True)
    got = {r.doc_id: r for r in rows.collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].ids_sha256 == got[2].decoded_sha256 == nothing
    assert {r.doc_id: r.text for r in bpe.decode_ids(rows, path).collect()}[6] == "one</w>"
    assert bpe.encode_documents(empty, path).count() == 0


def test_length_limits_equal_brute_force(spark, folder, odd, empty):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = small(spark, folder, "documents")
    counted = lengths.token_lengths(docs, path, public_tokenizers.PATTERN)
    count = lengths.piece_counter(open(path, "rb").read(), public_tokenizers.PATTERN)
    import base64
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("", "  a  b\n\n c", "it's  '  ' x", "é😀 日本"):
        assert count(text) == len(whole.encode_ordinary(text))
    sizes = [r.n_tokens for r in counted.collect()]
    histogram = lengths.length_histogram(counted)
    for r in lengths.limits(histogram).collect():
        limit = r.n_tokens
        assert (r.docs_at_most, r.docs_longer) == (sum(s <= limit for s in sizes), sum(s > limit for s in sizes))
        assert r.tokens_truncated == sum(min(s, limit) for s in sizes) and r.tokens_whole == sum(s for s in sizes if s <= limit)
        assert r.tokens_lost == sum(sizes) - r.tokens_truncated
    asked = {r.limit: r.tokens_truncated for r in lengths.at_limits(histogram, [10, 777]).collect()}
    assert asked == {k: sum(min(s, k) for s in sizes) for k in (10, 777)}
    assert lengths.token_lengths(odd, path, public_tokenizers.PATTERN).where("n_tokens = 0").count() == 2
    none = lengths.length_histogram(lengths.token_lengths(empty, path, public_tokenizers.PATTERN))
    assert lengths.limits(none).count() == 0


# --- op4, op5

@given(st.lists(st.tuples(st.text("ab\\<|>turnext/[]\n", max_size=30), st.text("<|end|>\\ x", max_size=40)), max_size=5))
@settings(max_examples=200, deadline=None)
def test_chat_round_trip(turns):
    out = chat.Template().render([{"role": r, "text": t} for r, t in turns])
    assert chat.read_turns(out.text) == turns


def test_template_language():
    t = chat.Template("{# note #}{% if 1 == 2 %}no{% elif true and not false %}{{ 'a' + 'b' | upper }}{% endif %}-"
                      "{% for m in messages %}{{ loop.index }}{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}")
    assert t.tree[0] == chat.Print(chat.Constant("aB-"))
    assert t.render([{"text": "x"}, {"text": "y"}]).text == "aB-1x,2y"
    for bad in ("{{ m.", "{% for x %}", "{{ x() }}", "{{ x | nope }}", "{% if x %}", "{{ 'a' 'b' }}", "{% do x %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
    with pytest.raises(chat.TemplateError):
        chat.Template("{{ messages.__class__ }}").render([])


def test_chat_awkward_rows(spark):
    rows = [(1, 0, "assistant", None), (1, None, None, "first"), (None, 0, "user", "u"), (1, 0, "assistant", "<|end|>")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    said = "\nfirst\nassistant\n\nassistant\n<|end|>\n"
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].loss_chars == 7
    assert got[None].n_turns == 1 and got[None].loss_chars == 0
    assert chat.digests(chat.format_conversations(turns.where("false"))).count() == 0


def test_url_rules(spark):
    from creditloom.llm.queries import URL_RULES
    rows = [(1, "https://A.Example.com/en/x?q"), (2, "http://www.example.com/en/"), (3, "x"), (4, None), (5, "ftp://a.net/es/#t"),
            (6, "http://badexample.com/en/"), (7, "http://net/fr"), (8, "http://casino.org"), (9, "http://example.com"),
            (10, "http://casinos.org/EN/"), (11, "http://com/En/")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, URL_RULES).collect()}
    assert got == {1: ("a.example.com", "/en/x", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
                   3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("a.net", "/es/", "net/es/", "block"),
                   6: ("badexample.com", "/en/", "com/", "allow"), 7: ("net", "/fr", None, "allow"), 8: ("casino.org", "", None, "block"),
                   9: ("example.com", "", None, "allow"), 10: ("casinos.org", "/EN/", None, "allow"), 11: ("com", "/En/", "com/", "allow")}
    assert urls.judge(pages.where("false"), URL_RULES).count() == 0


# --- op7, op8

#: The patterns of the contract.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and sum(double) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_equals_brute_force(spark, odd, empty):
    rng = np.random.default_rng(5)
    alphabet = list("0123456789.@+- ()ab%é😀4111")
    texts = ["".join(rng.choice(alphabet, 60)) for _ in range(400)]
    texts += ["4111 1111 1111 1111", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "%" * 3000 + "@x.y", "call 555-123-4567", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        want = brute_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert set(want) <= set(r.spans.split(",") if r.spans else []) and r.n_email == sum(s.startswith("email") for s in want)
    clean = {r.doc_id: r for r in pii.redact(odd).collect()}
    assert clean[8].text == "é😀 <EMAIL> <PHONE>" and clean[8].n_chars == 18 and clean[1].text is None and clean[6].n_chars == 3
    assert pii.redact(odd).columns == odd.columns
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def test_em_trusts_labelers_that_agree():
    patterns = [("card", (1, 1, 0, 1, 1), 500), ("card", (-1, 1, 0, -1, 1), 60), ("card", (-1, -1, 0, -1, 1), 300)]
    right, _, chance = pii.estimate(patterns)
    assert chance["card", (1, 1, 0, 1, 1)] > 0.95 and chance["card", (-1, -1, 0, -1, 1)] < 0.05
    assert right["card", 3] > right["card", 4]


def test_outlier_statistics_and_verdict(spark, odd, empty):
    rng = np.random.default_rng(7)
    rows = [(k, " ".join(f"w{i}" for i in rng.integers(0, 5000, rng.integers(80, 300))) + "\nend\n", "en", "s")
            for k in range(200)]
    rows += [(900, "a b c d\na b c d\n" * 20, "en", "s"), (901, " ".join(f"{i}###" for i in range(200)), "en", "s"),
             (902, "few words", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    for key, text, *_ in rows:
        w = WORDS.findall(text)
        seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeated = {i + d for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        assert (got[key].n_words, got[key].word_chars, got[key].n_symbols, got[key].n_dup_lines, got[key].n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
    assert all(got[k].kept for k in range(200)) and not any(got[k].kept for k in (900, 901, 902))
    assert outliers.judge(odd).count() == odd.count() and outliers.judge(empty).count() == 0


# --- pipeline

def test_pipeline_stages(spark, folder):
    import corpus_pipeline
    from creditloom.session import materialise
    docs = small(spark, folder, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels, benchmark = small(spark, folder, "labels"), small(spark, folder, "benchmark")
    gone = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in at.collect()}
        at = materialise(stage(spark, at, folder), name)
        if name == "toxicity":
            assert {r.doc_id for r in at.collect()} == set(texts) - gone
        elif name == "ngram_jaccard":
            assert {r.doc_id for r in at.collect()} == {c for _, c in brute_groups(before.items()).values()}
        elif name == "decontamination":
            items = [r.text for r in benchmark.collect()]
            assert not any(t in r.text for r in at.collect() for t in items)
        elif name == "pii":
            assert not any(brute_spans(r.text) for r in at.collect()) and at.count() == len(before)
        if name != "bpe":
            assert at.columns == docs.columns
    assert at.count() == len(before)
