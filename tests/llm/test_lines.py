"""Line dedup against brute force, on awkward rows and on every way of joining."""

import collections
import hashlib
import random

import numpy as np
import pytest

from creditloom.llm import lines

WHITE = " \t\n\x0b\x0c\r"
FIELDS = "doc_id long, text string, n_lines string, gone string, key long, row long"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, least_chars=40, least_documents=5):
    holders = collections.defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key_of(line)) >= least_chars:
                    holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if doc is None or len(holders[key_of(x)]) < least_documents or doc == max(holders[key_of(x)])]
        out.append((doc, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, **how):
    table = spark.createDataFrame([(d, t, "x", "y", 3, 4) for d, t in rows], FIELDS)
    done = lines.drop_repeated_lines(table, **how)
    assert sorted(done.columns) == sorted(["doc_id", "text", "n_lines", "gone", "key", "row", "n_dropped"])
    return sorted((tuple(r) for r in lines.digests(done).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared = [f"Passage {k} " + "é" * (28 + k % 4) + " ends" for k in range(12)]  # keys of 41 to 46 code points
    exact = ["x" * 39, "y" * 40]                                                 # one below, one at the limit
    found = []
    for doc in range(60):
        own = [rng.choice(["", "short", f"a line of its own, number {doc}, {rng.random()}"]) for _ in range(4)]
        own += [rng.choice(["", " \t", "\r"]) + rng.choice([s, s.upper().replace("É", "é")]) + rng.choice(["", " ", "\x0b"])
                for s in rng.sample(shared + exact, 3)]
        rng.shuffle(own)
        found.append((doc, "\n".join(own)))
    twice = "\n".join([shared[0], shared[0], "z"])
    return found + [(None, twice), (None, None), (70, None), (71, ""), (72, " \n\t "), (60, twice), (60, twice), (60, shared[1]),
                    (73, "\n".join(f"line {i % 700} of a very long text, padded to count" for i in range(30_000))),
                    (74, "\n"), (75, "lonely\n" + "q" * 300)]


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0}, {"least_documents": 2}, {"least_chars": 1, "least_documents": 3}])
def test_lines_equal_brute_force(spark, rows, how):
    limits = {k: v for k, v in how.items() if k != "broadcast_rows"}
    assert result(spark, rows, **how) == brute(rows, **limits)


def test_hot_lines_are_joined_apart(spark, rows, monkeypatch):
    monkeypatch.setattr(lines, "HOT_ROWS", 7)
    assert result(spark, rows, broadcast_rows=0) == brute(rows)


def test_a_full_filter_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(lines, "seen_twice", lambda names, max_bits: np.full(lines.SEGMENT, 255, dtype=np.uint8))
    assert result(spark, rows) == brute(rows)


def test_filters_keep_every_repeat_and_few_others(spark):
    single = spark.range(40_000).selectExpr("id AS doc_id", "array(named_struct('a', xxhash64(id), 'b', id)) AS names")
    double = spark.range(2_000).selectExpr("id AS doc_id", "array(named_struct('a', xxhash64(-id - 1), 'b', id)) AS names")
    table = lines.seen_twice(single.unionByName(double).unionByName(double).repartition(7))
    held = lambda expr, n: np.array([r[0] for r in spark.range(n).selectExpr(expr).collect()])
    assert lines._holds(table, held("xxhash64(-id - 1)", 2_000)).all()
    assert lines._holds(table, held("xxhash64(id)", 40_000)).mean() < 0.02


def test_empty_table(spark):
    assert result(spark, []) == []
