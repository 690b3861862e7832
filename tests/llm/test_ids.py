"""Rows are judged by what they hold, however ids repeat or are missing; and large groups of copies cost pairs in proportion."""

import random

import pytest
from pyspark.sql import functions as F

from creditloom.llm import jaccard, seeds

FIELDS = "doc_id long, text string, mark string, row long, key string"


def table(spark, rows, order=1):
    return spark.createDataFrame([(d, t, "m", i, "k") for i, (d, t) in enumerate(rows)][::order], FIELDS).repartition(3)


A, B, C, D = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")


@pytest.mark.parametrize("order", [1, -1])
def test_no_text_is_lost_to_a_shared_id(spark, order):
    rows = [(1, A), (1, B), (2, A), (0, C), (3, C), (3, D), (3, D), (None, A), (None, A), (4, None), (4, None), (5, "")]
    kept = jaccard.one_of_each_group(table(spark, rows, order))
    assert kept.columns == ["doc_id", "text", "mark", "row", "key"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, A), (1, B), (0, C), (3, D), (None, A), (None, A), (4, None), (4, None), (5, "")], key=str)


def test_one_text_stays_of_an_id_with_near_copies(spark):
    near, upper = A.replace("a0 ", "x "), A.upper()
    rows = [(1, A), (1, upper), (2, near), (2, B)]
    kept = {(r.doc_id, r.text) for r in jaccard.one_of_each_group(table(spark, rows)).collect()}
    assert len(kept) == 2 and (2, B) in kept and kept <= {(1, A), (1, upper), (2, B)}


@pytest.mark.parametrize("order", [1, -1])
def test_leaks_are_found_by_text(spark, order):
    items = spark.createDataFrame([(7, A), (7, B), (8, "one two"), (None, C)][::order], "item_id long, text string")
    rows = [(1, "x " + A), (1, D), (2, B), (None, "so " + A + " on"), (None, D), (3, "one two"), (4, "one two three"), (5, C)]
    docs = table(spark, rows, order)
    found = {(r.doc_id, r.item_id): r.n_equal for r in seeds.overlaps(docs, items).collect()}
    assert found == {(1, 7): 30, (2, 7): 30, (None, 7): 30, (3, 8): 2}
    kept = sorted(((r.doc_id, r.text) for r in seeds.without_benchmark(docs, items).collect()), key=str)
    assert kept == sorted([(1, D), (None, D), (4, "one two three")], key=str)


def test_empty_benchmark(spark):
    docs = table(spark, [(1, A), (None, None)])
    none = spark.createDataFrame([], "item_id long, text string")
    assert seeds.overlaps(docs, none).count() == 0 and seeds.without_benchmark(docs, none).count() == 2


def near_copies(spark, n):
    """One group: up to four of 200 words of each copy are others."""
    rng = random.Random(n)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for doc in range(n):
        own = list(words)
        for at in rng.sample(range(200), rng.randint(0, 4)):
            own[at] = f"x{rng.randint(0, 10 ** 9)}"
        rows.append((doc, " ".join(own)))
    return table(spark, rows)


def test_pairs_grow_in_proportion_to_a_group(spark, monkeypatch):
    made = {}
    plain = jaccard._verified

    def counted(pairs, *rest):
        made["pairs"] = made.get("pairs", 0) + pairs.count()
        return plain(pairs, *rest)
    monkeypatch.setattr(jaccard, "_verified", counted)
    for n in (400, 1_600):
        made.clear()
        groups = jaccard.similar_groups(near_copies(spark, n))
        assert groups.agg(F.count_distinct("component_id")).first()[0] == 1
        assert made["pairs"] <= 1.5 * n


def test_later_rounds_leave_unchanged_tokens_alone(spark, monkeypatch):
    """Pairs of texts just too far apart share tokens for good; only the first centre round looks at them."""
    pairs = [(10_000 + 2 * i + j, " ".join([f"p{i}q{k}" for k in range(27)] + [f"p{i}r{j}s{k}" for k in range(3)]))
             for i in range(20) for j in range(2)]
    docs = near_copies(spark, 400).unionByName(table(spark, pairs))
    looked, plain = [], jaccard._centre_pairs

    def counted(rows, *rest):
        looked.append(rows.where("n = 26").count())
        return plain(rows, *rest)
    monkeypatch.setattr(jaccard, "_centre_pairs", counted)
    groups = jaccard.similar_groups(docs).select("doc_id", "component_id").collect()
    assert len(looked) > 1 and looked[0] >= 40 and not any(looked[1:])
    assert {r.component_id for r in groups if r.doc_id < 10_000} == {0}
    assert all(r.component_id == r.doc_id for r in groups if r.doc_id >= 10_000)
