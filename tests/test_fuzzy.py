"""Fuzzy suggestions against the edit distance of all pairs."""

import random

import pytest

from speechlens.operators import fuzzy


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_equal_to_all_pairs(spark, edits):
    rng = random.Random(edits)
    terms = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(250)} | {"aaaa", "aaaaa", "abababab"}
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(0, 9))) for _ in range(120)} | {"aaaaaa", "ababab", "zzzzzzz", ""}
    rows = [(t, i % 7 + 1) for i, t in enumerate(sorted(terms))]
    index = fuzzy.build_index(spark.createDataFrame(rows, "term string, df int"))
    asked = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,), ("abc",), ("abc",)], "word string")
    df = dict(rows)
    want = {(w, t, df[t], d) for w in words | {"abc"} for t in terms for d in [distance(w, t)] if d <= edits}
    assert {tuple(r) for r in fuzzy.near_terms(index, asked, edits).collect()} == want
    best = {}
    for w, t, n, d in sorted(want, key=lambda r: (r[0], r[3], -r[2], r[1])):
        best.setdefault(w, []).append((t, n, d))
    got = {(r["word"], r["rank"]): (r["term"], r["df"], r["edits"]) for r in fuzzy.suggest_fuzzy(index, asked, edits, 3).collect()}
    assert got == {(w, i): x for w, l in best.items() for i, x in enumerate(l[:3], 1)}


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "term string, df int")
    some = spark.createDataFrame([("word", 1)], "term string, df int")
    words = spark.createDataFrame([("word",)], "word string")
    assert fuzzy.suggest_fuzzy(fuzzy.build_index(none), words).count() == 0
    assert fuzzy.suggest_fuzzy(fuzzy.build_index(some), words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fuzzy.near_terms(fuzzy.build_index(some), words, 3)


def test_a_hot_trigram_is_not_looked_up(spark):
    """Every term begins alike; a word with rarer trigrams does not meet them all."""
    terms = spark.createDataFrame([(f"common{i:04d}", 1) for i in range(3000)], "term string, df int")
    index = fuzzy.build_index(terms)
    words = spark.createDataFrame([("common1234",)], "word string")
    got = {r["term"] for r in fuzzy.near_terms(index, words, 1).collect()}
    assert got == {f"common{i:04d}" for i in range(3000) if distance("1234", f"{i:04d}") <= 1}
