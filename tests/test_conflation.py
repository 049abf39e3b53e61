"""Learned conflation on planted word forms, and components of links."""

import random

import pytest
from pyspark.sql import functions as F

from speechlens.functions.graph import components
from speechlens.operators import conflation as CF

GREEK = ["ος", "ου", "ον", "οι"]
ENGLISH = ["", "s", "ed", "ing"]


@pytest.fixture(scope="module")
def held(spark):
    """Documents each about some words, whose forms they mix; and words that only
    look alike, in documents of their own."""
    rng = random.Random(5)
    rows, truth = [], {}
    for lang, endings, letters in (("el", GREEK, "αβγδεζηθικλμν"), ("en", ENGLISH, "bcdfghklmnprt")):
        stems = {"".join(rng.choice(letters) for _ in range(6)) for _ in range(60)}
        stems = sorted(stems)
        for s in stems:
            for e in endings:
                truth[lang, s + e] = s
        for d in range(240):
            for s in rng.sample(stems[:40], 4):
                rows += [(lang, d, s + e) for e in rng.sample(endings, 3)]
        # the last twenty stems have their forms in different documents: no evidence
        for i, s in enumerate(stems[40:]):
            for j, e in enumerate(endings):
                rows += [(lang, 240 + (i * 4 + j) * 3 + x, s + e) for x in range(3)]
        truth["alone", lang] = set(stems[40:])
    return spark.createDataFrame(rows + [(None, 1, "word"), ("en", None, "word"), ("en", 1, None)],
                                 "lang string, doc_id long, word string").repartition(4), truth


def test_planted_forms_become_one_term(held):
    df, truth = held
    got = {(r["lang"], r["word"]): r["term"] for r in CF.learn_terms(df).collect()}
    groups = {}
    for key, term in got.items():
        groups.setdefault((key[0], term), set()).add(truth[key])
    assert all(len(stems) == 1 for stems in groups.values()), "different stems were put together"
    for lang, endings in (("el", GREEK), ("en", ENGLISH)):
        stems = {s for (k, w), s in truth.items() if k == lang} - truth["alone", lang]
        together = [len({got.get((lang, s + e)) for e in endings}) == 1 for s in stems]
        assert sum(together) >= 0.95 * len(together)
        assert not any((lang, s + e) in got for s in truth["alone", lang] for e in endings)


def test_the_term_is_the_most_frequent_form(spark, held):
    rows = CF.learn_terms(held[0]).collect()
    best = {}
    for r in rows:
        best.setdefault((r["lang"], r["term"]), []).append((-r["df"], r["word"]))
    assert all(min(v)[1] == k[1] for k, v in best.items())
    tokens = spark.createDataFrame([("en", rows[0]["word"], 1), ("en", "unseen", 2), ("xx", "unseen", 3)], "lang string, word string, n int")
    out = CF.conflate(tokens.withColumn("lang", F.when(F.col("n") == 1, rows[0]["lang"]).otherwise(F.col("lang"))),
                      spark.createDataFrame(rows))
    assert {(r["n"], r["term"]) for r in out.collect()} == {(1, rows[0]["term"]), (2, "unseen"), (3, "unseen")}


def test_no_words(spark):
    assert CF.learn_terms(spark.createDataFrame([], "lang string, doc_id long, word string")).count() == 0


def test_pairs_are_counted_inside_documents(spark):
    """Every form in many documents, few of them shared: what is joined and counted is
    what documents hold together, not each pair's documents."""
    e, rng = CF.Evidence(least_stems=2), random.Random(3)
    docs = {d: {rng.choice(("walk", "talk", "ache", "achen")) + rng.choice(("", "s", "er", "ers", "ing")) for _ in range(3)} for d in range(300)}
    docs[300] = {"a", "ab", "abc", "walk", "walkings", "walkers"}
    rows = [("en", d, w) for d, words in docs.items() for w in words]
    held = spark.createDataFrame(rows + rows[:50], "lang string, doc_id long, word string").repartition(3)
    own = CF.document_words(held.select("lang", "doc_id", F.array("word").alias("words")))
    assert sorted((r["doc_id"], w) for r in own.collect() for w in r["words"]) == sorted((d, w) for _, d, w in rows)
    want = {}
    for words in docs.values():
        for a in words:
            for b in words:
                k = max(4, len(a) - 3, len(b) - 3)
                if a < b and min(len(a), len(b)) >= k and a[:k] == b[:k]:
                    want[a, b] = want.get((a, b), 0) + 1
    got = {(r["a"], r["b"]): r["together"] for r in CF._pairs_together(own, e).collect()}
    assert got == {k: n for k, n in want.items() if n >= e.least_together} and len(got) > 10
    words = own.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("word").alias("df"))
    plan = CF.word_links(own, words, e)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "doc_id" in x]


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(100)] + [(200, 150), (150, 170), (300, 300), (None, 5), (7, None)]
    links += [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
