"""A corpus refreshed by batches against a fit on all of it."""

import pytest

from speechlens.operators import refresh as R
from speechlens.operators import tfidf as T

OPTS = T.TextOptions.build(remove_stop_words=False, stemming=False)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, speech string, other int").repartition(3) if rows else spark.createDataFrame(
        [], "doc_id long, speech string, other int")


def same(spark, corpus, rows, **how):
    got = R.refreshed_model(corpus, **how)
    want = T.fit_tfidf(docs(spark, rows), options=OPTS, **how)
    assert got.n_docs == want.n_docs
    table = lambda m: {(r[0], r[1]): (r[2], r[3]) for r in m.weights.select("doc_id", "term", "tf", "weight").collect()}
    a, b = table(got), table(want)
    assert a.keys() == b.keys()
    assert all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], abs=1e-12) for k in a)
    words = lambda m: {tuple(r) for r in m.vocabulary.select("term", "term_id", "df", "cf").collect()}
    assert words(got) == words(want)
    return got


def test_batches_and_replacements(spark, tmp_path):
    corpus = R.open_corpus(spark, str(tmp_path / "c"), OPTS, n_buckets=4)
    now = {i: (i, f"word{i % 7} both{i % 3} " * (i % 4 + 1), 1) for i in range(40)}
    R.append(corpus, docs(spark, list(now.values())), "a")
    same(spark, corpus, list(now.values()))
    more = {i: (i, f"word{i % 5} late{i}", 1) for i in range(40, 60)} | {60: (60, None, 1), 61: (61, "", 1)}
    R.append(corpus, docs(spark, list(more.values())), "b")
    now |= more
    same(spark, corpus, list(now.values()))
    # changed twice, one of them to nothing; a term that only old texts had goes
    for name, text in (("c", "word1 changed"), ("d", None)):
        changed = {i: (i, text, 1) for i in (3, 45)} | {100: (100, "brand new", 1)}
        R.append(corpus, docs(spark, list(changed.values())), name, replace=True)
        now |= changed
        same(spark, corpus, list(now.values()))
    got = same(spark, corpus, list(now.values()), max_df=0.3, max_features=5)
    assert got.vocabulary.count() == 5 and got.vocabulary.where("term = 'late45'").isEmpty()


def test_compacted(spark, tmp_path):
    corpus = R.open_corpus(spark, str(tmp_path / "c"), OPTS, n_buckets=4)
    now = {i: (i, f"word{i % 7} both{i % 3}", 1) for i in range(20)}
    R.append(corpus, docs(spark, list(now.values())), "a")
    for name, i in (("b", 3), ("c", 4)):
        now[i] = (i, f"changed{i} word1", 1)
        R.append(corpus, docs(spark, [now[i]]), name, replace=True)
    one = R.compacted(corpus, str(tmp_path / "one"))
    assert one.dead().count() == 0 and len(one._listed()) == 1
    R.append(one, docs(spark, [(1, "seen before", 1)]), "b")
    same(spark, one, list(now.values()))
    now[3] = (3, "word2 again", 1)
    R.append(one, docs(spark, [now[3], (50, "brand new", 1)]), "d", replace=True)
    same(spark, one, [*now.values(), (50, "brand new", 1)])
    with pytest.raises(ValueError, match="already"):
        R.compacted(corpus, str(tmp_path / "one"))


def test_a_name_counts_once_and_ids_are_checked(spark, tmp_path):
    corpus = R.open_corpus(spark, str(tmp_path / "c"), OPTS, n_buckets=2)
    R.append(corpus, docs(spark, [(1, "one two", 0)]), "a")
    R.append(corpus, docs(spark, [(1, "other", 0)]), "a")
    same(spark, corpus, [(1, "one two", 0)], max_df=1.0)
    with pytest.raises(ValueError, match="already"):
        R.append(corpus, docs(spark, [(1, "again", 0)]), "b")
    for bad in ([(2, "x y", 0), (2, "z", 0)], [(None, "x", 0)]):
        with pytest.raises(ValueError, match="repeat or are null"):
            R.append(corpus, docs(spark, bad), "b")
    assert [b["name"] for b in corpus.batches()] == ["a"]


def test_opened_again(spark, tmp_path):
    path = str(tmp_path / "c")
    corpus = R.open_corpus(spark, path, OPTS, n_buckets=2)
    R.append(corpus, docs(spark, []), "empty")
    R.append(corpus, docs(spark, [(1, "one two two", 0), (2, "two three", 0)]), "a")
    spark.sql(f"DROP TABLE {corpus.counts_table()}")  # another session does not know the table
    again = R.open_corpus(spark, path)
    R.append(again, docs(spark, [(3, "three four", 0)]), "b")
    same(spark, again, [(1, "one two two", 0), (2, "two three", 0), (3, "three four", 0)])
    with pytest.raises(ValueError, match="other text options"):
        R.open_corpus(spark, path, T.TextOptions.build(remove_stop_words=True, stemming=False))


def test_counts_are_not_shuffled_by_document(spark, tmp_path):
    corpus = R.open_corpus(spark, str(tmp_path / "c"), OPTS, n_buckets=4)
    for k in range(2):
        R.append(corpus, docs(spark, [(i, f"a{i} b{i % 3}", 0) for i in range(k * 20, k * 20 + 20)]), str(k))
    weights = T.weigh(corpus.counts(), T.vocabulary_side(T.select_vocabulary(corpus.statistics(), 40), 6000))
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan
