"""Block-max search against the exhaustive search."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from speechlens.functions import tables
from speechlens.operators import postings as PO
from speechlens.operators import search as S
from speechlens.operators import tfidf as T


def corpus(spark, n, seed, words=60):
    rng = random.Random(seed)
    # a few words are everywhere, most are rare; some texts are exact copies
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.6)), words)}" for _ in range(rng.randrange(1, 30))) for _ in range(n)]
    for i in range(0, n, 7):
        texts[i] = texts[i // 2]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, speech string")


def found(scores, k, floor=S.SCORE_FLOOR):
    return sorted(tuple(r) for r in S.top_hits(scores, k, floor).collect())


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocks"))
    opts = T.TextOptions.build(remove_stop_words=False, stemming=False)
    m = T.fit_tfidf(corpus(spark, 600, 1), options=opts, path=path + "/model")
    return m, path


@pytest.mark.parametrize("range_docs", [1, 16, 1000])
def test_equal_hits(spark, fitted, range_docs):
    m, path = fitted
    index = PO.build_index(m, f"{path}/blocks-{range_docs}", range_docs)
    rng = random.Random(range_docs)
    texts = [" ".join(f"w{rng.randrange(1, 61)}" for _ in range(n)) for n in (1, 2, 3, 5, 20, 60)] + ["unknown", "", None, "w1 w1 w1"]
    q = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    want = S.score(m, q)
    for k, floor in ((1, 0.001), (10, 0.3), (700, 0.001)):
        got = PO.pruned_scores(index, S.query_weights(m, q), k, floor)
        assert found(got.scores, k, floor) == found(want, k, floor)
        for r in got.read.collect():
            assert 0 <= r["blocks_read"] <= r["blocks"]


def test_blocks_hold_the_postings(spark, fitted):
    m, path = fitted
    index = PO.build_index(m, f"{path}/blocks-16", 16)
    back = index.blocks.select("range_id", "term", F.explode(F.arrays_zip("deltas", "weights")).alias("p")).select(
        (F.col("range_id") * 16 + F.col("p.deltas")).alias("doc_id"), "term", "p.weights")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in m.weights.select("doc_id", "term", "weight").collect()}
    assert index.blocks.where("n > 16 OR n <> size(deltas)").isEmpty()
    assert index.blocks.where(F.abs(F.col("top") - F.array_max("weights")) > 0).isEmpty()


def test_blocks_are_skipped(spark, tmp_path):
    """A rare word beside a common one: most blocks of the common one stay shut."""
    rows = [(i, "common " + ("rare words " if i % 400 == 3 else "") + f"x{i % 50} y{i % 9}") for i in range(4000)]
    opts = T.TextOptions.build(remove_stop_words=False, stemming=False)
    m = T.fit_tfidf(spark.createDataFrame(rows, "doc_id long, speech string"), max_df=1.0, options=opts, path=str(tmp_path / "m"))
    index = PO.build_index(m, str(tmp_path / "b"))
    q = spark.createDataFrame([(1, "common rare")], "query_id long, text string")
    got = PO.pruned_scores(index, S.query_weights(m, q))
    assert found(got.scores, 10) == found(S.score(m, q), 10)
    r = got.read.first()
    assert r["blocks_read"] < 0.3 * r["blocks"]


def test_an_empty_model(spark, tmp_path):
    opts = T.TextOptions.build(remove_stop_words=False, stemming=False)
    m = T.fit_tfidf(spark.createDataFrame([], "doc_id long, speech string"), options=opts, path=str(tmp_path / "m"))
    index = PO.build_index(m, str(tmp_path / "b"))
    q = spark.createDataFrame([(1, "common rare")], "query_id long, text string")
    assert PO.pruned_scores(index, S.query_weights(m, q)).scores.count() == 0


def test_blocks_are_made_in_one_shuffle_of_the_weights(spark, plain, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 7} word{i % 11} speech") for i in range(400)] + [(3, "word2 again"), (None, "none")],
                                 "doc_id long, speech string")
    weights = T.fit_tfidf(docs, options=plain, max_df=1.0, path=str(tmp_path / "model")).weights
    dealt = PO.posting_blocks(weights, 32, 5)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = lambda d: sorted((str(r) for r in d.collect()))
    assert rows(dealt) == rows(PO.posting_blocks(weights, 32))
    out = tables.write_bucketed(dealt, str(tmp_path / "blocks"), 5, "range_id", ["term", "range_id"], dealt=True)
    files = glob.glob(str(tmp_path / "blocks") + "/*.parquet")
    assert 0 < len(files) <= 5 and rows(out) == rows(dealt)
