"""Physical-plan properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from speechlens.operators import keywords as K
from speechlens.operators import search as S
from speechlens.operators import tfidf as T
from speechlens.plans.workspace import Workspace


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, SF001)


def test_term_counts_need_one_exchange_of_text(ws):
    tf = T.term_frequencies(ws.docs())
    p = plan(tf)
    assert p.count("Exchange") == 1 and "hashpartitioning(doc_id" in p
    assert "partial_count" in p


def test_weights_norm_window_reuses_doc_partitioning(ws):
    m = ws.model()
    w = T.weigh(T.term_frequencies(ws.docs()), m.vocab_side())
    p = plan(w)
    assert p.count("Exchange hashpartitioning") == 1     # only the text repartition
    assert "BroadcastHashJoin" in p


def test_search_of_a_few_terms_pushes_them_into_the_postings_scan(spark, ws):
    m = ws.model()
    words = [r["term"] for r in m.vocabulary.orderBy("term").limit(3).collect()]
    q = spark.createDataFrame([(1, " ".join(words))], "query_id long, text string")
    scans = [x for x in plan(S.score(m, q)).splitlines() if "FileScan" in x and "term" in x]
    assert scans and "PushedFilters: [In(term, [" in scans[0]


def test_batch_search_moves_no_scores_and_reads_no_speech(spark, ws):
    m = ws.model()
    q = ws.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
    p = plan(S.score(m, q))
    assert "Exchange hashpartitioning(query_id" not in p and "BroadcastHashJoin" in p
    hits = plan(S.top_hits(S.score(m, q)))
    assert "WindowGroupLimit" in hits and "Partial" in hits
    assert "CartesianProduct" not in hits and "BroadcastNestedLoopJoin" not in hits
    whole = plan(S.search(m, ws.display(), q))
    assert "speech#" not in whole


def test_search_in_blocks_of_queries_equals_one(spark, ws, monkeypatch):
    m = ws.model()
    q = ws.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
    want = sorted(map(tuple, S.search(m, ws.display(), q).collect()))
    monkeypatch.setattr(S, "BLOCK_ROWS", 20)
    assert sorted(map(tuple, S.search(m, ws.docs(), q).collect())) == want


def test_group_rankings_limit_before_shuffle(ws):
    m = ws.model()
    docs = ws.docs()
    per_member = K.keywords_per_member(K.keywords_per_doc(m.weights, docs), docs)
    p = plan(per_member)
    # the member ranking runs a partial top-10 before its exchange; the
    # per-speech ranking reads weights bucketed by doc_id (no exchange at all)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "Exchange hashpartitioning(doc_id" not in p


def test_no_cartesian_products_anywhere(spark):
    import __spark_entry__ as E

    for name in ["similar_pairs", "member_vectors", "cluster_profile", "keyword_trend", "consolidate"]:
        p = plan(E.queries()[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_written_weights_are_bucketed_by_doc(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"alpha beta w{i % 7} w{i % 3}") for i in range(40)],
                                 "doc_id long, speech string")
    p = str(tmp_path / "model")
    m = T.fit_tfidf(docs, max_df=1.0, max_features=50, path=p, num_partitions=4)
    per_doc = K.keywords_per_doc(m.weights, docs.select("doc_id", F.lit("01/01/2000").alias("sitting_date")))
    plan_text = plan(per_doc)
    # the ranking window over doc_id reads the bucketed weights without an exchange
    window_part = plan_text.split("Window")[1] if "Window" in plan_text else plan_text
    assert "Exchange hashpartitioning(doc_id" not in window_part.split("BroadcastExchange")[0]
    # reloading in the same session re-uses the table; results are unchanged
    again = T.load_tfidf(spark, p)
    assert again.weights.count() == m.weights.count()


def test_bucketed_weights_registered_again_from_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"gamma delta w{i % 5}") for i in range(30)],
                                 "doc_id long, speech string")
    p = str(tmp_path / "model")
    m = T.fit_tfidf(docs, max_df=1.0, max_features=20, path=p, num_partitions=3)
    want = sorted(map(tuple, m.weights.collect()))
    # a new process has the files but not the catalog entry (external table: files stay)
    spark.sql(f"DROP TABLE IF EXISTS {T._weights_table(p)}")
    again = T.load_tfidf(spark, p)
    assert sorted(map(tuple, again.weights.collect())) == want
    packed = again.weights.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange hashpartitioning(doc_id" not in plan(packed)
