from speechlens.operators import search as S
from speechlens.operators import tfidf as T
from speechlens.streaming import search_stream as ST


def test_stream_of_queries_equals_batch(spark, plain, tmp_path):
    docs = spark.createDataFrame(
        [(0, "tax budget tax", "en", "m1", "01/01/2000"), (1, "budget vote", "en", "m2", "02/01/2000"),
         (2, "fishing quotas", "fr", "m3", "03/01/2000")],
        "doc_id long, speech string, political_party string, member_name string, sitting_date string")
    m = T.fit_tfidf(docs, max_df=1.0, max_features=None, options=plain)
    src = str(tmp_path / "queries")
    spark.createDataFrame([(1, "tax"), (2, "budget")], "query_id long, text string").write.parquet(src + "/a")
    spark.createDataFrame([(3, "fishing vote")], "query_id long, text string").write.parquet(src + "/b")
    sink = str(tmp_path / "hits")
    q = ST.start_search_stream(ST.query_stream(spark, src + "/*", 1), m, docs, sink,
                               str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination()
    got = sorted(tuple(r) for r in ST.read_stream_hits(spark, sink).drop("epoch").collect())
    allq = spark.createDataFrame([(1, "tax"), (2, "budget"), (3, "fishing vote")], "query_id long, text string")
    want = sorted(tuple(r) for r in S.search(m, docs, allq).collect())
    assert got == want and len(got) > 0
    # a restart with the same checkpoint finds nothing new and leaves the sink as it is
    q2 = ST.start_search_stream(ST.query_stream(spark, src + "/*", 1), m, docs, sink,
                                str(tmp_path / "ckpt"), available_now=True)
    q2.awaitTermination()
    assert sorted(tuple(r) for r in ST.read_stream_hits(spark, sink).drop("epoch").collect()) == want
