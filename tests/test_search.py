import pytest

from speechlens.operators import search as S
from speechlens.operators import tfidf as T
from speechlens.schema import HITS


def corpus(spark):
    rows = [
        (0, "tax budget tax", "en", "m1", "01/01/2000"),
        (1, "budget vote", "en", "m2", "02/01/2000"),
        (2, "tax budget tax", "de", "m3", "03/01/2000"),   # exact copy of doc 0
        (3, "fishing quotas north sea", "fr", "m1", "04/01/2000"),
        (4, "one two three four five six seven eight nine ten eleven", "en", "m2", "05/01/2000"),
    ]
    return spark.createDataFrame(rows, "doc_id long, speech string, political_party string, "
                                       "member_name string, sitting_date string")


@pytest.fixture(scope="module")
def fitted(spark, plain):
    d = corpus(spark)
    return d, T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain)


def test_query_equal_to_a_document_ranks_it_first(spark, fitted):
    d, m = fitted
    hits = S.search_text(spark, m, d, "tax budget tax").collect()
    # docs 0 and 2 are identical: tied at score 1, ordered by doc_id
    assert [(h["doc_id"], h["score"]) for h in hits[:2]] == [(0, 1.0), (2, 1.0)]
    assert [h["rank"] for h in hits] == list(range(1, len(hits) + 1))
    assert hits[0]["name"] == "m1" and hits[0]["political_party"] == "en"
    assert hits[0]["date"] == "01/01/2000" and hits[0]["speech_start"] == "tax budget tax"
    assert hits[-1]["doc_id"] == 1


def test_empty_and_unknown_queries(spark, fitted):
    d, m = fitted
    assert S.search_text(spark, m, d, "").count() == 0
    assert S.search_text(spark, m, d, "   ").schema == HITS
    assert S.search_text(spark, m, d, "zebra").count() == 0


def test_top_k_and_floor(spark, fitted):
    d, m = fitted
    one = S.search_text(spark, m, d, "budget", k=1).collect()
    assert len(one) == 1
    none = S.search_text(spark, m, d, "budget", floor=1.01).collect()
    assert none == []


def test_snippet_in_hits(spark, fitted):
    d, m = fitted
    hit = S.search_text(spark, m, d, "eleven").collect()[0]
    assert hit["speech_start"] == "one two three four five six seven eight nine ten..."


def test_batch_equals_single_queries(spark, fitted):
    d, m = fitted
    q = spark.createDataFrame([(1, "tax"), (2, "fishing sea"), (3, "vote budget")],
                              "query_id long, text string")
    batch = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in S.search(m, d, q).collect())
    single = []
    for qid, text in [(1, "tax"), (2, "fishing sea"), (3, "vote budget")]:
        for r in S.search_text(spark, m, d, text).collect():
            single.append((qid, r["rank"], r["doc_id"], r["score"]))
    assert batch == sorted(single)


def test_fetch_hits_and_suggest(spark, fitted):
    d, m = fitted
    hits = S.search_text(spark, m, d, "fishing")
    full = S.fetch_hits(hits, d).collect()
    assert [r["doc_id"] for r in full] == [3]
    sug = [r["term"] for r in S.suggest_terms(m, "TA", 5).collect()]
    assert sug == ["tax", "quotas"]
