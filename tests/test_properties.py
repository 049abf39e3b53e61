"""Properties over the real test tables."""

from pyspark.sql import functions as F

from conftest import SF001
from speechlens.operators import search as S
from speechlens.operators import similarity as M
from speechlens.plans.workspace import Workspace


def test_own_text_ranks_itself_or_a_copy_first(spark):
    ws = Workspace(spark, SF001)
    m, docs = ws.model(), ws.docs()
    has_terms = m.weights.select("doc_id").distinct()
    sample = (docs.join(has_terms, "doc_id", "left_semi")
              .select(F.col("doc_id").alias("query_id"), F.col("speech").alias("text"))
              .orderBy("query_id").limit(25))
    hits = S.search(m, docs, sample, k=1).collect()
    texts = {r["doc_id"]: r["speech"] for r in docs.select("doc_id", "speech").collect()}
    assert len(hits) == 25
    for h in hits:
        assert h["score"] == 1.0
        # the first hit is the document itself or an exact copy of its text
        assert texts[h["doc_id"]] == texts[h["query_id"]]


def test_pair_similarities_bounded_and_oriented(spark):
    ws = Workspace(spark, SF001)
    v = M.member_vectors(ws.model().weights, ws.docs())
    pairs = M.similar_pairs(v, None, 0.0).collect()
    assert pairs
    assert all(0.0 <= p["similarity"] <= 1.0 for p in pairs)
    assert all(p["member_a"] < p["member_b"] for p in pairs)
    assert len({(p["member_a"], p["member_b"]) for p in pairs}) == len(pairs)


def test_weights_have_unit_norm(spark):
    ws = Workspace(spark, SF001)
    norms = ws.model().weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert norms and all(abs(r["n2"] - 1.0) < 1e-9 for r in norms)
