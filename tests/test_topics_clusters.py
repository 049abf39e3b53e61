import numpy as np
import pytest
from pyspark.sql import functions as F

from speechlens.operators import clusters as CL
from speechlens.operators import topics as TP


def matrix_weights(spark, a):
    rows = [(int(i), f"t{j}", int(j), 1, float(a[i, j])) for i in range(a.shape[0])
            for j in range(a.shape[1]) if a[i, j] != 0]
    return spark.createDataFrame(rows, "doc_id long, term string, term_id int, tf long, weight double")


def test_rank_two_matrix(spark):
    rng = np.random.default_rng(0)
    a = rng.random((6, 2)) @ rng.random((2, 4))      # 6 x 4, rank 2
    w = matrix_weights(spark, a)
    lsa = TP.fit_lsa(w, 4, k=10)
    s = np.linalg.svd(a, compute_uv=False)
    assert len(lsa.singular_values) == 2               # fewer components than asked
    assert np.allclose(lsa.singular_values, s[:2], atol=1e-9)
    v = lsa.components
    assert np.allclose(v @ v.T, np.eye(2), atol=1e-9)  # orthonormal
    for row in v:                                       # sign rule
        assert row[np.argmax(np.abs(row))] > 0
    # A V = U S, and reconstruction from rank 2 is exact
    us = TP.doc_topics(lsa, w).orderBy("doc_id").collect()
    us = np.array([r["topic"] for r in us])
    assert np.allclose(us @ v, a, atol=1e-9)


def test_matches_numpy_on_random_sparse(spark):
    rng = np.random.default_rng(1)
    a = rng.random((40, 30)) * (rng.random((40, 30)) < 0.3)
    w = matrix_weights(spark, a)
    lsa = TP.fit_lsa(w, 30, k=5)
    u, s, vt = np.linalg.svd(a)
    assert np.allclose(lsa.singular_values, s[:5], atol=1e-8)
    vt = vt[:5]
    vt *= np.sign(vt[np.arange(5), np.argmax(np.abs(vt), axis=1)])[:, None]
    assert np.allclose(lsa.components, vt, atol=1e-6)


def test_topics_top_terms(spark):
    a = np.array([[3.0, 1.0, 0.0], [3.0, 1.0, 0.0], [0.0, 0.0, 2.0]])
    w = matrix_weights(spark, a)
    lsa = TP.fit_lsa(w, 3, k=2)
    vocab = spark.createDataFrame([(0, "t0"), (1, "t1"), (2, "t2")], "term_id int, term string")
    top = TP.topics(lsa, vocab, n_terms=1).orderBy("topic_id").collect()
    assert [r["term"] for r in top] == ["t0", "t2"]


def test_assign_to_centres_nearest_and_ties(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [10.0, 10.0]), (3, [5.0, 5.0])], "id long, v array<double>")
    out = {r["id"]: r["cluster_id"] for r in CL.assign_to_centres(df, "v", [[0.0, 0.0], [10.0, 10.0]]).collect()}
    assert out == {1: 0, 2: 1, 3: 0}                  # tie goes to the smaller id


def test_kmeans_more_clusters_than_points(spark):
    vecs = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(9)], "doc_id long, topic array<double>")
    assigned, centres = CL.fit_clusters(vecs, k=5)
    rows = assigned.collect()
    assert len(rows) == 9
    by = {}
    for r in rows:
        by.setdefault(r["cluster_id"], set()).add(r["doc_id"])
    assert by[0] == {0, 3, 6}                          # cluster 0 holds the smallest doc_id
    docs = spark.createDataFrame([(i, f"s{i}") for i in range(9)], "doc_id long, speech string")
    ex = CL.cluster_examples(assigned, docs, 5, n=2).collect()
    assert {r["cluster_id"] for r in ex} == set(range(5))       # empty clusters listed
    assert sum(1 for r in ex if r["size"] == 0) == 2
    assert CL.checked_k(50) == 50
    with pytest.raises(ValueError):
        CL.checked_k(0)


def test_examples_do_not_move_speeches(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("speech "), F.col("id").cast("string")).alias("speech")).write.parquet(
        str(tmp_path / "docs"))
    assigned = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("cluster_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ex = CL.cluster_examples(assigned, spark.read.parquet(str(tmp_path / "docs")), 3, n=2)
        joins = [x for x in ex._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin [doc_id" in x]
        assert len(joins) == 1
        assert {(r["cluster_id"], r["doc_id"], r["speech"]) for r in ex.collect()} == {
            (i % 3, i, f"speech {i}") for i in range(6)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cluster_profile_cohesion(spark):
    w = spark.createDataFrame([(1, "a", 0, 1, 1.0), (2, "b", 1, 1, 1.0)],
                              "doc_id long, term string, term_id int, tf long, weight double")
    assign = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, cluster_id int")
    prof = {r["cluster_id"]: (r["n_docs"], r["cohesion"]) for r in CL.cluster_profile(w, assign).collect()}
    # centroid (0.5, 0.5): cos with each doc = 1/sqrt(2); doc 3 has no terms
    assert prof[0] == (2, pytest.approx(round(1 / np.sqrt(2), 6)))
    assert prof[1] == (1, 0.0)


def test_a_pass_takes_some_entries_at_a_time(spark, monkeypatch):
    """Documents longer than a cut, of one term and without terms."""
    monkeypatch.setattr(TP, "PASS_ENTRIES", 7)
    rng = np.random.default_rng(8)
    a = rng.random((50, 30)) * (rng.random((50, 30)) < 0.3)
    a[3] = rng.random(30)
    a[4] = a[5] = 0
    a[5, 2] = 1.5
    rows = [(i, [int(t) for t in np.nonzero(x)[0]], [float(v) for v in x[x != 0]]) for i, x in enumerate(a)]
    packed = spark.createDataFrame(rows, "doc_id long, term_ids array<int>, values array<double>").coalesce(2)
    q = rng.standard_normal((30, 4))
    assert np.allclose(TP._gram_pass(packed, q), a.T @ (a @ q), atol=1e-10)
