import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechlens.operators import keywords as K
from speechlens.operators import similarity as M


def weights(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, term string, term_id int, tf long, weight double")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, member_name string, political_party string, "
                                       "sitting_date string, speech string")


def test_keyword_ties_word_desc_then_date_desc(spark):
    w = weights(spark, [
        (1, "apple", 0, 1, 0.5), (1, "pear", 1, 1, 0.5), (1, "fig", 2, 1, 0.2),
        (2, "apple", 0, 1, 0.5), (2, "kiwi", 3, 1, 0.1),
    ])
    d = docs(spark, [(1, "m", "p", "01/02/2000", ""), (2, "m", "p", "05/01/2001", ""),
                     (3, "m", "p", "06/01/2001", "")])
    per_doc = K.keywords_per_doc(w, d, n=2).orderBy("doc_id", "rank").collect()
    assert [(r["doc_id"], r["rank"], r["word"]) for r in per_doc] == [
        (1, 1, "pear"), (1, 2, "apple"), (2, 1, "apple"), (2, 2, "kiwi")]
    per_m = K.keywords_per_member(K.keywords_per_doc(w, d, n=2), d, n=3).orderBy("rank").collect()
    # equal tfidf 0.5: pear > apple (word desc); two apples: date text desc
    assert [(r["word"], r["date"]) for r in per_m] == [
        ("pear", "01/02/2000"), ("apple", "05/01/2001"), ("apple", "01/02/2000")]
    # a speech without terms (doc 3) has no keywords
    assert K.keywords_per_doc(w, d).filter("doc_id = 3").count() == 0


def test_keyword_json_round_trip(spark, tmp_path):
    w = weights(spark, [(1, "apple", 0, 1, 0.5), (1, "pear", 1, 1, 0.25)])
    d = docs(spark, [(1, "m", "p", "01/02/2000", "")])
    pd_ = K.keywords_per_doc(w, d)
    pm, pp = K.keywords_per_member(pd_, d), K.keywords_per_party(pd_, d)
    K.write_keywords_json(pd_, pm, pp, str(tmp_path / "kw"))
    back = K.read_keywords_json(spark, str(tmp_path / "kw")).orderBy("kind", "key", "rank").collect()
    assert [(r["kind"], r["key"], r["rank"], r["word"]) for r in back] == [
        ("member", "m", 1, "apple"), ("member", "m", 2, "pear"),
        ("party", "p", 1, "apple"), ("party", "p", 2, "pear"),
        ("speech", "1", 1, "apple"), ("speech", "1", 2, "pear")]


def test_timeline_keeps_bad_dates_as_null(spark):
    w = weights(spark, [(1, "apple", 0, 1, 0.5)])
    d = docs(spark, [(1, "m", "p", "99/99/1999", "")])
    pd_ = K.keywords_per_doc(w, d)
    tl = K.keyword_timeline(pd_, K.keywords_per_member(pd_, d), K.keywords_per_party(pd_, d)).collect()
    assert len(tl) == 3 and all(r["date"] is None for r in tl)


def member_weights(spark, vectors):
    """One document per member carrying the given vector."""
    rows, drows = [], []
    for i, (name, vec) in enumerate(vectors.items()):
        for t, x in enumerate(vec):
            if x:
                rows.append((i, f"t{t}", t, 1, float(x)))
        drows.append((i, name, "p", "01/01/2000", ""))
    return weights(spark, rows), docs(spark, drows)


def test_threshold_at_above_below_and_zero_vector(spark):
    c = 0.6
    vecs = {
        "a": [1.0, 0.0, 0.0],
        "b": [c, math.sqrt(1 - c * c), 0.0],        # cos(a, b) = 0.6 exactly
        "c": [0.0, 0.0, 1.0],                        # orthogonal to a
        "d": [0.9, math.sqrt(1 - 0.81), 0.0],        # cos(a, d) = 0.9
        "z": [0.0, 0.0, 0.0],                        # zero vector: no pairs
    }
    w, d = member_weights(spark, vecs)
    v = M.member_vectors(w, d)
    pairs = {(r["member_a"], r["member_b"]): r["similarity"] for r in M.similar_pairs(v, None, 0.6).collect()}
    assert pairs[("a", "b")] == pytest.approx(0.6)
    assert pairs[("a", "d")] == pytest.approx(0.9)
    assert ("a", "c") not in pairs and not any("z" in p for p in pairs)
    top1 = M.similar_pairs(v, 1, 0.6).collect()
    # cos(b, d) = 0.6 * 0.9 + 0.8 * sqrt(0.19) ~ 0.8887 < cos(a, d)
    assert [(r["member_a"], r["member_b"], r["similarity"]) for r in top1] == [("a", "d", 0.9)]


def test_member_vector_is_mean_over_all_speeches(spark):
    w = weights(spark, [(1, "x", 0, 1, 1.0)])
    d = docs(spark, [(1, "m", "p", "", ""), (2, "m", "p", "", "")])   # doc 2 has no terms
    got = M.member_vectors(w, d).collect()
    assert [(r["member_name"], r["term"], r["weight"]) for r in got] == [("m", "x", 0.5)]


def test_blocked_pairs_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    n, t = 23, 6
    mat = rng.random((n, t)) * (rng.random((n, t)) < 0.6)
    names = [f"m{i:02d}" for i in range(n)]
    w, d = member_weights(spark, dict(zip(names, mat)))
    v = M.member_vectors(w, d)
    monkeypatch.setattr(M, "BLOCK_CELLS", 4 * t)    # 4 members per block -> 6 blocks
    got = {(r["member_a"], r["member_b"]): r["similarity"] for r in M.similar_pairs(v, None, 0.3).collect()}
    norms = np.linalg.norm(mat, axis=1)
    want = {}
    for i in range(n):
        for j in range(i + 1, n):
            if norms[i] > 0 and norms[j] > 0:
                s = round(float(mat[i] @ mat[j] / (norms[i] * norms[j])), 6)
                if s >= 0.3:
                    want[(names[i], names[j])] = s
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-6)
    top = M.similar_pairs(v, 5, 0.3).collect()
    best = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [(r["member_a"], r["member_b"]) for r in top] == [k for k, _ in best]
    nodes = {r["member_name"]: r["degree"] for r in M.pair_graph_nodes(M.similar_pairs(v, 5, 0.3)).collect()}
    assert sum(nodes.values()) == 10


def test_parameter_checks(spark):
    from speechlens.operators import clusters as CL
    from speechlens.operators import search as S

    w = weights(spark, [(1, "x", 0, 1, 1.0)])
    d = docs(spark, [(1, "m", "p", "", "")])
    with pytest.raises(ValueError):
        M.similar_pairs(M.member_vectors(w, d), k=0)
    with pytest.raises(ValueError):
        S.top_hits(spark.createDataFrame([(1, 1, 0.5)], "query_id long, doc_id long, score double"), k=0)
    assert CL.checked_k(25) == 25
    with pytest.raises(ValueError):
        CL.checked_k(-3)
