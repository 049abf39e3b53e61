"""The SVD with its basis in Spark against numpy."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechlens.operators import topics as TP
from speechlens.operators import wide_topics as W


def table(spark, a):
    d, t = np.nonzero(a)
    rows = [(int(i), int(j), float(a[i, j])) for i, j in zip(d, t)]
    return spark.createDataFrame(rows, "doc_id long, term_id int, weight double").repartition(3)


def dense(model, n_terms):
    v = np.zeros((n_terms, len(model.singular_values)))
    for r in model.components.collect():
        v[r["term_id"]] = r["loadings"]
    return v


def check(model, a, k):
    s = np.linalg.svd(a, compute_uv=False)[:k]
    assert np.allclose(model.singular_values, s, atol=1e-8)
    v = dense(model, a.shape[1])
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-8)
    assert np.allclose(a.T @ (a @ v), v * s ** 2, atol=1e-7)
    assert (v[np.abs(v).argmax(axis=0), np.arange(k)] > 0).all()


def test_equal_to_numpy_and_to_the_narrow_fit(spark, monkeypatch):
    monkeypatch.setattr(W, "TASK_ROWS", 10)   # several blocks and a tree of factors
    rng = np.random.default_rng(3)
    a = rng.random((60, 100)) * (rng.random((60, 100)) < 0.2)
    wide = W.fit_lsa_wide(table(spark, a), k=4, oversamples=4)
    check(wide, a, 4)
    narrow = TP.fit_lsa(table(spark, a), 100, k=4)
    assert np.allclose(np.abs(dense(wide, 100)), np.abs(narrow.components.T), atol=1e-6)


def test_300_000_terms(spark):
    """A vocabulary that the driver-side fit leaves to this one."""
    rng = np.random.default_rng(4)
    n_docs, n_terms, k = 120, 300_000, 3
    themes = [rng.choice(n_terms, 2500, replace=False) for _ in range(3)]
    rows = {}
    for d in range(n_docs):
        for t in [*rng.choice(themes[d % 3], 250, replace=False), *rng.choice(n_terms, 40)]:
            rows[d, int(t)] = rng.random() + 0.5 * (d % 3 == 0)
    w = spark.createDataFrame([(d, t, x) for (d, t), x in rows.items()] + [(0, n_terms - 1, 0.1)],
                              "doc_id long, term_id int, weight double").repartition(4)
    model = TP.fit_lsa(w, n_terms, k=k)
    assert isinstance(model, W.WideLsa)
    gram = np.zeros((n_docs, n_docs))
    by = {}
    for (d, t), x in [*rows.items(), ((0, n_terms - 1), 0.1)]:
        by.setdefault(t, []).append((d, x)) if (d, t) != (0, n_terms - 1) or t not in by else None
    for cells in by.values():
        for d, x in cells:
            for e, y in cells:
                gram[d, e] += x * y
    assert np.allclose(model.singular_values, np.sqrt(np.linalg.eigvalsh(gram)[::-1][:k]), atol=1e-6)
    vocabulary = spark.range(n_terms).select(F.col("id").cast("int").alias("term_id"), F.concat(F.lit("w"), "id").alias("term"))
    top = TP.topics(model, vocabulary, 10).collect()
    assert len(top) == 10 * k
    values = TP.doc_topics(model, w).collect()
    s = np.sqrt(sum(np.square(r["topic"]) for r in values))
    assert np.allclose(s, model.singular_values, atol=1e-6)


@pytest.mark.parametrize("rank", [1, 2])
def test_low_rank_and_empty(spark, rank):
    rng = np.random.default_rng(rank)
    a = rng.random((12, rank)) @ rng.random((rank, 9))
    model = W.fit_lsa_wide(table(spark, a), k=4)
    assert np.allclose(model.singular_values, np.linalg.svd(a, compute_uv=False)[:rank], atol=1e-8)
    assert dense(model, 9).shape == (9, rank)
    none = W.fit_lsa_wide(spark.createDataFrame([], "doc_id long, term_id int, weight double"), k=2)
    assert len(none.singular_values) == 0 and none.components.count() == 0


def test_disk_does_not_grow_with_the_passes(spark):
    """Neither a row for each weight nor the basis of every pass stays on disk."""
    a = np.random.default_rng(5).random((300, 400))
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def on_disk():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)

    given = table(spark, a).cache()
    given.count()
    before = on_disk()
    model = W.fit_lsa_wide(given, k=10, n_iter=8, tol=0)
    assert model.n_iter == 8
    # the basis of 160 columns alone has 400 KB
    assert on_disk() - before < 500_000
    assert not os.path.isdir(f"{top}/speechlens-scratch") or not [x for x in os.listdir(f"{top}/speechlens-scratch") if "basis" in x or "blocks" in x]


def test_terms_of_one_block_are_not_sent(spark, tmp_path):
    own = spark.createDataFrame([(d, t, 1.0) for d in range(40) for t in (0, 1, 100 + d)], "doc_id long, term_id int, weight double")
    blocks = W._blocks(own, 4, f"{tmp_path}/blocks-0a1b")
    rows = blocks.select("n_sent", F.length("terms")).collect()
    assert [r[0] for r in rows] == [2] * 4 and sum(r[1] for r in rows) == 4 * (4 * 2 + 40)
    q = spark.createDataFrame([(d, [float(d), 1.0]) for d in range(40)], "doc_id long, q array<double>")
    got = {r["doc_id"]: r["z"] for r in W._multiplied(blocks, q, 4, 2).collect()}
    s = sum(range(40))
    assert got == {d: [2.0 * s + d, 2.0 * 40 + 1] for d in range(40)}
    spark.sql(f"DROP TABLE {W._table_of(f'{tmp_path}/blocks-0a1b')}")


def test_columns_and_terms_at_a_time(spark, monkeypatch):
    """The numbers under way are sent in parts, and the basis is kept once and not shuffled."""
    monkeypatch.setattr(W, "TASK_ROWS", 12)
    monkeypatch.setattr(W, "SENT_LEAST", 0)
    monkeypatch.setattr(W, "SENT_BYTES", 10)
    seen, plans, product, beside = [], [], W._product, W._beside
    monkeypatch.setattr(W, "_product", lambda blocks, q, n, columns, width: seen.append(columns) or product(blocks, q, n, columns, width))
    monkeypatch.setattr(W, "_beside", lambda tables: plans.append(beside(tables)) or plans[-1])
    rng = np.random.default_rng(6)
    a = rng.random((50, 4)) @ rng.random((4, 80))   # of low rank: two passes
    model = W.fit_lsa_wide(table(spark, a), k=3, oversamples=3)
    check(model, a, 3)
    assert len(seen) > model.n_iter and max(c.stop - c.start for c in seen) < 6
    assert not any("Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in plans[:3])


def test_weights_given_as_factors(spark):
    rng = np.random.default_rng(7)
    counts = np.floor(rng.random((40, 60)) * 300 * (rng.random((40, 60)) < 0.3))
    of_term, of_doc = rng.random(60) + 1, rng.random(40) + 1
    a = counts * of_term / of_doc[:, None]
    rows = [(int(i), int(j), float(a[i, j]), float(counts[i, j]), float(of_term[j]), float(of_doc[i])) for i, j in zip(*np.nonzero(a))]
    given = spark.createDataFrame([*rows, (None, 60, 1.0, 1.0, 1.0, 1.0)],
                                  "doc_id long, term_id int, product double, weight double, term_scale double, doc_scale double")
    model = W.fit_lsa_wide(given.select("doc_id", "term_id", F.col("product").alias("weight")), k=4, factors=given)
    assert np.allclose(model.singular_values, np.linalg.svd(a, compute_uv=False)[:4], atol=1e-8 * a.max())
    v = dense(model, 61)
    assert np.allclose(v.T @ v, np.eye(4), atol=1e-8) and not v[60].any()
    assert np.allclose((a.T @ (a @ v[:60])) / model.singular_values ** 2, v[:60], atol=1e-7)
