"""Latent topics: uncentred truncated SVD of the TF-IDF matrix (LSA).

``A (docs x terms) ~ U S V^T`` with rank k (10). Topics are the columns of V
(top terms by signed loading); documents in topic space are ``U S = A V``.

The fit is a randomized block Krylov method on the term side (Halko,
Martinsson and Tropp, 2011; Musco and Musco, 2015): from a seeded Gaussian
block (terms x (k + oversampling)), each pass multiplies the newest block by
``A^T A``, and Rayleigh-Ritz on the whole Krylov basis gives the leading
singular pairs, until their residuals vanish (at most `n_iter` passes, as
in the reference's 100 power iterations). One pass is one Spark job:

* rows of A are packed once per document (a bounded list: at most the
  vocabulary size) and checkpointed to the shared folder;
* `mapInArrow` computes, per partition, ``sum_d a_d^T (a_d Q)`` — a
  (terms x l) partial — with numpy over Arrow batches;
* partials are summed by a grouped aggregate on `term_id`; only
  (terms x l) numbers reach the driver, where the orthogonalisation and the
  small Rayleigh-Ritz eigenproblem run.

Signs are fixed so that the largest-magnitude loading of every component is
positive; the document side then follows from ``A V``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sizing import local_frame
from ..session import durable
from ..schema import SCORE_DIGITS

N_COMPONENTS = 10
N_ITER = 100
OVERSAMPLES = 10
SEED = 42
TOL = 1e-10
# the driver holds (terms x l) matrices; wider vocabularies are fitted by `wide_topics`
MAX_TERMS = 200_000
# matrix entries that a pass multiplies at a time
PASS_ENTRIES = 65_536


@dataclass
class LsaModel:
    singular_values: np.ndarray      # (k,)
    components: np.ndarray           # (k, n_terms): rows of V^T, term_id order
    n_iter: int

    def components_frame(self, spark: SparkSession) -> DataFrame:
        k, n = self.components.shape
        rows = [(int(t), [float(x) for x in self.components[:, t]]) for t in range(n)]
        return local_frame(spark, rows, "term_id int, loadings array<double>")


def packed_rows(weights: DataFrame) -> DataFrame:
    """One row per document: (doc_id, term_ids, values); checkpointed."""
    g = weights.groupBy("doc_id").agg(F.collect_list(F.struct("term_id", "weight")).alias("e"))
    g = g.select("doc_id", F.col("e.term_id").alias("term_ids"), F.col("e.weight").alias("values"))
    return durable(g)


def _gram_pass(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """Z = A^T A Q, summed over all documents."""
    spark = rows.sparkSession
    n_terms, l = q.shape
    bq = spark.sparkContext.broadcast(q)
    cols = [f"c{j}" for j in range(l)]
    schema = "term_id int, " + ", ".join(f"{c} double" for c in cols)

    def part(batches):
        qm = np.ascontiguousarray(bq.value.T)
        acc = np.zeros_like(qm)
        touched = np.zeros(qm.shape[1], dtype=bool)
        for batch in batches:
            # a document's entries are contiguous in the flat lists
            lens = batch.column(1).value_lengths().fill_null(0).to_numpy()
            lens = lens[lens > 0].astype(np.int64)
            if not len(lens):
                continue
            t = batch.column(1).flatten().to_numpy().astype(np.int64)
            w = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lens)
            # some documents at a time and column by column, so that what is computed stays in the cache
            cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], PASS_ENTRIES), "right"), len(lens)))
            for a, b in zip(cuts[:-1], cuts[1:]):
                lo, hi = ends[a] - lens[a], ends[b - 1]
                ti, wi, starts = t[lo:hi], w[lo:hi], ends[a:b] - lens[a:b] - lo
                doc = np.repeat(np.arange(b - a), lens[a:b])
                for j, column in enumerate(qm):
                    y = np.add.reduceat(wi * column[ti], starts)      # y_d = a_d Q
                    acc[j] += np.bincount(ti, wi * y[doc], minlength=len(column))
            touched[t] = True
        idx = np.nonzero(touched)[0]
        yield pa.RecordBatch.from_arrays([pa.array(idx.astype(np.int32)), *(pa.array(acc[j, idx]) for j in range(len(cols)))],
                                         names=["term_id", *cols])

    partial = rows.mapInArrow(part, schema)
    z = np.zeros_like(q)
    summed = partial.groupBy("term_id").agg(*[F.sum(c).alias(c) for c in cols]).toPandas()
    z[summed["term_id"].to_numpy()] = summed[cols].to_numpy()
    bq.unpersist()
    return z


def _orthonormal_block(z: np.ndarray, basis: list[np.ndarray], eps: float = 1e-10) -> np.ndarray:
    """Columns of z made orthogonal to all basis blocks (twice, for stability)
    and to each other; columns that vanish are dropped."""
    for _ in range(2):
        for b in basis:
            z = z - b @ (b.T @ z)
    q, r = np.linalg.qr(z)
    keep = np.abs(np.diag(r)) > eps * max(1.0, np.abs(r).max(initial=0.0))
    return q[:, keep]


def fit_lsa(weights: DataFrame, n_terms: int, k: int = N_COMPONENTS, n_iter: int = N_ITER,
            seed: int = SEED, oversamples: int = OVERSAMPLES, tol: float = TOL,
            rows: DataFrame | None = None, max_blocks: int = 30) -> LsaModel:
    """Top-k right singular vectors and singular values of the weights matrix.

    Block Krylov iteration on ``A^T A``: every pass multiplies the newest
    orthonormal block by ``A^T A`` (one Spark job); the driver keeps the
    basis K and the products ``A^T A K``, so Rayleigh-Ritz values and exact
    residuals ``||A^T A v - l v||`` come without extra passes. It stops when
    every residual of the k leading pairs is below ``tol * l_1``; if the
    basis grows past `max_blocks` blocks it restarts from the current leading
    Ritz vectors.
    """
    if n_terms > MAX_TERMS:
        from .wide_topics import fit_lsa_wide

        return fit_lsa_wide(weights, k, n_iter, seed, oversamples, tol, max_blocks)
    rows = rows if rows is not None else packed_rows(weights)
    b = min(n_terms, k + oversamples)
    rng = np.random.default_rng(seed)
    block, _ = np.linalg.qr(rng.standard_normal((n_terms, b)))
    basis: list[np.ndarray] = []
    products: list[np.ndarray] = []
    evals = vk = None
    passes = 0
    while passes < max(1, n_iter):
        z = _gram_pass(rows, block)
        passes += 1
        basis.append(block)
        products.append(z)
        kb = np.hstack(basis)
        zb = np.hstack(products)
        t = kb.T @ zb
        t = (t + t.T) / 2
        evals, evecs = np.linalg.eigh(t)
        order = np.argsort(evals)[::-1]
        evals, evecs = evals[order], evecs[:, order]
        kk = min(k, evecs.shape[1])
        vk = kb @ evecs[:, :kk]
        resid = np.linalg.norm(zb @ evecs[:, :kk] - vk * evals[:kk], axis=0)
        top = max(float(evals[0]), 1e-300)
        nxt = _orthonormal_block(z, basis)
        if kk == k and np.all(resid <= tol * top):
            break
        if nxt.shape[1] == 0:
            break  # invariant subspace: the Krylov space is exhausted
        if len(basis) >= max_blocks:
            # restart from the leading Ritz vectors (their products are known)
            keep = min(b, evecs.shape[1])
            basis = [kb @ evecs[:, :keep]]
            products = [zb @ evecs[:, :keep]]
            nxt = _orthonormal_block(products[0], basis)
            if nxt.shape[1] == 0:
                break
        block = nxt
    kk = min(k, len(evals))
    rank = int(np.sum(evals[:kk] > 1e-12 * max(evals[0], 1e-300)))
    sv = np.sqrt(np.clip(evals[:rank], 0, None))
    comps = vk[:, :rank].T.copy()
    # sign: largest-magnitude loading of each component positive
    pivot = np.argmax(np.abs(comps), axis=1)
    signs = np.sign(comps[np.arange(rank), pivot])
    signs[signs == 0] = 1
    comps *= signs[:, None]
    return LsaModel(sv, comps, passes)


def singular_values_frame(spark: SparkSession, model: LsaModel) -> DataFrame:
    rows = [(i, float(round(s, SCORE_DIGITS))) for i, s in enumerate(model.singular_values)]
    return local_frame(spark, rows, "component int, singular_value double")


def topics(model: LsaModel, vocabulary: DataFrame, n_terms: int = 10) -> DataFrame:
    """(topic_id, rank, term, loading): top terms of each component by signed loading."""
    spark = vocabulary.sparkSession
    comp = model.components_frame(spark)
    long = comp.select("term_id", F.posexplode("loadings").alias("topic_id", "loading"))
    names = vocabulary.select("term_id", "term")
    named = long.join(names if getattr(model, "wide", False) else F.broadcast(names), "term_id")
    order = Window.partitionBy("topic_id").orderBy(F.desc(F.round("loading", SCORE_DIGITS)),
                                                   F.asc("term"))
    top = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_terms)
    return top.select(F.col("topic_id").cast("int"), F.col("rank").cast("int"), "term",
                      F.round("loading", SCORE_DIGITS).alias("loading"))


def doc_topics(model: LsaModel, weights: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, topic) with `topic` = the document's row of U S = A V, as an
    array<double>; documents without vocabulary terms get a zero vector."""
    spark = weights.sparkSession
    k = len(model.singular_values)
    comp = model.components_frame(spark)
    if not getattr(model, "wide", False):
        comp = F.broadcast(comp)   # bounded: vocabulary x k
    j = weights.select("doc_id", "term_id", "weight").join(comp, "term_id")
    sums = j.groupBy("doc_id").agg(
        *[F.sum(F.col("weight") * F.col("loadings")[i]).alias(f"t{i}") for i in range(k)])
    vec = sums.select("doc_id", F.array(*[F.col(f"t{i}") for i in range(k)]).alias("topic"))
    if docs is not None:
        zero = F.array(*[F.lit(0.0) for _ in range(k)])
        vec = docs.select("doc_id").join(vec, "doc_id", "left").select(
            "doc_id", F.coalesce(F.col("topic"), zero).alias("topic"))
    return vec


def doc_topics_long(vectors: DataFrame) -> DataFrame:
    """(doc_id, topic_id, value) long form of `doc_topics`."""
    return vectors.select("doc_id", F.posexplode("topic").alias("topic_id", "value")).select(
        "doc_id", F.col("topic_id").cast("int"), F.round("value", SCORE_DIGITS).alias("value"))
