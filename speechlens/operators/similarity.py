"""Member feature vectors, most similar member pairs, and their graph.

A member's vector is the mean TF-IDF vector of all of the member's speeches
(speeches without vocabulary terms count as zero vectors). Pairs (a, b) with
a < b are scored by cosine; those at or above the threshold are kept, and
the k most similar are returned (ties: a, then b).

Plan: member vectors come from one partially aggregated `groupBy(member,
term)`, so a member with a third of all speeches still sends one row per
term per map partition. Pairs are not produced by a self-join on term (that
emits every pair of members sharing a frequent term). Each block of members
is replicated to the block pairs it takes part in, and one task per
block pair computes the dense product with numpy, emitting only pairs that
pass the threshold and can still reach the top k. Members are hashed into
blocks sized to fit a dense block in memory, so no global numbering is needed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import maybe_broadcast
from ..session import durable
from ..schema import MEMBER, SCORE_DIGITS

SIMILARITY_THRESHOLD = 0.6
TOP_PAIRS = 10
# dense cells (members x terms) of one block; two blocks per task
BLOCK_CELLS = 4_000_000
# members of a block below which more blocks only mean more copies of vectors
LEAST_BLOCK = 64
# slack kept around the k-th local score so rounding cannot change the top k
_RANK_SLACK = 1e-6

PAIR_SCHEMA = "member_a string, member_b string, similarity double"


def member_vectors(weights: DataFrame, docs: DataFrame, member_col: str = MEMBER) -> DataFrame:
    """(member_name, term, term_id, weight): mean weight over the member's speeches."""
    members = docs.select("doc_id", F.col(member_col).alias("member_name")).filter(
        F.col("member_name").isNotNull())
    counts = members.groupBy("member_name").agg(F.count(F.lit(1)).alias("n_docs"))
    sums = (weights.select("doc_id", "term", "term_id", "weight").join(members, "doc_id")
            .groupBy("member_name", "term", "term_id").agg(F.sum("weight").alias("s")))
    counts_side, _ = maybe_broadcast(counts)
    return sums.join(counts_side, "member_name").select(
        "member_name", "term", "term_id", (F.col("s") / F.col("n_docs")).alias("weight"))


def _unit_vectors(vectors: DataFrame) -> DataFrame:
    norms = vectors.groupBy("member_name").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("nrm"))
    norms = norms.filter(F.col("nrm") > 0)
    return vectors.join(norms, "member_name").select(
        "member_name", "term_id", (F.col("weight") / F.col("nrm")).alias("u"))


def _pair_block_fn(n_terms: int, threshold: float, k: int | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])

        def dense(part):
            names, inv = np.unique(part["member_name"].to_numpy().astype(str), return_inverse=True)
            mat = np.zeros((len(names), n_terms))
            np.add.at(mat, (inv, part["term_id"].to_numpy()), part["u"].to_numpy())
            return names, mat

        ln, lm = dense(pdf[pdf["block"] == bi])
        rn, rm = (ln, lm) if bi == bj else dense(pdf[pdf["block"] == bj])
        sims = lm @ rm.T
        a_idx, b_idx = np.nonzero(sims >= threshold - _RANK_SLACK)
        if bi == bj:
            keep = a_idx < b_idx            # names are sorted: one orientation, no self pairs
            a_idx, b_idx = a_idx[keep], b_idx[keep]
        vals = sims[a_idx, b_idx]
        if k is not None and len(vals) > k:
            kth = np.partition(vals, len(vals) - k)[len(vals) - k]
            sel = vals >= kth - _RANK_SLACK
            a_idx, b_idx, vals = a_idx[sel], b_idx[sel], vals[sel]
        a, b = ln[a_idx], rn[b_idx]
        first = np.where(a < b, a, b)       # orient every pair as (smaller, larger) name
        second = np.where(a < b, b, a)
        return pd.DataFrame({"member_a": first, "member_b": second, "similarity": vals})

    return run


def similar_pairs(vectors: DataFrame, k: int | None = TOP_PAIRS,
                  threshold: float = SIMILARITY_THRESHOLD, n_blocks: int | None = None) -> DataFrame:
    """(member_a, member_b, similarity) with a < b and rounded similarity >=
    threshold; the k best (all of them if k is None)."""
    if k is not None and int(k) < 1:
        raise ValueError("k must be at least 1 (or None for every pair above the threshold)")
    # unit vectors are (members x vocabulary) at most: computed once from the
    # weights and checkpointed, instead of once per action below
    unit = durable(_unit_vectors(vectors))
    stats = unit.agg(F.countDistinct("member_name").alias("m"), F.max("term_id").alias("t")).first()
    n_members = int(stats["m"] or 0)
    if n_members < 2:
        return vectors.sparkSession.createDataFrame([], PAIR_SCHEMA)
    n_terms = int(stats["t"]) + 1
    per_block = max(1, min(n_members, BLOCK_CELLS // max(1, n_terms)))
    # blocks that fit in memory, and as many block pairs as cores while a block has
    # enough members to be worth its copies
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    wanted = min(int(math.ceil(math.sqrt(2 * cores))), int(math.ceil(n_members / LEAST_BLOCK)))
    n_blocks = n_blocks or max(int(math.ceil(n_members / per_block)), wanted)
    # members are hashed into blocks; each unordered pair of members meets in
    # exactly one block pair (min(block), max(block))
    rows = unit.withColumn("block", F.pmod(F.xxhash64("member_name"), F.lit(n_blocks)).cast("int"))
    others = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    pairs = F.transform(others, lambda j: F.struct(
        F.least(F.col("block"), j).alias("bi"), F.greatest(F.col("block"), j).alias("bj")))
    rep = rows.select("*", F.explode(pairs).alias("p")).select(
        "member_name", "term_id", "u", "block", "p.bi", "p.bj")
    fn = _pair_block_fn(n_terms, threshold, k)
    cand = rep.groupBy("bi", "bj").applyInPandas(fn, PAIR_SCHEMA)
    cand = cand.withColumn("similarity", F.round("similarity", SCORE_DIGITS)).filter(
        F.col("similarity") >= threshold)
    ordered = cand.orderBy(F.desc("similarity"), "member_a", "member_b")
    return ordered.limit(k) if k is not None else ordered


def pair_graph_nodes(pairs: DataFrame) -> DataFrame:
    """(member_name, degree): nodes of the undirected graph of the pairs."""
    ends = pairs.select(F.explode(F.array("member_a", "member_b")).alias("member_name"))
    return ends.groupBy("member_name").agg(F.count(F.lit(1)).cast("long").alias("degree"))


def pair_graph_edges(pairs: DataFrame) -> DataFrame:
    """Adjacency in long form: (member_name, neighbour, similarity), both directions."""
    a = pairs.select(F.col("member_a").alias("member_name"), F.col("member_b").alias("neighbour"),
                     "similarity")
    b = pairs.select(F.col("member_b").alias("member_name"), F.col("member_a").alias("neighbour"),
                     "similarity")
    return a.unionByName(b)
