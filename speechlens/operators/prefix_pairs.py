"""Most similar member pairs by an exact prefix index instead of a block product.

Terms are ordered by how many members have them, rare ones first. Of a unit vector
only the terms are indexed from which on its norm still reaches the threshold `t`:
what follows them has a norm below `t`, so two members of cosine `t` or more share
an indexed term of both (else all they share would lie in the one's rest, whose
product with a unit vector is below `t`). At the first term they share, moreover,
the norms from there on must multiply to `t`. Both conditions hold for any vectors
(Cauchy-Schwarz), and pairs that pass them are verified on the whole vectors.

Where only the k best are asked for, the threshold is raised first: the pairs of each
term's three heaviest members are scored in full, and the k-th best of them is no
more than the true one. The more the best pairs stand out, the less is indexed.

A member's vector is one row of arrays, bounded by the vocabulary; it travels to a
candidate pair only. The block product (`similarity.similar_pairs`) copies every
vector to all blocks instead, and is the better choice where most pairs pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SCORE_DIGITS
from ..session import durable
from .similarity import PAIR_SCHEMA, SIMILARITY_THRESHOLD, TOP_PAIRS, _unit_vectors

#: heaviest members of a term whose pairs raise the threshold
HEAVIEST = 3
#: scores are compared rounded; a bound this far under the threshold cannot matter
SLACK = 2.0 * 10.0 ** -SCORE_DIGITS


def _scored(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """(member_a, member_b, similarity) of the given pairs, from whole vectors."""

    def dot(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at, au, bt, bu = ([v.values.to_numpy() for v in batch.column(i)] for i in (2, 3, 4, 5))
            out = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                _, x, y = np.intersect1d(at[i], bt[i], assume_unique=True, return_indices=True)
                out[i] = au[i][x] @ bu[i][y]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)],
                                             names=["member_a", "member_b", "similarity"])

    one = packed.select(F.col("member_name").alias("member_a"), F.col("terms").alias("a_terms"), F.col("us").alias("a_us"))
    two = packed.select(F.col("member_name").alias("member_b"), F.col("terms").alias("b_terms"), F.col("us").alias("b_us"))
    both = pairs.join(one, "member_a").join(two, "member_b").select(
        "member_a", "member_b", "a_terms", "a_us", "b_terms", "b_us")
    return both.mapInArrow(dot, PAIR_SCHEMA).withColumn("similarity", F.round("similarity", SCORE_DIGITS))


def _raised(unit: DataFrame, packed: DataFrame, k: int, threshold: float) -> float:
    """The threshold, or the k-th best of a few promising pairs if that is more."""
    best = Window.partitionBy("term_id").orderBy(F.desc("u"), F.asc("member_name"))
    heavy = unit.withColumn("r", F.row_number().over(best)).where(F.col("r") <= HEAVIEST).select("term_id", "member_name")
    pairs = heavy.alias("x").join(heavy.alias("y"), (F.col("x.term_id") == F.col("y.term_id")) & (
        F.col("x.member_name") < F.col("y.member_name"))).select(
        F.col("x.member_name").alias("member_a"), F.col("y.member_name").alias("member_b")).distinct()
    kth = _scored(pairs, packed).orderBy(F.desc("similarity")).limit(k).agg(
        F.min("similarity"), F.count(F.lit(1))).first()
    return max(threshold, kth[0]) if kth[1] == k else threshold


def indexed_terms(unit: DataFrame, threshold: float) -> DataFrame:
    """(member_name, term_id, norm): the indexed part of each unit vector, and its
    norm from that term on."""
    rarity = unit.groupBy("term_id").agg(F.count(F.lit(1)).alias("members"))
    onwards = Window.partitionBy("member_name").orderBy("members", "term_id").rowsBetween(0, Window.unboundedFollowing)
    return unit.join(rarity, "term_id").withColumn("norm", F.sqrt(F.sum(F.col("u") ** 2).over(onwards))).where(
        F.col("norm") >= threshold - SLACK).select("member_name", "term_id", "norm")


def candidate_pairs(indexed: DataFrame, threshold: float) -> DataFrame:
    """(member_a, member_b) of all pairs that may reach the threshold."""
    return indexed.alias("x").join(indexed.alias("y"), (F.col("x.term_id") == F.col("y.term_id"))
                                   & (F.col("x.member_name") < F.col("y.member_name"))
                                   & (F.col("x.norm") * F.col("y.norm") >= threshold - SLACK)).select(
        F.col("x.member_name").alias("member_a"), F.col("y.member_name").alias("member_b")).distinct()


def similar_pairs_prefix(vectors: DataFrame, k: int | None = TOP_PAIRS, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """`similarity.similar_pairs` by the prefix index: the same rows."""
    if k is not None and int(k) < 1:
        raise ValueError("k must be at least 1 (or None for every pair above the threshold)")
    if threshold <= 0:
        raise ValueError("the prefix index needs a threshold above 0")
    unit = durable(_unit_vectors(vectors))
    packed = durable(unit.groupBy("member_name").agg(F.sort_array(F.collect_list(F.struct("term_id", "u"))).alias("p")).select(
        "member_name", F.col("p")["term_id"].alias("terms"), F.col("p")["u"].alias("us")))
    floor = _raised(unit, packed, k, threshold) if k is not None else threshold
    found = _scored(candidate_pairs(durable(indexed_terms(unit, floor)), floor), packed).where(F.col("similarity") >= threshold)
    ordered = found.orderBy(F.desc("similarity"), "member_a", "member_b")
    return ordered.limit(k) if k is not None else ordered
