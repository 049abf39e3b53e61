"""Mixing sources to target weights: temperature mixing, native Spark only.

Natural token shares `s` of the sources are exponentiated, `w = s^a / sum(s^a)`,
and the exponent `a` in [0, 1] is bisected until the mix meets a target entropy
or a limit on repetitions (the most often a source is repeated, which is the
smallest source's `w / s`). The weights become token budgets; a budget is
realised by whole epochs over the source plus a part of one epoch, in blocks
whose documents are permuted anew in each epoch.

A source is never handled as one group: its documents are dealt by hash into
blocks of about `block_tokens` tokens, every block gives its proportional share
of the partial epoch, and only a block is ever sorted. The table of sources is
only aggregated, never collected: one job evaluates 31 exponents, that is five
steps of the bisection.

Defined cases: a null source is a source of its own (null); null or empty texts
have no tokens, cost nothing and are drawn like their block; a source without
tokens has weight 0 and is not drawn; texts of any length are counted
whole; rows that tie in a permutation follow by id, then by tokens; rows repeated in the
input are separate rows; a target that no exponent meets is an error; further columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, durable

STEPS_PER_PASS = 31
PASSES = 7
#: sources up to this number are broadcast with their weights (some 100 bytes each)
BROADCAST_SOURCES = 100_000
SALTS = 64


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet. `max_repetition`: no source is drawn more
    than so many times over; `entropy`: at most this share (0 to 1) of the
    entropy of a uniform mix is asked for. The stricter (larger) exponent wins."""

    max_repetition: float | None = 4.0
    entropy: float | None = None


def source_tokens(counted: DataFrame) -> DataFrame:
    """(_m_key, src_tokens) per source with tokens; partially aggregated."""
    return counted.groupBy("_m_key").agg(F.sum("n_tokens").alias("src_tokens")).where("src_tokens > 0")


def solve_exponent(shares: DataFrame, target: Target, size: float = 1.0) -> float:
    """The smallest exponent in [0, 1] (to 6 decimals) that keeps the repetition
    limit and whose entropy is at most the target; an error if none does.

    `size` is that of the mix in corpora: a source is drawn `size` times its
    weight over its share.

    Repetition falls and entropy falls as the exponent grows, so both conditions
    turn from false to true once and can be bisected together.
    """
    least, n, natural = shares.agg(F.min("share"), F.count(F.lit(1)), F.sum(F.col("share") * F.log("share"))).first()
    if not n:
        return 1.0
    def meets(a: float, z: float, e: float) -> bool:
        ok = True
        if target.max_repetition is not None:
            ok = ok and size * least ** (a - 1) / z <= target.max_repetition
        if target.entropy is not None:
            ok = ok and math.log(z) - a * e / z <= target.entropy * math.log(n) + 1e-12
        return ok

    lo, hi = 0.0, 1.0
    for k in range(PASSES):
        grid = [lo + (hi - lo) * (i + 1) / (STEPS_PER_PASS + 1) for i in range(STEPS_PER_PASS)]
        grid = [lo, *grid] if k == 0 else grid
        row = shares.agg(*(x for a in grid for x in (
            F.sum(F.pow("share", F.lit(a))), F.sum(F.pow("share", F.lit(a)) * F.log("share"))))).first()
        good = [meets(a, row[2 * i], row[2 * i + 1]) for i, a in enumerate(grid)]
        if good[0] and k == 0:
            return 0.0
        if k == 0 and not meets(1.0, 1.0, natural):
            raise ValueError(f"no exponent from 0 to 1 meets {target} in a mix of {size:.6g} times the corpus")
        first = next((i for i, g in enumerate(good) if g), len(grid))
        lo, hi = (grid[first - 1] if first else lo), (grid[first] if first < len(grid) else hi)
    return round(hi, 6)


def _fraction(key: Column) -> Column:
    """A uniform integer below 2^32 from the md5 of a text."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, *, target: Target = Target(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block_tokens: int = 200_000, total_tokens: int | None = None,
        seed: int = 17) -> DataFrame:
    """One row per drawn copy of a document: the columns of `docs` (but those
    named here, which are replaced) and n_tokens, alpha, weight (of the source),
    epoch (from 0), block, position (from 1, in the block's permutation of that
    epoch) and draw_key: reading by (epoch, draw_key, position) gives the blocks
    of all sources in permuted order.

    `total_tokens` is the size of the mix, by default that of the corpus.
    """
    own = ["n_tokens", "alpha", "weight", "epoch", "block", "position", "draw_key"]
    keep = [c for c in docs.columns if c not in own]
    counted = docs.select(
        *keep, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(
            F.concat(F.lit("s"), F.col(source_col).cast("string"))).alias("_m_key"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_m_id"))
    shares = durable(source_tokens(counted))
    all_tokens, n_sources = shares.agg(F.sum("src_tokens"), F.count(F.lit(1))).first()
    shares = shares.withColumn("share", F.col("src_tokens") / F.lit(all_tokens or 1))
    alpha = solve_exponent(shares, target, (total_tokens / all_tokens) if total_tokens and all_tokens else 1.0)
    z = shares.agg(F.sum(F.pow("share", F.lit(alpha)))).first()[0] or 1.0
    size = F.lit(float(total_tokens if total_tokens is not None else all_tokens or 0))
    plan = shares.select(
        "_m_key", (F.pow("share", F.lit(alpha)) / F.lit(z)).alias("weight"),
        F.ceil(F.col("src_tokens") / F.lit(float(block_tokens))).cast("long").alias("_m_blocks"),
        (F.pow("share", F.lit(alpha)) / F.lit(z) * size / F.col("src_tokens")).alias("_m_rep"))
    # a hot source is never one join key: few sources are broadcast, many are salted
    if n_sources <= BROADCAST_SOURCES:
        planned = counted.join(F.broadcast(plan), "_m_key")
    else:
        salt = F.pmod(F.xxhash64("_m_id"), F.lit(SALTS)).cast("int")
        planned = counted.withColumn("_m_salt", salt).join(
            plan.withColumn("_m_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["_m_key", "_m_salt"])
    # blocks follow from the document alone, so it is dealt out before any shuffle by group too
    dealt = planned.withColumn(
        "block", _fraction(F.concat_ws(":", F.lit(str(seed)), "_m_id")) % F.col("_m_blocks")).withColumn(
        "_m_full", F.floor("_m_rep").cast("long")).withColumn(
        "_m_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_m_full").cast("string"), "_m_id")))
    in_block = Window.partitionBy("_m_key", "block")
    run = in_block.orderBy("_m_order", "_m_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = dealt.withColumn("_m_run", F.sum("n_tokens").over(run)).withColumn(
        "_m_all", F.sum("n_tokens").over(in_block))
    # of the partial epoch a block gives its share: a document is in when its middle token is
    copies = F.col("_m_full") + F.when(
        F.col("_m_run") - F.col("n_tokens") / F.lit(2.0) <= (F.col("_m_rep") - F.col("_m_full")) * F.col("_m_all"),
        F.lit(1)).otherwise(F.lit(0))
    drawn = part.withColumn("_m_copies", copies).where("_m_copies > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m_copies") - 1)))
    drawn = drawn.withColumn(
        "_m_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), "_m_id"))).withColumn(
        "position", F.row_number().over(
            Window.partitionBy("_m_key", "block", "epoch").orderBy("_m_order", "_m_id", "n_tokens")).cast("long"))
    return drawn.select(
        *keep, "n_tokens", F.lit(alpha).alias("alpha"), "weight", "epoch", "block", "position",
        _fraction(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), "_m_key",
                              F.col("block").cast("string"))).alias("draw_key"))
