"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle is hashed to a bin and a value; a bin keeps its
first round's least value. After as many rounds as there are bins, round i puts
all shingles into one bin, so every coordinate fills; the values are of the form
(round, hash), which makes the share of equal bins an unbiased estimate of the
Jaccard similarity with concentration bounds. `BANDS` bands of `ROWS` bins give
candidates: a pair at 0.75 is missed with probability 1e-6.

From candidates to components, whole but without all pairs of a bucket:

1. texts with equal shingle sets are one class (partial minimum);
2. in each bucket the member that shares most buckets with others (an original
   among its copies) is the leader; members are verified against leaders;
3. members that are not in their leader's component are verified against random
   members of their buckets, which differ from bucket to bucket;
4. those that still stand apart are compared with the members of their buckets in
   other components: pair by pair in buckets of at most `PAIR_BUCKET` of them,
   and by an exact prefix filter with positions among all members of larger ones.
   Pairs of steps 2 to 4 whose packed sketches (two bits a bin, fetched by id for
   distinct pairs) agree as 0.75 allows, within five standard errors, and all of the
   prefix filter's, are verified on the full sets.

Sets are built again from the texts of candidates only; they never travel for
the rest. Hot buckets are plain joins which Spark splits.

Defined cases: null texts count as empty, texts without words link with nothing;
rows without an id link with nothing and are kept; rows that share an id are one
document; texts of any length are sketched whole; of documents that share as many buckets the
smallest id leads; repeated rows all get their document's result; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, lean, written
from .graph import connected_components
from .shingles import U, chunks, mix64, shingle_sets, text_bytes, word_hashes

BINS, ROWS, BANDS = 256, 5, 51
WIDTH, SIMILARITY_PERCENT = 5, 75
# Agreeing bins of two packed sketches: expected 0.8125 * 256 at similarity 0.75,
# less five standard errors (6.2 bins each).
AGREE_LEAST = 177
#: ids below this many rows are broadcast to the second reading of the texts
BROADCAST_IDS = 1_000_000
#: open members of a bucket up to which its pairs are formed one by one
PAIR_BUCKET = 32
#: shingles that one task of the prefix filter takes
TASK_SHINGLES = 100_000
#: random members of a bucket that its unlinked members are verified against
RANDOM = 2
_ROUND_KEYS = mix64(np.arange(1, 2 * BINS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


def sketch(values: np.ndarray) -> np.ndarray:
    """The BINS coordinates of a non-empty set of 64-bit hashes."""
    out = np.full(BINS, _EMPTY, dtype=U)
    i = 0
    while i < 2 * BINS:
        rounds = max(1, min(BINS - i if i < BINS else 1, 2000 // len(values)))
        h = mix64(values[None, :] ^ _ROUND_KEYS[i:i + rounds, None])
        no = np.arange(i, i + rounds, dtype=U)[:, None]
        to = h % U(BINS) if i < BINS else np.broadcast_to(no - U(BINS), h.shape)
        # earlier rounds are smaller values, so the minimum is the first round's minimum
        np.minimum.at(out, to.ravel().astype(np.int64), ((no << U(54)) | (h >> U(10))).ravel())
        i += rounds
        if (out != _EMPTY).all():
            break
    return out


def band_keys(coords: np.ndarray) -> np.ndarray:
    rows = mix64(coords[:ROWS * BANDS]).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=U)
    for k in range(ROWS):
        key = mix64(key * U(0x9E3779B97F4A7C15) + rows[:, k])
    return key


def packed(coords: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, 32 to a 64-bit number."""
    bits = (mix64(coords) & U(3)).reshape(-1, 32)
    return (bits << (U(2) * np.arange(32, dtype=U))).sum(axis=1, dtype=U)


def _longs(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=U)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in chunks(offsets):
            words, bounds = word_hashes(data, offsets[a:b + 1])
            yield batch.column(0).slice(a, b - a), list(shingle_sets(words, bounds, WIDTH))


def _signatures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, dtype=U)
    for ids, sets in _sets(batches):
        coords = [sketch(s) if len(s) else none for s in sets]
        sums = np.array([[s.sum(dtype=U), mix64(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)] for s in sets], dtype=U)
        yield pa.RecordBatch.from_arrays([
            ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[:, 0].view(np.int64)),
            pa.array(sums[:, 1].view(np.int64)), _longs([band_keys(c) if len(c) else none for c in coords]),
            _longs([packed(c) if len(c) else none for c in coords])],
            names=["doc", "n", "s1", "s2", "bands", "bits"])


def _full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays([ids, _longs(sets)], names=["doc", "members"])


def _agree(x: str, y: str) -> Column:
    """Equal coordinates of two packed sketches."""
    differ = sum((F.bit_count(F.expr(
        f"(({x}[{i}] ^ {y}[{i}]) | shiftrightunsigned({x}[{i}] ^ {y}[{i}], 1)) & {0x5555555555555555}L"))
        for i in range(BINS // 32)), F.lit(0))
    return F.lit(BINS) - differ


def _near(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The distinct (member, other) whose sizes allow the similarity and whose
    sketches, fetched by id, agree well enough."""
    one = about.select(F.col("doc").alias("member"), F.col("n").alias("x_n"), F.col("bits").alias("x"))
    two = about.select(F.col("doc").alias("other"), F.col("n").alias("y_n"), F.col("bits").alias("y"))
    return pairs.distinct().join(one, "member").join(two, "other").where(
        (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * SIMILARITY_PERCENT) & (_agree("x", "y") >= AGREE_LEAST)).select(
        "member", "other").distinct()


def _open_members(joint: DataFrame, leaders: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, doc, component, lead_component) of the buckets that hold more than
    their leader's component."""
    known = joint.select("key", "doc").distinct().join(comp.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc"))
    lead = leaders.join(comp.withColumnRenamed("node", "leader"), "leader", "left").select(
        "key", F.coalesce("component", "leader").alias("lead_component"))
    both = known.join(lead, "key")
    left = both.where("component != lead_component").select("key").distinct()
    return durable(both.join(left, "key", "left_semi"))


def _prefix_pairs(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(member, other) of all pairs of `docs` (doc, component, unlinked) that may
    reach the similarity, of different components, one of them unlinked.

    An exact prefix filter: shingles are ordered by the number of sets that hold
    them, rare ones first, and two sets are similar enough only if they share one
    so early in both that what follows can still make up the overlap. Copies
    edited beyond the threshold begin with their own edits, so they meet nobody
    through the shingles that all copies share."""
    # tasks by what their sets hold, which is dealt out evenly
    own = sets.join(docs, "doc").select("doc", "component", "unlinked", "members", F.size("members").alias("n"))
    held = own.agg(F.sum("n")).first()[0] or 0
    own = durable(own.repartition(1 + held // TASK_SHINGLES).withColumn("row", F.monotonically_increasing_id()))
    held = own.select("row", F.explode("members").alias("g"))
    common = held.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles of one set only come first in the order and need no entry
    ordered = held.join(common, "g").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("held"))
    # a set shares at least 75/100 of its own size, so its first common shingle is among these
    last = F.col("n") - F.ceil(F.col("n") * SIMILARITY_PERCENT / 100) + 1
    first = own.drop("members").join(ordered, "row").withColumn("alone", F.col("n") - F.size("held")).withColumn(
        "held", F.slice("held", 1, F.greatest(last - F.col("alone"), F.lit(0)).cast("int")))
    entries = durable(first.select("doc", "component", "unlinked", "n", "alone", F.posexplode("held").alias("i", "h")).select(
        "doc", "component", "unlinked", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("rest"), F.col("h.g").alias("g")))
    u, v = entries.where("unlinked").alias("u"), entries.alias("v")
    # of the sets from this shingle on, the smaller rest bounds the overlap
    overlap = F.ceil((F.col("u.n") + F.col("v.n")) * SIMILARITY_PERCENT / (100 + SIMILARITY_PERCENT))
    return u.join(v, (F.col("u.g") == F.col("v.g")) & (F.col("u.component") != F.col("v.component"))
                  & (~F.col("v.unlinked") | (F.col("u.doc") < F.col("v.doc")))
                  & (F.least("u.rest", "v.rest") >= overlap)).select(
        F.col("u.doc").alias("member"), F.col("v.doc").alias("other")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (member, other) whose full sets reach the similarity, as links a, b."""
    one = sets.select(F.col("doc").alias("member"), F.col("members").alias("x"))
    two = sets.select(F.col("doc").alias("other"), F.col("members").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(one, "member").join(two, "other").where(
        common * 100 >= (F.size("x") + F.size("y") - common) * SIMILARITY_PERCENT).select(
        F.least("member", "other").alias("a"), F.greatest("member", "other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, n_shingles, component_id, kept."""
    texts = lean(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    signed = written(texts.mapInArrow(
        _signatures, "doc long, n long, s1 long, s2 long, bands array<long>, bits array<long>"), "minhash-signatures")
    linkable = signed.where("doc IS NOT NULL AND n > 0")
    classes = linkable.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep"))
    of_class = linkable.select("doc", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).select("doc", "rep").distinct()
    member_of = durable(of_class)
    same_id = member_of.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("a", "b")

    heads = linkable.join(classes.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
    dealt = heads.select("doc", F.explode("bands").alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    joint = durable(dealt.join(shared, "key"))
    weight = joint.groupBy("doc").agg(F.sum("size").alias("weight"))
    leaders = durable(joint.join(weight, "doc").groupBy("key").agg(
        F.max_by("doc", F.struct("weight", -F.col("doc"))).alias("leader")))
    ids = durable(weight.select("doc"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    about = durable(heads.select("doc", "n", "bits").join(ids, "doc", "left_semi"))
    sets = written(texts.join(ids, "doc", "left_semi").mapInArrow(
        _full_sets, "doc long, members array<long>"), "minhash-sets")

    met = joint.join(leaders, "key").where("doc != leader").select(F.col("doc").alias("member"), F.col("leader").alias("other"))
    first = durable(_verified(_near(met, about), sets))
    # random members of a bucket differ from bucket to bucket, so a copy that the
    # leader does not link meets many others here at one row a bucket each
    some = _open_members(joint, leaders, connected_components(first))
    pick = some.groupBy("key").agg(*(F.min_by(
        F.struct("doc", "component"), F.xxhash64("doc", "key", F.lit(i))).alias(f"p{i}") for i in range(RANDOM)))
    pick = pick.select("key", F.explode(F.array_distinct(F.array(*(f"p{i}" for i in range(RANDOM))))).alias("peer"))
    tried = some.where("component != lead_component").join(pick, "key").where("component != peer.component")
    first = durable(first.union(_verified(_near(tried.select(
        F.col("doc").alias("member"), F.col("peer.doc").alias("other")), about), sets)))

    # what still stands apart: all pairs of a small bucket, an exact filter for large ones
    some = _open_members(joint, leaders, connected_components(first))
    large = some.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PAIR_BUCKET).select("key")
    crowded = durable(some.join(large, "key", "left_semi").select("doc").distinct())
    if crowded.count() <= BROADCAST_IDS:
        crowded = F.broadcast(crowded)
    lone = F.max(F.col("component") != F.col("lead_component")).alias("unlinked")
    crowd = durable(some.join(crowded, "doc", "left_semi").groupBy("doc", "component").agg(lone))
    few = durable(some.join(large, "key", "left_anti").join(
        crowded.withColumn("crowded", F.lit(True)), "doc", "left").fillna(False, ["crowded"]))
    u, v = few.where("component != lead_component").alias("u"), few.alias("v")
    rest = u.join(v, (F.col("u.key") == F.col("v.key")) & (F.col("u.component") != F.col("v.component"))
                  & ~(F.col("u.crowded") & F.col("v.crowded"))).select(
        F.least("u.doc", "v.doc").alias("member"), F.greatest("u.doc", "v.doc").alias("other"))
    more = _verified(_near(rest, about), sets).union(_verified(
        _prefix_pairs(sets.join(crowded, "doc", "left_semi"), crowd), sets))

    final = connected_components(first.union(more).union(same_id))
    of_doc = member_of.join(final.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc").agg(
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    return signed.select("doc", "n").join(of_doc, "doc", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
        F.col("doc").eqNullSafe(F.coalesce("component_id", "doc")).alias("kept"))
