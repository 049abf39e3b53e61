"""Embedding near-duplicates by a random-projection tree forest.

Trees: a node splits at the median of its points' projections on a random
direction; points within a margin of the median go to both sides (spill). Two
unit vectors at cosine 0.95 are at most 0.317 apart, so their projections differ
by 0.317/sqrt(d) as a standard deviation; the margin is half of that. How often a
split parts such a pair follows from where the node's points lie about the
median: about 0.167 x the share that spills, 2 % at a share of 0.126 and 5.8 %
at `MOST_SPILL`. The splits on the worst way to a leaf add up to a tree's miss,
and as trees are independent, there are as many (`TREES` at least) as bring the
product of their misses below `MISS`, whatever the depth: that bounds how often a
pair at 0.95, lying as the points of its nodes do, shares no leaf; closer ones
are missed far less. A node where the miss would pass `MOST_MISS` is a leaf, so
that 20 trees suffice at any size. Medians are fitted on a sample of at most
`SAMPLE` vectors, every vector is indexed.

Equal vectors are one class first. Vectors are compared within leaves, in double
precision; a pair is counted only in the first leaf that both share, which their
lists of leaves tell, so a task gives out one row per vector: the links counted
there and the smallest vector it is connected with in that leaf. Leaves larger
than `BLOCK` are compared as pairs of blocks in different tasks. Components
follow from these rows by joins.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components links with nothing; so do rows without an id, and vectors of
different lengths with one another; rows that share an id are one vector and get
a row each; equal distances do not matter, links are by threshold; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, durable, sampled, written
from .graph import connected_components

TREES = 8
LEAF = 1024
#: a pair at COSINE shares no leaf with at most this probability
MISS = 1e-6
#: a node is a leaf where a pair would be parted on the way down more often
MOST_MISS = 0.5
BLOCK = 2_048
SAMPLE = 40_000
ROUTE_ROWS = 1_000
#: a node where more than this share would go to both sides is a leaf
MOST_SPILL = 0.35
COSINE = 0.95
#: large leaves up to this number are broadcast with their number of blocks
BROADCAST_LEAVES = 200_000


def _gaps(d: int, n: int = 100_000) -> np.ndarray:
    """How far the projections of a pair at COSINE lie apart on random
    directions of d dimensions: n draws, sorted."""
    rng = np.random.default_rng(d)
    one, rest = rng.normal(size=n) ** 2, rng.chisquare(d - 1, n) if d > 1 else np.zeros(n)
    return np.sort(np.sqrt((2 - 2 * COSINE) * one / (one + rest)))


class Tree:
    """Directions (from a seed) and medians of one tree's inner nodes; `miss` is
    how often a pair at COSINE is parted on the worst way down."""

    def __init__(self, points: np.ndarray, seed: tuple, least: float, margin: float, gaps: np.ndarray):
        self.seed, self.margin, self.median, self.miss = seed, margin, {}, 0.0
        stack = [(1, np.arange(len(points)), 0.0)]
        while stack:
            node, own, miss = stack.pop()
            self.miss = max(self.miss, float(miss))
            if len(own) <= max(least, 8) or node >= 1 << 24:
                continue
            p = points[own] @ self.direction(node, points.shape[1])
            at = float(np.median(p))
            left, right = own[p <= at + margin], own[p >= at - margin]
            if len(left) + len(right) > (1 + MOST_SPILL) * len(own):  # a clump within the margin
                continue
            # a pair about a point is parted if its projections reach beyond the margin on both sides
            miss += 1 - np.searchsorted(gaps, 2 * (margin + np.abs(p - at)), side="right").mean() / len(gaps)
            if miss > MOST_MISS:
                continue
            self.median[node] = at
            stack += [(2 * node, left, miss), (2 * node + 1, right, miss)]

    def direction(self, node: int, d: int) -> np.ndarray:
        r = np.random.default_rng([*self.seed, node]).normal(size=d)
        return r / np.linalg.norm(r)

    def leaves(self, points: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows of `points` in it)."""
        out, stack = [], [(1, np.arange(len(points)))]
        while stack:
            node, own = stack.pop()
            if not len(own):
                continue
            if node not in self.median:
                out.append((node, own))
                continue
            p = points[own] @ self.direction(node, points.shape[1])
            stack += [(2 * node, own[p <= self.median[node] + self.margin]),
                      (2 * node + 1, own[p >= self.median[node] - self.margin])]
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    x = x.astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of a list column, without Python objects."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return column.flatten().to_numpy(zero_copy_only=False), bounds.astype(np.int64)


def _by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vector length -> (rows, their vectors)."""
    values, bounds = _lists(column)
    lens, out = np.diff(bounds), {}
    for d in np.unique(lens[lens > 0]).tolist():
        rows = np.flatnonzero(lens == d)
        out[d] = rows, values[bounds[rows][:, None] + np.arange(d)]
    return out


def fit_forest(sample: dict[int, tuple[np.ndarray, np.ndarray]], total: int, *, trees: int = TREES,
               leaf: int = LEAF) -> dict[int, list[Tree]]:
    """A forest for each vector length in the sample: `trees` trees, and more until
    their misses multiply to MISS at most."""
    out = {}
    size = sum(len(rows) for rows, _ in sample.values())
    for d, (_, points) in sample.items():
        margin = 0.5 * np.sqrt(2 - 2 * COSINE) / np.sqrt(d)
        least = leaf * size / max(total, 1)
        points, gaps = _unit(points), _gaps(d)
        out[d], miss = [], 1.0
        while len(out[d]) < trees or miss > MISS:
            out[d].append(Tree(points, (d, len(out[d])), least, margin, gaps))
            miss *= out[d][-1].miss
    return out


def _leaves_of(forest: dict[int, list[Tree]], d: int, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, row) of every leaf that the vectors of length d are in; a leaf is
    tree << 25 | node. A length that the sample lacks is one leaf."""
    points = _unit(raw)
    found = [(t << 25 | node, inside) for t, tree in enumerate(forest.get(d, [None]))
             for node, inside in (tree.leaves(points) if tree else [(1, np.arange(len(points)))])]
    return (np.concatenate([np.full(len(i), k, dtype=np.int64) for k, i in found]),
            np.concatenate([i for _, i in found]))


def _leaf_sizes(forest: dict[int, list[Tree]], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for d, (_, raw) in _by_length(batch.column(2)).items():
            leaf, n = np.unique(_leaves_of(forest, d, raw)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), d, np.int32)), pa.array(leaf), pa.array(n)],
                                             names=["d", "leaf", "n"])


def _route(forest: dict[int, list[Tree]], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per vector and leaf: length, leaf, rep, mult, vector, its leaves up to this one."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROUTE_ROWS):
            batch = whole.slice(at, ROUTE_ROWS)
            for d, (rows, raw) in _by_length(batch.column(2)).items():
                leaf, row = _leaves_of(forest, d, raw)
                order = np.lexsort((leaf, row))
                leaf, row = leaf[order], row[order]
                count = np.bincount(row, minlength=len(raw))
                ends = np.cumsum(count)
                # each row carries the leaves of its vector up to its own
                own = np.repeat(ends - count, count)
                lens = np.arange(len(row)) - own + 1
                inner = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
                leaves = leaf[np.repeat(own, lens) + inner].astype(np.int32)
                pick = pa.array(rows[row])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), d, np.int32)), pa.array(leaf), batch.column(0).take(pick), batch.column(1).take(pick),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * d, pa.int32()), pa.array(raw[row].ravel())),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(leaves))],
                    names=["d", "leaf", "rep", "mult", "vec", "leaves"])


def _tables(column: pa.ChunkedArray) -> np.ndarray:
    """[rows, trees, leaves of a tree], padded by -1."""
    values, bounds = _lists(column)
    values = values.astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    tree = (values >> 25) & 127
    # values are sorted within a row, so a tree's leaves stand together
    new = np.r_[True, (row[1:] != row[:-1]) | (tree[1:] != tree[:-1])]
    first = np.flatnonzero(new)
    place = np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))
    out = np.full((len(bounds) - 1, int(tree.max()) + 1, int(place.max()) + 1), -1, dtype=np.int64)
    out[row, tree, place] = values
    return out


def _first_shared(leaves: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Whether `leaf` is the smallest leaf that vectors i and j share, tree by
    tree; most pairs already share one in the first."""
    out = np.ones(len(i), dtype=bool)
    last = (leaf >> 25) & 127
    for a in range(0, len(i), 20_000):
        left = np.arange(a, min(a + 20_000, len(i)))
        for t in range(last + 1):
            x, y = leaves[i[left], t], leaves[j[left], t]
            earlier = (x >= 0) & (x < leaf)
            shared = ((x[:, :, None] == y[:, None, :]).any(axis=2) & earlier).any(axis=1)
            out[left[shared]] = False
            left = left[~shared]
            if not len(left):
                break
    return out


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the sets of i and j; every entry points to its set's smallest member."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _compare(table: pa.Table) -> pa.Table:
    """Links within one leaf, or between two of its blocks: for each vector that
    has any, the links first found here and the smallest vector it hangs with."""
    table = table.take(np.argsort(table.column("rep").to_numpy(), kind="stable"))
    rep, mult, side = (table.column(c).to_numpy() for c in ("rep", "mult", "side"))
    leaf, two = int(table.column("leaf")[0].as_py()), bool(table.column("cross")[0].as_py())
    x = _unit(_lists(table.column("vec"))[0].reshape(len(rep), -1))
    leaves = _tables(table.column("leaves"))
    links, root, any_link = np.zeros(len(rep), np.int64), np.arange(len(rep)), np.zeros(len(rep), bool)
    for a in range(0, len(rep), 256):
        i, j = np.nonzero(x[a:a + 256] @ x.T >= COSINE)
        i += a
        keep = (i < j) & (rep[i] != rep[j])
        if two:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        if len(i):
            first = _first_shared(leaves, i, j, leaf)
            np.add.at(links, i[first], mult[j[first]])
            np.add.at(links, j[first], mult[i[first]])
            any_link[i] = any_link[j] = True
            root = _unite(root, i, j)
    some = np.flatnonzero(any_link)
    return pa.table({"rep": rep[some], "links": links[some], "root": rep[root[some]]})


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of `vectors`: id, n_links, component_id, kept. Rows that share
    an id are one vector, those without one link with nothing."""
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    usable = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    named = v.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumns({
        "k1": F.when(F.col("ok"), F.xxhash64("v")), "k2": F.when(F.col("ok"), F.xxhash64(F.lit(7), "v"))})
    ids = durable(named.select("id", "ok", "k1", "k2").distinct())
    classes = durable(ids.where("ok").groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult")))
    heads = named.where("ok").join(classes, ["k1", "k2"]).where("id = rep").groupBy("k1", "k2").agg(
        F.first("rep").alias("rep"), F.first("mult").alias("mult"), F.first("v").alias("v"))
    heads = written(heads, "forest-vectors")
    total = heads.count()
    chosen = collected(sampled(heads, "rep", SAMPLE, total).select("rep", "v")).sort_values("rep")
    forest = fit_forest(_by_length(pa.array(chosen["v"].tolist(), pa.list_(pa.float64()))), total)
    task = heads.select("rep", "mult", "v")
    large = durable(task.mapInArrow(lambda it: _leaf_sizes(forest, it), "d int, leaf long, n long").groupBy("d", "leaf").agg(
        F.sum("n").alias("n")).where(F.col("n") > BLOCK).select("d", "leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    if large.count() <= BROADCAST_LEAVES:
        large = F.broadcast(large)
    routed = task.mapInArrow(lambda it: _route(forest, it),
                             f"d int, leaf long, rep long, mult long, vec array<{kind}>, leaves array<int>")
    # a block meets every block of its leaf, itself included, in a task of its own
    placed = routed.join(large, ["d", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
            "x": F.least("block", "other"), "y": F.greatest("block", "other"),
            "side": F.col("block"), "cross": F.col("block") != F.col("other")})
    found = durable(placed.groupBy("d", "leaf", "x", "y").applyInArrow(_compare, "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # different vectors of one id hang together
    held = ids.where("ok").join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("id", "rep")
    several = held.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("id", "a")
    same_id = held.join(several, "id").select("a", F.col("rep").alias("b"))
    comp = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(same_id))
    per_class = classes.join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    of_id = ids.where("id IS NOT NULL").join(per_class, ["k1", "k2"], "left").groupBy("id").agg(
        F.max(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.min(F.coalesce("component_id", "id")).alias("component_id"))
    return v.select("id").join(of_id, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
