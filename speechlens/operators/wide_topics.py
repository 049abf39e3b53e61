"""Truncated SVD of a TF-IDF matrix of any number of terms.

The same block Krylov method as `topics.fit_lsa`, on the side of the documents and with
every matrix that has a row for each document or term kept in Spark. The documents are
dealt into blocks, whose weights are packed once into a table bucketed by block; a matrix
with a row for each document is a table of the same buckets (block, m), m the rows of a
block's documents, so that products and joins of them need no shuffle. A weight is held
as a number, a factor of its term and a divisor of its document: for TF-IDF weights the
number is a small count, which packs into a byte. A pass

* multiplies the newest part of the basis by A A^T: every block of documents sends one
  row for each of its terms that other blocks hold too, these are added up by term and
  go back to the blocks; terms of one block alone are never sent, and the weights do not
  move. Some columns are multiplied at a time, so that the rows under way take no more
  disk than the weights;
* takes out of it what the basis spans, twice: the small products basis^T Z are
  summed from the partitions' products;
* factors the rest by a tree of QR factorisations: every partition factors its rows,
  groups of `FAN_IN` of the small factors are stacked and factored again until one is
  left, whose inverse makes the block orthonormal (twice, for stability).

The driver holds only factors of the size of the basis' columns. Rayleigh-Ritz runs on
the products it has seen; residuals follow from the factor of what the basis does
not span, without a further pass. The components are A^T U S^-1, one more product.

On disk are the packed weights, the basis once, and the running product's shuffles.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, durable, scratch_path, shuffles_dropped

# task functions travel with what they call, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN_IN = 8
#: rows of a tall matrix that one task takes
TASK_ROWS = 20_000
#: weights of a block of documents
BLOCK_WEIGHTS = 4_000_000
#: parts in which the weights are packed, each a shuffle of its share of them
PACK_SLICES = 4
#: bytes of a product's numbers under way at a time, for each weight and at least
SENT_BYTES, SENT_LEAST = 6, 200_000_000
EPS = 1e-11


@dataclass
class WideLsa:
    """Like `topics.LsaModel`, with the components as a table (term_id, loadings)."""

    singular_values: np.ndarray
    components: DataFrame
    n_iter: int
    wide: bool = True

    def components_frame(self, spark: SparkSession) -> DataFrame:
        return self.components


def _matrix(column):
    """The rows of an Arrow list column as a matrix."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _stacked(batch, i: int, parts: list[tuple[str, int]]) -> np.ndarray:
    """The columns that a row of a batch holds of a block's matrices, one below the other."""
    return np.vstack([np.frombuffer(batch[name][i].as_buffer()).reshape(width, -1) for name, width in parts])


def _summed(rows: DataFrame, product, height: int, width: int) -> np.ndarray:
    """The sum over blocks of the (height x width) matrices that `product` makes of
    a batch's row."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        total = np.zeros((height, width))
        for batch in batches:
            for i in range(batch.num_rows):
                total += product(batch, i)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(height), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.mapInArrow(run, "i int, row array<double>")
    sums = parts.groupBy("i").agg(*(F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(width)))
    out = np.zeros((height, width))
    for r in sums.collect():
        out[r["i"]] = r[1:]
    return out


def qr_factor(rows: DataFrame, make, width: int) -> np.ndarray:
    """R of the QR factorisation of the tall matrix whose columns for a block `make`
    makes of a batch's row: a tree over the partitions."""

    def first(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        r = np.zeros((0, width))
        for batch in batches:
            for i in range(batch.num_rows):
                r = np.linalg.qr(np.vstack([r, make(batch, i).T]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))],
                names=["block", "r"])

    def stacked(pdf):
        import pandas as pd

        r = np.linalg.qr(np.vstack([np.asarray(x).reshape(-1, width) for x in pdf["r"]]), mode="r")
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0]) // FAN_IN], "r": [r.ravel()]})

    level = durable(rows.mapInArrow(first, "block long, r array<double>"))
    while level.count() > FAN_IN:
        level = durable(level.groupBy(F.floor(F.col("block") / F.lit(FAN_IN))).applyInPandas(stacked, "block long, r array<double>"))
    left = [np.asarray(x["r"]).reshape(-1, width) for x in level.orderBy("block").collect()]
    return np.linalg.qr(np.vstack([*left, np.zeros((width, width))]), mode="r")


def _inverse(r: np.ndarray) -> np.ndarray:
    """What makes a matrix with factor `r` orthonormal, without directions it lacks."""
    _, s, vt = np.linalg.svd(r)
    keep = s > EPS * max(1.0, s.max(initial=0.0))
    return vt[keep].T / s[keep]


def _rows(matrix: np.ndarray):
    """A matrix as an Arrow list column."""
    import pyarrow as pa

    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.ravel()))


def _block_of(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int").alias("block")


_CELLS = {"docs": np.int64, "terms": np.int32, "doc": None, "weight": None, "per_term": None, "doc_scale": np.float64,
          "term_scale": np.float64}
_PACKED = "block int, n_sent int, " + ", ".join(f"{k} binary" for k in _CELLS) + ", kinds string"


def _narrow(x: np.ndarray) -> np.ndarray:
    """`x` in the smallest unsigned integers that hold all of it, if any do."""
    if len(x) and x.min() >= 0 and x.max() < 2 ** 32 and (x.dtype.kind != "f" or np.all(x == np.floor(x))):
        return x.astype(np.min_scalar_type(int(x.max())))
    return x


def _cells(block: int, n_sent: int, cells: dict):
    """A packed block as a row."""
    import pyarrow as pa

    kinds = " ".join(cells[k].dtype.str for k in _CELLS)
    return pa.table({"block": pa.array([block], pa.int32()), "n_sent": pa.array([n_sent], pa.int32())}
                    | {k: pa.array([cells[k].tobytes()], pa.binary()) for k in _CELLS} | {"kinds": pa.array([kinds], pa.string())})


def _pack(entries):
    """A block's weights in one row, by term."""
    doc_ids, term_ids = entries["doc_id"].to_numpy(), entries["term_id"].to_numpy()
    docs, doc = np.unique(doc_ids, return_inverse=True)
    terms, term, per_term = np.unique(term_ids, return_inverse=True, return_counts=True)
    doc_scale, term_scale = np.ones(len(docs)), np.ones(len(terms))
    doc_scale[doc], term_scale[term] = entries["doc_scale"].to_numpy(), entries["term_scale"].to_numpy()
    order = np.lexsort((doc, term))
    return _cells(entries["block"][0].as_py(), len(terms), {
        "docs": docs.astype(np.int64), "terms": terms.astype(np.int32), "doc": _narrow(doc[order]),
        "weight": _narrow(entries["weight"].to_numpy()[order]), "per_term": _narrow(per_term),
        "doc_scale": doc_scale, "term_scale": term_scale})


def _alone_last(packed, alone):
    """A packed block with the terms of this block alone behind the others."""
    block = _unpacked(packed)
    last = np.isin(block["terms"], alone["term_id"].to_numpy())
    by = np.argsort(last, kind="stable")
    order = np.argsort(np.repeat(last, block["per_term"]), kind="stable")
    return _cells(packed["block"][0].as_py(), int((~last).sum()), {k: block[k] for k in _CELLS} | {
        k: block[k][by] for k in ("terms", "per_term", "term_scale")} | {k: block[k][order] for k in ("doc", "weight")})


def _unpacked(table, i: int = 0) -> dict:
    kinds = table["kinds"][i].as_py().split(" ")
    out = {k: np.frombuffer(table[k][i].as_buffer(), np.dtype(kind)) for k, kind in zip(_CELLS, kinds, strict=True)}
    return out | {"n_sent": table["n_sent"][i].as_py()}


def _to_terms(block: dict, q: np.ndarray, terms: slice) -> np.ndarray:
    """A^T Q of some of a block's terms, a row for each column of Q."""
    ends = np.cumsum(block["per_term"], dtype=np.int64)
    starts = (ends - block["per_term"])[terms]
    if not len(starts):
        return np.zeros((len(q), 0))
    entries = slice(starts[0], ends[terms][-1])
    doc, weight, scale = block["doc"][entries], block["weight"][entries], block["term_scale"][terms]
    return np.stack([np.add.reduceat(weight * column[doc], starts - starts[0]) * scale for column in q / block["doc_scale"]])


_SENT = "block int, part int, terms binary, z binary"


def _sender(columns: slice, width: int, n_parts: int):
    """What the blocks add to the rows of A^T Q of the terms they share, by parts of the terms."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                block = _unpacked(batch, i)
                terms = block["terms"][:block["n_sent"]]
                z = _to_terms(block, _stacked(batch, i, [("q", width)])[columns], slice(0, block["n_sent"]))
                order = np.argsort(terms % n_parts, kind="stable")
                ends = np.cumsum(np.bincount(terms % n_parts, minlength=n_parts))
                some = [(p, order[lo:hi]) for p, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if lo < hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), batch["block"][i].as_py()), pa.int32()), pa.array([p for p, _ in some], pa.int32()),
                     pa.array([terms[x].tobytes() for _, x in some], pa.binary()),
                     pa.array([z[:, x].tobytes() for _, x in some], pa.binary())], names=["block", "part", "terms", "z"])

    return run


def _adder(width: int):
    """The sums of a part's terms, back to every block that holds them."""

    def run(sent):
        import pyarrow as pa

        ids = [np.frombuffer(x.as_buffer(), np.int32) for x in sent["terms"]]
        z = np.hstack([np.frombuffer(x.as_buffer()).reshape(width, -1) for x in sent["z"]])
        _, at = np.unique(np.concatenate(ids), return_inverse=True)
        sums = np.stack([np.bincount(at, column)[at] for column in z])
        back = np.split(sums, np.cumsum([len(x) for x in ids])[:-1], axis=1)
        return sent.set_column(3, "z", pa.array([x.tobytes() for x in back], pa.binary()))

    return run


def _taker(columns: slice, width: int):
    """A block's rows of A A^T Q from its rows of Q and those of A^T Q of its shared terms."""

    def run(packed, got):
        import pyarrow as pa

        block = _unpacked(packed)
        n, q = block["n_sent"], _stacked(packed, 0, [("q", width)])[columns]
        shared = np.zeros((len(q), n))
        for terms, sums in zip(got["terms"], got["z"], strict=True):
            at = np.searchsorted(block["terms"][:n], np.frombuffer(terms.as_buffer(), np.int32))
            shared[:, at] = np.frombuffer(sums.as_buffer()).reshape(len(q), -1)
        z = np.hstack([shared, _to_terms(block, q, slice(n, None))]) * block["term_scale"]
        y = np.stack([np.bincount(block["doc"], block["weight"] * np.repeat(column, block["per_term"]), len(block["docs"]))
                      for column in z]) / block["doc_scale"]
        return pa.table({"block": packed["block"], "m": pa.array([y.tobytes()], pa.binary())})

    return run


def _loader(width: int, s: int, slices: int):
    """What the blocks add to the rows of A^T Q, of every term of the slice."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                block = _unpacked(batch, i)
                some = block["terms"] % slices == s
                z = _to_terms(block, _stacked(batch, i, [("q", width)]), slice(None))[:, some] if width else []
                yield pa.RecordBatch.from_arrays([pa.array(block["terms"][some]), *map(pa.array, z)],
                                                 names=["term_id", *(f"s{j}" for j in range(width))])

    return run


def _table_of(path: str) -> str:
    return "speechlens_blocks_" + path.rsplit("-", 1)[-1]


def _add(rows: DataFrame, path: str, buckets: int) -> None:
    """Rows for the table bucketed by block at `path`."""
    rows.write.mode("append").format("parquet").bucketBy(buckets, "block").option("path", path).option(
        "compression", "zstd").saveAsTable(_table_of(path))


def _drop(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS {_table_of(path)}")
        drop_path(spark, path)


def _n_buckets(spark: SparkSession, n_blocks: int) -> int:
    # at least as many buckets as a shuffle has partitions: else Spark would deal the blocks anew in every pass
    return max(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _blocks(own: DataFrame, n_blocks: int, path: str) -> DataFrame:
    """The packed blocks of (doc_id, term_id, weight), each weight times `term_scale` and
    over `doc_scale` if `own` has them, written bucketed by block."""
    spark = own.sparkSession
    scales = [F.col(c) if c in own.columns else F.lit(1.0).alias(c) for c in ("doc_scale", "term_scale")]
    dealt = own.select(_block_of(n_blocks), "doc_id", "term_id", "weight", *scales)
    buckets, first = _n_buckets(spark, n_blocks), scratch_path(spark, "blocks")
    slices = min(n_blocks, PACK_SLICES)
    for s in range(slices):
        some = dealt.where(F.col("block") % F.lit(slices) == s) if slices > 1 else dealt
        _add(some.groupBy("block").applyInArrow(_pack, _PACKED), first, buckets)
    packed = spark.table(_table_of(first))

    def terms(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                ids = _unpacked(batch, i)["terms"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), batch["block"][i].as_py()), pa.int32()), pa.array(ids)], names=["block", "term_id"])

    alone = packed.mapInArrow(terms, "block int, term_id int").groupBy("term_id").agg(
        F.min("block").alias("block"), F.count(F.lit(1)).alias("n")).where("n = 1").select("block", "term_id")
    _add(packed.groupBy("block").cogroup(alone.groupBy("block")).applyInArrow(_alone_last, _PACKED), path, buckets)
    _drop(spark, first)
    return spark.table(_table_of(path))


def _beside(tables: list[DataFrame]) -> DataFrame:
    """The rows of tables of the same buckets beside each other, one row for each block."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t.hint("merge"), "block")
    return out


def _dealt(blocks: DataFrame, rows: DataFrame, n_blocks: int) -> DataFrame:
    """(block, m): a table (doc_id, q) by block."""

    def run(packed, got):
        import pyarrow as pa

        docs, given = _unpacked(packed)["docs"], _matrix(got["q"])
        q = np.zeros((given.shape[1], len(docs)))
        q[:, np.searchsorted(docs, got["doc_id"].to_numpy())] = given.T
        return pa.table({"block": packed["block"], "m": pa.array([q.tobytes()], pa.binary())})

    by = rows.select(_block_of(n_blocks), "doc_id", "q").groupBy("block")
    return blocks.groupBy("block").cogroup(by).applyInArrow(run, "block int, m binary")


def _product(blocks: DataFrame, q: DataFrame, n_blocks: int, columns: slice, width: int) -> DataFrame:
    """(block, m): some columns of A A^T Q for a table (block, m) of the `width` columns of Q."""
    with_q = _beside([blocks, q.withColumnRenamed("m", "q")])
    n = len(range(width)[columns])
    sent = with_q.mapInArrow(_sender(columns, width, _n_buckets(q.sparkSession, n_blocks)), _SENT)
    got = sent.groupBy("part").applyInArrow(_adder(n), _SENT)
    return with_q.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(_taker(columns, width), "block int, m binary")


def _multiplied(blocks: DataFrame, newest: DataFrame, n_blocks: int, width: int) -> DataFrame:
    """(doc_id, z): the rows of A A^T Q for a table (doc_id, q) of Q."""
    z = _product(blocks, _dealt(blocks, newest, n_blocks), n_blocks, slice(None), width)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                rows = _stacked(batch, i, [("m", width)]).T
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(batch, i)["docs"]), _rows(np.ascontiguousarray(rows))],
                                                 names=["doc_id", "z"])

    return _beside([blocks, z]).mapInArrow(run, "doc_id long, z array<double>")


def _mapped(rows: DataFrame, make) -> DataFrame:
    """(block, m) with m the columns that `make` makes of a batch's row."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([batch["block"].slice(i, 1), pa.array([make(batch, i).tobytes()], pa.binary())],
                                                 names=["block", "m"])

    return rows.mapInArrow(run, "block int, m binary")


def fit_lsa_wide(weights: DataFrame, k: int = 10, n_iter: int = 100, seed: int = 42, oversamples: int = 10,
                 tol: float = 1e-10, max_blocks: int = 30, factors: DataFrame | None = None) -> WideLsa:
    """The k leading right singular vectors and values of (doc_id, term_id, weight);
    fewer if the matrix has a lower rank. `factors` may give the same weights as products
    (doc_id, term_id, weight, term_scale, doc_scale: weight * term_scale / doc_scale)."""
    with shuffles_dropped(weights.sparkSession):
        return _fitted(weights if factors is None else factors, k, n_iter, seed, oversamples, tol, max_blocks)


def _fitted(weights: DataFrame, k: int, n_iter: int, seed: int, oversamples: int, tol: float, max_blocks: int) -> WideLsa:
    spark = weights.sparkSession
    own = weights.select("doc_id", "term_id", F.col("weight").cast("double").alias("weight"),
                         *(c for c in ("term_scale", "doc_scale") if c in weights.columns))
    found = own.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"))
    n, size = found.agg(F.count(F.lit(1)), F.sum("c")).first()
    if not n:
        terms = own.select("term_id").distinct()
        return WideLsa(np.zeros(0), terms.select("term_id", F.array().cast("array<double>").alias("loadings")), 0)
    n_blocks = max(-(-size // BLOCK_WEIGHTS), -(-n // TASK_ROWS))
    # a block for each core while the weights are few
    n_blocks = max(n_blocks, min(spark.sparkContext.defaultParallelism, -(-16 * size // BLOCK_WEIGHTS)))
    packed_at = scratch_path(spark, "blocks")
    blocks = _blocks(own.where("doc_id IS NOT NULL"), n_blocks, packed_at)
    buckets = _n_buckets(spark, n_blocks)

    def kept(rows: DataFrame) -> tuple[DataFrame, str]:
        at = scratch_path(spark, "basis")
        _add(rows, at, buckets)
        return spark.table(_table_of(at)), at

    sent, pairs = blocks.agg(F.sum("n_sent"), F.sum(F.length("terms")) / 4).first()
    # the numbers sent to and fro take no more than `SENT_BYTES` for each weight
    at_once = max(1, int(max(SENT_LEAST, SENT_BYTES * size) / (2 * max(1, sent)) - 4) // 8)
    width = min(n, k + oversamples)
    noise = F.array(*(F.xxhash64("doc_id", F.lit(seed), F.lit(j)).cast("double") / F.lit(2.0 ** 63) for j in range(width)))
    start, start_at = kept(_dealt(blocks, found.select("doc_id", noise.alias("q")), n_blocks))
    fix = np.eye(width)
    for _ in range(2):
        fix = fix @ _inverse(qr_factor(start, lambda x, i, f=fix, w=width: f.T @ _stacked(x, i, [("m", w)]), fix.shape[1]))
    basis = [kept(_mapped(start, lambda x, i, f=fix, w=width: f.T @ _stacked(x, i, [("m", w)])))]
    _drop(spark, start_at)
    # basis: a table for each pass; `widths` their columns; `t` = basis^T A^T A basis so far
    widths, t, passes = [fix.shape[1]], np.zeros((0, 0)), 0
    while True:
        m, b = sum(widths), widths[-1]
        groups = [slice(lo, min(b, lo + at_once)) for lo in range(0, b, at_once)]
        newest = [kept(_product(blocks, basis[-1][0], n_blocks, columns, b)) for columns in groups]
        passes += 1
        zs = [(f"z{j}", x.stop - x.start) for j, x in enumerate(groups)]
        qs = [(f"q{j}", w) for j, w in enumerate(widths)]
        both = _beside([x.withColumnRenamed("m", name) for (x, _), (name, _) in zip([*newest, *basis], [*zs, *qs], strict=True)])
        c = _summed(both, lambda x, i, zs=zs, qs=qs: _stacked(x, i, qs) @ _stacked(x, i, zs).T, m, b)

        def rest(x, i, c=c, zs=zs, qs=qs):
            return _stacked(x, i, zs) - c.T @ _stacked(x, i, qs)

        c = c + _summed(both, lambda x, i, rest=rest, qs=qs: _stacked(x, i, qs) @ rest(x, i).T, m, b)
        rest = lambda x, i, c=c, zs=zs, qs=qs: _stacked(x, i, zs) - c.T @ _stacked(x, i, qs)
        grown = np.zeros((m, m))
        grown[:m - b, :m - b] = t
        grown[:, m - b:] = c
        grown[m - b:, :] = c.T
        t = grown
        evals, evecs = np.linalg.eigh((t + t.T) / 2)
        order = np.argsort(evals)[::-1][:k]
        evals, evecs = evals[order], evecs[:, order]
        r = qr_factor(both, rest, b)
        # A^T A basis = basis t + rest E', so a Ritz pair's residual is r times its last rows
        residual = np.linalg.norm(r @ evecs[m - b:], axis=0)
        top = max(float(evals[0]), 1e-300)
        fix = _inverse(r / max(top, 1e-300)) / max(top, 1e-300)
        done = (len(evals) == k and np.all(residual <= tol * top)) or not fix.shape[1] or passes >= max(1, n_iter)
        if done or len(widths) >= max_blocks:
            break
        # made orthonormal twice: a nearly converged rest is badly conditioned
        second = _inverse(qr_factor(both, lambda x, i, f=fix, rest=rest: f.T @ rest(x, i), fix.shape[1]))
        fix = fix @ second
        basis.append(kept(_mapped(both, lambda x, i, f=fix, rest=rest: f.T @ rest(x, i))))
        _drop(spark, *(at for _, at in newest))
        widths.append(fix.shape[1])
    _drop(spark, *(at for _, at in newest))
    rank = int(np.sum(evals > 1e-12 * max(evals[0], 1e-300)))
    v, values = evecs[:, :rank], np.sqrt(np.clip(evals[:rank], 0, None))
    left, left_at = kept(_mapped(_beside([x.withColumnRenamed("m", name) for (x, _), (name, _) in zip(basis, qs, strict=True)]),
                                 lambda x, i, f=v / values, qs=qs: f.T @ _stacked(x, i, qs)))
    _drop(spark, *(at for _, at in basis))
    # terms of documents without an id have rows of zeros
    idless = own.where("doc_id IS NULL").select("term_id", *(F.lit(0.0).alias(f"s{j}") for j in range(rank)))
    raw_at, slices = scratch_path(spark, "components"), -(-int(pairs * 8 * max(1, rank)) // int(max(SENT_LEAST, SENT_BYTES * size)))
    with_q = _beside([blocks, left.withColumnRenamed("m", "q")])
    for s in range(slices):
        rows = with_q.mapInArrow(_loader(rank, s, slices), "term_id int" + "".join(f", s{j} double" for j in range(rank))).unionByName(idless.where(F.pmod("term_id", F.lit(slices)) == s))
        rows.groupBy("term_id").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(rank))).select(
            "term_id", (F.array(*(F.col(f"s{j}") for j in range(rank))) if rank else F.array().cast("array<double>")).alias("q")
        ).write.mode("append").parquet(raw_at)
    raw = spark.read.parquet(raw_at)
    _drop(spark, left_at, packed_at)
    # the largest loading of every component is positive
    pivots = raw.agg(*(F.max_by(F.col("q")[j], F.struct(F.abs(F.col("q")[j]), -F.col("term_id"))).alias(f"p{j}")
                       for j in range(rank))).first() if rank else []
    signed = [(F.col("q")[j] * F.lit(-1.0 if pivots[j] < 0 else 1.0)) for j in range(rank)]
    loadings = F.array(*signed) if rank else F.array().cast("array<double>")
    return WideLsa(values, raw.select("term_id", loadings.alias("loadings")), passes)
