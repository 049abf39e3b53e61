"""Quality by Bradley-Terry ranking: scores learned from preference pairs.

A document has a vector of text statistics (lengths, character classes,
repetition of words, word runs and lines). Every pair of a good and a bad
labelled document is a preference; the probability that one is preferred is the
logistic function of the score difference, so the weights come from a logistic
loss on feature differences. The cut between good and bad is the quantile of the
training scores that leaves out the labelled share of bad documents, and the
published score maps that cut to 0.3.

The fit uses every labelled document, and all pairs without forming them: a pair
counts by its score difference only, so a Newton step needs the documents' counts and
moments by score, in bins of 1/`BINS` whose mean scores stand for their documents'
(a gradient within some 1e-5 of that pair by pair). Tasks sum the bins; the driver
gets one row a bin. The quantile is exact. Every text is scored whole, in tasks,
without a shuffle.

Defined cases: null and empty texts have all-zero statistics and still get a
score; without labels of both classes the score is 0.5 everywhere; texts of any
length are measured whole; equal scores are on the same side of the cut; repeated rows
are scored each; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, label_values, lean, written
from .shingles import U, chunks, mix64, text_bytes, word_hashes

#: score bins a unit, in which the pairs of a Newton step are summed
BINS = 64
#: ids up to this number are broadcast, so that only labelled texts are measured; the statistics of all texts are joined with more
BROADCAST_IDS = 1_000_000
#: scores read at the quantile
LAST_SCORES = 10_000
CUT = 0.3

_CLASS = np.zeros((256, 9), dtype=np.float32)
for _i, _set in enumerate((
        range(97, 123), range(65, 91), range(48, 58), (32,), (10,), range(128, 256), b".,;:?'\"()-", b"!", b"#$%&*|@^~<>=+/\\{}[]_`")):
    _CLASS[list(_set), _i] = 1
N_FEATURES = 20


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES text statistics per text."""
    out = np.zeros((len(offsets) - 1, N_FEATURES))
    words, bounds = word_hashes(data, offsets)
    for i in range(len(out)):
        raw = data[offsets[i]:offsets[i + 1]]
        w = words[bounds[i]:bounds[i + 1]]
        if not len(raw) or not len(w):
            continue
        share = (np.bincount(raw, minlength=256) @ _CLASS) / len(raw)
        n = len(w)
        _, counts = np.unique(w, return_counts=True)
        triples = len(np.unique(mix64(w[:-2] * U(3) + w[1:-1] * U(5) + w[2:]))) / (n - 2) if n > 3 else 1.0
        lines = [x for x in raw.tobytes().split(b"\n") if x.strip()]
        out[i] = [
            np.log1p(n), len(raw) / n, len(counts) / n, counts.max() / n, (w[1:] == w[:-1]).mean() if n > 1 else 0.0,
            1 - triples, 1 - len(set(lines)) / len(lines) if lines else 0.0, np.log1p(len(raw) / max(len(lines), 1)),
            *share, share[1] / (share[0] + share[1] + 1e-6), share[7] * len(raw) / n, share[8] * len(raw) / n]
    return out


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.centre) / self.scale, -6, 6) @ self.weight
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.cut) + np.log(CUT / (1 - CUT)), -30, 30)))


def _collect_statistics(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in chunks(offsets):
            x = statistics(data, offsets[a:b + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "x"])


def _bin_moments(w: np.ndarray, centre: np.ndarray, scale: np.ndarray):
    """A task's rows (y, bin, moments): number, sum and sum of squares of the scaled
    statistics of its documents in each score bin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.clip((_matrix(batch.column(1)) - centre) / scale, -6, 6)
            key = 2 * np.floor(x @ w * BINS).astype(np.int64) + batch.column(0).to_numpy()
            order = np.argsort(key, kind="stable")
            keys, firsts = np.unique(key[order], return_index=True)
            for k, v in zip(keys.tolist(), np.split(x[order], firsts[1:]), strict=True):
                own = np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()])
                sums[k] = sums[k] + own if k in sums else own
        yield _moment_rows(sums)

    return run


def _moment_rows(sums: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                                      names=["bin", "moments"])


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict = {}
    for batch in batches:
        for k, own in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)), strict=True):
            sums[k] = sums[k] + own if k in sums else own
    yield _moment_rows(sums)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _newton_step(moments: dict[int, np.ndarray], w: np.ndarray, ridge: float) -> np.ndarray:
    """The step on the mean loss of all pairs, from the moments by bin."""
    n = len(w)
    good, bad = (np.array([m for k, m in sorted(moments.items()) if k % 2 == y]) for y in (1, 0))
    ng, nb, sg, sb = good[:, 0], bad[:, 0], good[:, 1:n + 1], bad[:, 1:n + 1]
    p = 1 / (1 + np.exp(-np.clip((sg @ w / ng)[:, None] - (sb @ w / nb)[None, :], -30, 30)))
    pairs = ng.sum() * nb.sum()
    grad = (((p - 1) @ nb) @ sg - (ng @ (p - 1)) @ sb) / pairs + ridge * w
    k = p * (1 - p)
    cross = sg.T @ k @ sb
    square = (k @ nb) @ good[:, n + 1:] + (ng @ k) @ bad[:, n + 1:]
    hessian = (square.reshape(n, n) - cross - cross.T) / pairs
    return np.linalg.solve(hessian + (ridge + 1e-6) * np.eye(n), grad)


def _quantile_cut(scores: DataFrame, share: float, mass: dict[int, float]) -> float:
    """The cut of (y, s): the first score up to which the scores have `share` of the
    mass, or midway to the next one if they have no more. Bins narrow until few scores
    are left, so none but those around the cut are read."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    left, below = scores, 0.0
    while True:
        some = left.groupBy("s", "y").agg(F.count(F.lit(1)).alias("n"))
        last = some.limit(LAST_SCORES + 1).collect()
        if len(last) <= LAST_SCORES:
            break
        at = F.least(F.floor((F.col("s") - F.lit(low)) / F.lit(high - low) * F.lit(1000)), F.lit(999))
        bins = left.groupBy(at.alias("at"), "y").agg(F.count(F.lit(1)).alias("n")).collect()
        per: dict = {}
        for r in bins:
            per[r["at"]] = per.get(r["at"], 0.0) + r["n"] * mass[r["y"]]
        for k in sorted(per):
            if below + per[k] >= share - 1e-12 or k == max(per):
                break
            below += per[k]
        left = left.where(at == k)
        low, high = left.agg(F.min("s"), F.max("s")).first()
    for v in sorted({r["s"] for r in last}):
        below += sum(r["n"] * mass[r["y"]] for r in last if r["s"] == v)
        if below >= share - 1e-12:
            break
    least = min(mass[r["y"]] for r in last if r["s"] == v)
    above = scores.where(F.col("s") > F.lit(v)).agg(F.min("s")).first()[0]
    return v if above is None or below - share >= least * (1 - 1e-6) else (v + above) / 2


def fit_pairs(rows: DataFrame, *, bad_share: float | None = None, ridge: float = 1e-2) -> QualityModel:
    """Bradley-Terry weights from all (good, bad) pairs of the statistics (y, x)."""
    by_class = {r["y"]: r for r in rows.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(N_FEATURES)),
        *(F.stddev_pop(F.col("x")[i]).alias(f"d{i}") for i in range(N_FEATURES))).collect()}
    if len(by_class) < 2:
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), -np.log((1 - CUT) / CUT), 1.0)
    # sums differ in their last digits with the order of the rows, the model does not
    centre, good, bad = (np.round([by_class[y][f"{c}{i}"] for i in range(N_FEATURES)], 10) for y, c in ((1, "m"), (1, "d"), (0, "d")))
    scale = good + 1e-3 + 0.05 * bad
    w = np.zeros(N_FEATURES)
    for _ in range(30):
        sums = rows.mapInArrow(_bin_moments(w, centre, scale), "bin long, moments array<double>")
        moments = {r["bin"]: np.array(r["moments"]) for r in sums.repartition("bin").mapInArrow(_merged, sums.schema).collect()}
        step = _newton_step(moments, w, ridge)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    w = np.round(w, 9)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.round(np.clip((_matrix(batch.column(1)) - centre) / scale, -6, 6) @ w, 10)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["y", "s"])

    n = {y: by_class[y]["n"] for y in (0, 1)}
    share = n[0] / (n[0] + n[1]) if bad_share is None else bad_share
    # quantile of the labelled scores, the classes weighted as they are labelled
    cut = _quantile_cut(written(rows.mapInArrow(scored, "y int, s double"), "quality-scores"), share,
                        {0: share / n[0], 1: (1 - share) / n[1]})
    return QualityModel(centre, scale, w, float(cut), 1.0)


def labelled_statistics(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label: str,
                        where: Column | None = None) -> DataFrame:
    """(y, x): the statistics of every labelled document, written once."""
    own = durable(label_values(labels, label, id_col=id_col, where=where))
    n = own.count()
    texts = lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = own.withColumnRenamed(id_col, "id")
    id_type = dict(docs.dtypes)[id_col]
    few = n <= BROADCAST_IDS
    if few:
        texts = texts.join(F.broadcast(own.select("id")), "id", "left_semi")
    x = texts.mapInArrow(_collect_statistics, f"id {id_type}, x array<double>")
    rows = x.join(F.broadcast(own) if few else own, "id").select("y", "x")
    return written(rows, "quality-statistics")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        where: Column | None = None) -> QualityModel:
    """Learn from all labelled documents; `where` selects rows of `labels`."""
    some = labels.where(F.col(label).isNotNull())
    some = some.where(where) if where is not None else some
    share = some.agg(F.avg((F.col(label) == 0).cast("double"))).first()[0]
    return fit_pairs(labelled_statistics(docs, labels, id_col=id_col, text_col=text_col, label=label, where=where), bad_share=share)


def score(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                s = model.score(statistics(data, offsets[a:b + 1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s, pa.float64()),
                                                  pa.array((s >= CUT).astype(np.int32))], names=["id", "score", "predicted"])

    id_type = dict(docs.dtypes)[id_col]
    return lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)
