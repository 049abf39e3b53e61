"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader.

Features are hashed 1-, 2- and 3-grams of lower-cased letters (anything else is
a space), tf relative to the text's n-grams. Document frequencies come from all
training texts: a task marks its documents' buckets and Spark adds the counts.
The weights are fitted by FTRL-proximal with elastic-net penalties (L1 leaves
most buckets at zero) on a bounded sample of labelled texts, and a temperature
fitted on a part kept apart calibrates the probabilities. The languages are those
of all training texts, and the sample is bounded for each: of a rare language it
takes every text, of a frequent one so many that about `SAMPLE_BOUND` result (at
least `LEAST` each, however many languages there are). The biases weigh the
languages by their shares of all training texts. Since tf is relative,
a text's logits are sums of table look-ups over its n-grams: scoring is one pass
over whole texts, without a shuffle.

Defined cases: a null text or one without a letter is `und` with score 1;
without any labelled text everything is `und` with score 0; repeated rows are
scored each; texts of any length are
read whole, in pieces of a batch; of equally likely languages the first in the alphabet
is predicted; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import collected, durable, lean
from .shingles import chunks, text_bytes

BITS = 15
BUCKETS = 1 << BITS
SAMPLE_BOUND = 4_000
LEAST = 50
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """Lower-case code of every letter of the basic plane, 32 for the rest."""
    out = np.full(0x10000, 32, dtype=np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_LETTERS = _letters()


def codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of a chunk of texts and their bounds, in code points."""
    raw = data[offsets[0]:offsets[-1]]
    chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    out = _LETTERS[np.minimum(chars, 0xFFFF)]
    far = np.flatnonzero(chars > 0xFFFF)
    if len(far):
        out = out.copy()
        out[far] = [ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in chars[far].tolist()]
    return out, starts[offsets - offsets[0]]


def buckets(letters: np.ndarray) -> np.ndarray:
    """Buckets [3, n] of the 1-, 2- and 3-grams starting at each code; the last
    codes, and n-grams that cross into the next text, are masked by `spans`."""
    x = letters.astype(np.uint32)
    pad = np.concatenate([x, np.full(2, 32, np.uint32)])
    one = x * np.uint32(2654435761)
    two = (one ^ (pad[1:-1] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two ^ (pad[2:] * np.uint32(668265263))) * np.uint32(374761393)
    shift = np.uint32(32 - BITS)
    return np.stack([(h ^ (h >> np.uint32(15))) * np.uint32(2246822507) >> shift for h in (one, two + np.uint32(1), three + np.uint32(2))])


def _grams(letters: np.ndarray, grams: np.ndarray, a: int, b: int) -> np.ndarray:
    """The n-grams of one text that hold a letter at their start, or none."""
    own = letters[a:b] != 32
    parts = [grams[k, a:b - k][own[:b - a - k]] for k in range(3) if b - a - k > 0]
    return np.concatenate(parts) if parts else grams[0, :0]


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for a, b in chunks(offsets):
            letters, bounds = codes(data, offsets[a:b + 1])
            grams = buckets(letters)
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                mark = np.zeros(BUCKETS, dtype=bool)
                mark[_grams(letters, grams, s, e)] = True
                df += mark
                n += 1
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(df[some], n), pa.int64())],
                                     names=["bucket", "df"])


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in chunks(offsets):
            letters, bounds = codes(data, offsets[a:b + 1])
            grams = buckets(letters)
            rows = [np.unique(_grams(letters, grams, s, e), return_counts=True)
                    for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                pa.array([(r[1] / max(r[1].sum(), 1)).astype(np.float32) for r in rows], pa.list_(pa.float32()))],
                names=["id", "lang", "bucket", "tf"])


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple
    weight: np.ndarray  # [BUCKETS, languages], idf and temperature included
    bias: np.ndarray
    nonzero: int = 0
    temperature: float = 1.0


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, idf: np.ndarray, *,
             alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 3,
             seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (buckets, tf) rows; returns weights and bias. Features
    are tf * idf scaled by 100, since relative frequencies are small."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            i = np.append(rows[r][0], BUCKETS)
            x = np.append(rows[r][1] * idf[rows[r][0]] * 100, 1.0)
            w = weights(i)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y[r]] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1] * idf[:, None] * 100, w[-1]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section over its logarithm."""
    if not len(y):
        return 1.0

    def loss(u: float) -> float:
        v = logits / np.exp(u)
        v = v - v.max(axis=1, keepdims=True)
        return float((np.log(np.exp(v).sum(axis=1)) - v[np.arange(len(y)), y]).mean() + 1e-4 * u * u)

    lo, hi, ratio = -2.5, 2.5, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _quota(counts: list[int], bound: int) -> int:
    """The most texts of a language such that all languages give at most `bound`, or LEAST."""
    left, quota = bound, 0
    for k, n in enumerate(sorted(counts)):
        quota = left // (len(counts) - k)
        if n > quota:
            return max(quota, LEAST)
        left -= n
    return max(counts, default=0)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        where: Column | None = None, bound: int = SAMPLE_BOUND) -> LanguageModel:
    """Learn from the rows with a language (and `where`): document frequencies
    and shares of the languages from all of them, weights from at most about
    `bound`, or LEAST of each language."""
    own = lean(docs).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    own = own.where(where) if where is not None else own
    df = collected(own.select(F.col(text_col).alias("text")).mapInArrow(_document_counts, "bucket int, df long").groupBy("bucket").agg(
        F.sum("df").alias("df")))  # at most BUCKETS + 1 rows
    count = np.zeros(BUCKETS)
    known = df["bucket"].to_numpy() >= 0
    count[df["bucket"].to_numpy()[known]] = df["df"].to_numpy()[known]
    total = int(df["df"].to_numpy()[~known].sum())
    id_type = dict(docs.dtypes)[id_col]
    legible = own.where(F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    per = durable(legible.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    of = {r["lang"]: r["n"] for r in per.collect()}  # a row for each language
    languages = tuple(sorted(of))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    parts, quota = 1 << 30, _quota(list(of.values()), bound)
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.col("text")), F.lit(1)), F.lit(parts))
    picked = legible.join(F.broadcast(per), "lang").where((F.col("n") <= quota) | (draw < F.lit(float(parts * quota)) / F.col("n")))
    rows = collected(picked.select("id", "text", "lang").mapInArrow(
        _features, f"id {id_type}, lang string, bucket array<int>, tf array<float>"))
    rows = rows[rows["bucket"].map(len) > 0].sort_values("id", kind="stable")
    idf = np.log((1 + total) / (1 + count)) + 1
    y = np.array([languages.index(v) for v in rows["lang"]], dtype=np.int64)
    x = [(b.astype(np.int64), t.astype(float)) for b, t in zip(rows["bucket"], rows["tf"], strict=True)]
    # every fifth text of a language is kept apart, its first ones are not
    apart = rows.groupby("lang").cumcount().to_numpy() % 5 == 4 if len(x) >= 20 else np.zeros(len(x), bool)
    learn = np.flatnonzero(~apart)
    w, bias = fit_ftrl([x[i] for i in learn], y[learn], len(languages), idf)
    logits = np.array([t @ w[b] + bias for b, t in (x[i] for i in np.flatnonzero(apart))]).reshape(-1, len(languages))
    heat = _temperature(logits, y[apart])
    true, own_share = np.array([of[v] for v in languages], float), np.maximum(np.bincount(y, minlength=len(languages)), 1.0)
    prior = np.log(true / true.sum()) - np.log(own_share / own_share.sum())
    return LanguageModel(languages, (w / heat).astype(np.float32), bias / heat + prior, int((w != 0).any(axis=1).sum()), heat)


def predict(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                letters, bounds = codes(data, offsets[a:b + 1])
                grams = buckets(letters)
                own = letters != 32
                best, score = np.full(b - a, len(names) - 1), np.ones(b - a)
                for i, (s, e) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    if e <= s or not own[s:e].any():
                        continue
                    if not model.languages:
                        score[i] = 0.0
                        continue
                    g = _grams(letters, grams, s, e)
                    logit = np.bincount(g, minlength=BUCKETS) @ model.weight / len(g) + model.bias if len(g) > BUCKETS // 8 \
                        else model.weight[g].sum(axis=0, dtype=float) / len(g) + model.bias
                    p = np.exp(logit - logit.max())
                    best[i], score[i] = p.argmax(), p.max() / p.sum()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    names=["id", "lang_pred", "score"])

    id_type = dict(docs.dtypes)[id_col]
    return lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
