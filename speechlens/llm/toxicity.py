"""Toxicity by a gap-weighted subsequence string kernel and a support vector
machine on Nyström landmarks.

The kernel of two strings sums, over common subsequences of three characters,
`DECAY ** span` of both occurrences, and is normalised; inserted or dropped
characters cost a factor, not the match. Strings are lower-cased UTF-8 words
(and runs of single letters put together again), trimmed of edge punctuation; a
text is as toxic as its most toxic word.

Training uses a bounded sample of labelled texts, split into sentences. A
sentence of a clean text is clean; of a toxic text the sentence with the highest
score carries the label through its highest word (multiple-instance learning):
landmarks are toxic witnesses and the clean words that score highest, words are
mapped by K_mm^(-1/2) k(x, landmarks), a squared-hinge linear SVM is fitted, and
witnesses and hard clean words are chosen again. A logistic map fitted on texts
kept apart turns margins into probabilities.

The SVM's decision is a weighted sum of kernels with the landmarks, and the
kernel is an inner product of explicit subsequence weights, so scoring needs one
table over subsequences (2^18 entries) and each word's own subsequences. Words
are scored once per task where they repeat; texts are read whole, in tasks.

Defined cases: null and empty texts have no words and get the least score;
without toxic labels every score is 0; words over 24 bytes are scored by
overlapping pieces; texts of any length are scored whole; of words that tie as a
text's witness the first in the alphabet is taken; repeated rows are scored each;
further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, lean
from .shingles import chunks, text_bytes, word_parts

DECAY = 0.5
ORDER = 3
LONGEST = 24
LABELLED_BOUND = 1_500  # labelled texts of each class
CUT = 0.3
NONE = -2.0  # margin of a text without words
SIZE = 1 << 18
#: triples of characters held at a time; a long word has some two thousand
TRIPLES = 1 << 18

# six bits a byte: letters, digits, punctuation, and five bits of bytes beyond ASCII
_CODE = np.full(256, 28, dtype=np.int32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[48:58] = 27
_CODE[128:] = 32 + (np.arange(128, 256) & 31)
_EDGE = np.zeros(256, dtype=bool)
_EDGE[list(b".,;:!?\"'()[]{}<>*$%&#-_|")] = True
_TRIPLES = {n: np.array(list(itertools.combinations(range(n), ORDER)), dtype=np.int32).reshape(-1, ORDER)
            for n in range(LONGEST + 1)}
_WEIGHT = DECAY ** np.arange(64, dtype=np.float64)


def subsequences(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of equal length [n, length] as codes: (row, subsequence, weight)
    with one entry per different subsequence of a word, weights normalised."""
    t = _TRIPLES[chars.shape[1]]
    span = t[:, 2] - t[:, 0] + 1
    packed = (((chars[:, t[:, 0]] << 6 | chars[:, t[:, 1]]) << 6 | chars[:, t[:, 2]]) << 5) | span
    packed = np.sort(packed, axis=1)
    code = packed >> 5
    first = np.ones(code.shape, dtype=bool)
    first[:, 1:] = code[:, 1:] != code[:, :-1]
    at = np.flatnonzero(first)
    weight = np.add.reduceat(_WEIGHT[packed.ravel() & 31], at)
    row = at // code.shape[1]
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(chars)))
    return row, code.ravel()[at], weight / norm[row]


def margins(chars: list[bytes] | np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """SVM decision of each word; words are bytes without edge punctuation."""
    out = np.full(len(chars), NONE)
    lens = np.array([len(w) for w in chars])
    for n in np.unique(lens[(lens >= ORDER) & (lens <= LONGEST)]):
        own, step = np.flatnonzero(lens == n), max(1, TRIPLES // len(_TRIPLES[n]))
        for k in range(0, len(own), step):
            part = own[k:k + step]
            x = _CODE[np.frombuffer(b"".join(chars[i] for i in part), dtype=np.uint8)].reshape(len(part), n)
            row, code, weight = subsequences(x)
            out[part] = np.bincount(row, weight * table[code], minlength=len(part)) + bias
    for i in np.flatnonzero(lens > LONGEST):
        step = LONGEST // 2
        pieces = list(dict.fromkeys(chars[i][k:k + LONGEST] for k in range(0, len(chars[i]) - step, step)))
        out[i] = margins([p for p in pieces if len(p) >= ORDER], table, bias).max()
    return out


_TRIM = bytes(np.flatnonzero(_EDGE).astype(np.uint8))


def _single_runs(raw: bytes) -> list[bytes]:
    """Runs of three or more single characters with white space between, joined."""
    return [b"".join(m[0].split()) for m in re.finditer(rb"(?<!\S)(?:\S\s+){2,}\S(?!\S)", raw)]


def words_of(raw: bytes) -> list[bytes]:
    words = [w.strip(_TRIM) for w in raw.lower().split()]
    return [w for w in words if w] + _single_runs(raw.lower())


@dataclass(frozen=True)
class ToxicityModel:
    table: np.ndarray  # float32, by subsequence
    bias: float
    slope: float
    offset: float
    landmarks: tuple = ()

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _landmark_matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(column of each subsequence or -1, [columns, words] explicit weights)."""
    entries = []
    for j, w in enumerate(words):
        _, code, weight = subsequences(_CODE[np.frombuffer(w, dtype=np.uint8)][None, :])
        entries.append((code, weight, np.full(len(code), j)))
    code, weight, j = (np.concatenate(v) for v in zip(*entries, strict=True))
    used, inverse = np.unique(code, return_inverse=True)
    column = np.full(SIZE, -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    m = np.zeros((len(used), len(words)), dtype=np.float32)
    m[inverse, j] = weight
    return column, m


def _kernel(words: list[bytes], column: np.ndarray, m: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), m.shape[1]), dtype=np.float32)
    lens = np.array([len(w) for w in words])
    for n in np.unique(lens):
        # a triple takes a row of the landmark matrix
        own, step = np.flatnonzero(lens == n), max(1, TRIPLES // (16 * len(_TRIPLES[n])))
        for k in range(0, len(own), step):
            part = own[k:k + step]
            x = _CODE[np.frombuffer(b"".join(words[i] for i in part), dtype=np.uint8)].reshape(len(part), n)
            row, code, weight = subsequences(x)
            c = column[code]
            row, c, weight = row[c >= 0], c[c >= 0], weight[c >= 0]
            if len(row):
                firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                out[part[row[firsts]]] = np.add.reduceat(m[c] * weight[:, None].astype(np.float32), firsts, axis=0)
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, *, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights (last: bias) of the squared hinge loss, by Newton steps on the
    points inside the margin."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        slack = 1 - y * (a @ w)
        on = slack > 0
        b = a[on] * cost[on, None]
        new = np.linalg.solve(b.T @ a[on] + penalty, b.T @ y[on])
        if np.abs(new - w).max() < 1e-5:
            break
        w = new if not w.any() else 0.5 * w + 0.5 * new
    return w


def _numbered(text: bytes, number: dict[bytes, int]) -> np.ndarray:
    """The numbers of the different words of a text's sentences that can be scored."""
    own = {w for s in re.split(rb"(?<=[.!?])\s+|\n+", text) for w in words_of(s) if ORDER <= len(w) <= LONGEST}
    return np.array([number.setdefault(w, len(number)) for w in sorted(own)], dtype=np.int32)


def _margins_of(bags: list[np.ndarray], words: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    """The margin of every word in the bags, by its number; NONE for the others."""
    out, some = np.full(len(words), NONE), np.unique(np.concatenate([np.zeros(0, np.int32), *bags]))
    out[some] = margins([words[i] for i in some], table, bias)
    return out


def fit_words(texts: list[tuple[bytes, int]], *, n_landmarks: int = 256, rounds: int = 4, seed: int = 11) -> ToxicityModel | None:
    """Fit on (text, toxic) pairs; None without texts of both classes."""
    rng = np.random.default_rng(seed)
    # a text is an array of the numbers of its different words, in the words' order
    number: dict[bytes, int] = {}
    bags = [_numbered(t, number) for t, _ in texts]
    words = list(number)
    y = np.array([v for _, v in texts])
    apart = np.arange(len(texts)) % 4 == 3 if len(texts) >= 40 else np.zeros(len(texts), bool)
    toxic = [b for b, v, a in zip(bags, y, apart, strict=True) if v == 1 and not a]
    count = lambda some: np.bincount(np.concatenate([np.zeros(0, np.int32), *some]), minlength=len(words))
    clean = count([b for b, v, a in zip(bags, y, apart, strict=True) if v == 0 and not a])
    dirty = count(toxic)
    if not dirty.any() or not clean.any():
        return None
    clean_words = sorted(words[i] for i in np.flatnonzero(clean))
    # first witnesses: the word of each toxic text whose share of toxic texts is highest
    odds = (dirty / len(toxic)) / (clean / max(sum((y == 0) & ~apart), 1) + 1 / len(texts))
    witness = [words[b[np.argmax(odds[b])]] for b in toxic if len(b)]
    hard = [clean_words[i] for i in rng.permutation(len(clean_words))[:3000]]
    model = None
    for k in range(rounds):
        weight = Counter(witness)
        pos = sorted(weight, key=lambda w: (-weight[w], w))
        landmarks = pos[:n_landmarks * 5 // 8] + hard[:n_landmarks * 3 // 8]
        column, m = _landmark_matrix(landmarks)
        gram = (m.T @ m).astype(float)
        value, vector = np.linalg.eigh(gram)
        keep = value > 1e-4 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])  # K_mm^(-1/2) on its range
        neg = list(dict.fromkeys(hard))
        x = _kernel(pos + neg, column, m) @ root
        target = np.r_[np.ones(len(pos)), -np.ones(len(neg))]
        cost = np.r_[np.array([weight[w] for w in pos], float), np.ones(len(neg))]
        cost[:len(pos)] *= len(neg) / cost[:len(pos)].sum()
        w = _svm(x, target, cost)
        table = np.zeros(SIZE, dtype=np.float32)
        table[column >= 0] = (m @ (root @ w[:-1]).astype(np.float32))[column[column >= 0]]
        model = ToxicityModel(table, float(w[-1]), 1.0, 0.0, tuple(landmarks))
        if k + 1 < rounds:
            # the highest word carries a toxic text's label
            margin = _margins_of(toxic, words, table, model.bias)
            witness = [words[b[np.argmax(margin[b])]] for b in toxic if len(b)]
            scores = margins(clean_words, table, model.bias)
            worst = [clean_words[i] for i in np.argsort(-scores, kind="stable")[:2500]]
            hard = list(dict.fromkeys(worst + hard))[:6000]
    assert model is not None
    used = apart if apart.any() else ~apart
    held = [b for b, u in zip(bags, used, strict=True) if u]
    margin = _margins_of(held, words, model.table, model.bias)
    top = np.array([max(NONE, margin[b].max(initial=NONE)) for b in held])
    slope, offset = _platt(top, y[used])
    return ToxicityModel(model.table, model.bias, slope, offset, model.landmarks)


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset, with Platt's smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * np.array([w[0] - 1.0, 0.0]))
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        where: Column | None = None, bound: int = LABELLED_BOUND) -> ToxicityModel | None:
    """Learn from at most about `bound` labelled texts of each class."""
    rows = labelled(lean(docs), labels, label, id_col=id_col, text_col=text_col, bound=bound, where=where).collect()
    rows = sorted(rows, key=lambda r: (str(r["id"]), r["text"] or ""))
    return fit_words([((r["text"] or "").encode(), r["y"]) for r in rows])


class _Scorer:
    """Highest word margin per text; remembers the words a task has seen."""

    REMEMBER = 400_000

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.known = np.zeros(0, dtype=np.uint64)
        self.margin = np.zeros(0, dtype=np.float32)

    def _look_up(self, words: np.ndarray, first: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, words)
        at[at == len(self.known)] = 0
        out = self.margin[at] if len(self.known) else np.zeros(len(words), np.float32)
        new = np.flatnonzero(self.known[at] != words) if len(self.known) else np.arange(len(words))
        if len(new):
            text = [raw[starts[i]:ends[i]].tobytes().lower().strip(_TRIM) for i in first[new]]
            out[new] = margins(text, self.model.table, self.model.bias)
            if len(self.known) > self.REMEMBER:
                self.known, self.margin = self.known[:0], self.margin[:0]
            merged = np.concatenate([self.known, words[new]])
            order = np.argsort(merged)
            self.known, self.margin = merged[order], np.concatenate([self.margin, out[new]])[order]
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, NONE)
        words, bounds, starts, ends = word_parts(data, offsets)
        if not len(words):
            return out
        raw = data[offsets[0]:offsets[-1]]
        unique, first, inverse = np.unique(words, return_index=True, return_inverse=True)
        margin = self._look_up(unique, first, raw, starts, ends)[inverse]
        some = np.flatnonzero(np.diff(bounds) > 0)
        out[some] = np.maximum.reduceat(margin, bounds[some])
        # words spelled with white space: runs of three or more words of one byte
        single = (ends - starts == 1).astype(np.int64)
        if len(single) >= 3:
            run = np.flatnonzero(single[2:] & single[1:-1] & single[:-2])
            for i in np.unique(np.searchsorted(bounds, run, side="right") - 1):
                joined = _single_runs(data[offsets[i]:offsets[i + 1]].tobytes().lower())
                if joined:
                    out[i] = max(out[i], margins(joined, self.model.table, self.model.bias).max())
        return out


def _score_chunks(model: ToxicityModel | None, column: int, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    scorer = _Scorer(model) if model is not None else None
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for a, b in chunks(offsets):
            p = model.probability(scorer(data, offsets[a:b + 1])) if model is not None and scorer is not None else np.zeros(b - a)
            yield batch.slice(a, b - a), p


def score(docs: DataFrame, model: ToxicityModel | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, p in _score_chunks(model, 1, batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64()), pa.array((p >= CUT).astype(np.int32))],
                                             names=["id", "score", "predicted"])

    id_type = dict(docs.dtypes)[id_col]
    return lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, *, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is not predicted toxic."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, p in _score_chunks(model, place, batches):
            yield part.filter(pa.array(p < CUT))

    return lean(docs).mapInArrow(run, docs.schema)
