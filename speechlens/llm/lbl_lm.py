"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation.

Counts of all words cover the whole corpus (training and other documents), keyed
by a 64-bit hash; they give the base model (add 0.1) and the classes: the most
frequent words and the end of a text are classes of their own, all other words
fall into classes by their last three bytes. The log-bilinear model predicts a
token's class from the two classes before it: context vectors times position
matrices, dotted with the class's own vector, plus a bias. It is trained in
numpy by NCE, the noise being the class frequencies of the whole corpus: at first
on a sample of about `SAMPLE_TOKENS` tokens, which is all of a small corpus. In a
larger one this is only the start: every task goes on from there over all
training texts of its partition, and the parameters are averaged by tokens. Its probabilities are normalised exactly: with
two context positions, the sum over classes for every pair of contexts is one
matrix product. Inside a class of rare words a word has its base share
(c + 0.1) / (sum of c + 0.1 over the class + 0.1), the last 0.1 for a word never seen,
so the probabilities of all words and one unseen word per class sum to one.

Counts of frequent words (`HEAD_WORDS` at most) go to the tasks; the others are
joined by the word's hash, so the vocabulary is never gathered.

Defined cases: a null text is empty (its end alone is scored); without training
documents the base is 0 and classes are uniform; repeated rows count and are
scored each; texts of any length are scored whole; equally frequent words take
their classes by hash; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import collected, lean, sampled, written
from .shingles import U, chunks, mix64, text_bytes, word_parts

TOP_WORDS = 767
REST = 256
CLASSES = 1 + TOP_WORDS + REST  # end of text, top words, rest classes
HEAD_WORDS = 1 << 16
SAMPLE_TOKENS = 1_000_000
WIDTH = 40
EPOCHS = 3
FLUSH = 400_000
SHARED = 64  # noise words of a batch in the pass over all texts
SUMS = 16  # rows of added-up parameters that the driver gets
ADD = 0.1


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, rest class 0..REST-1 from the last three bytes)."""
    hashes, bounds, starts, ends = word_parts(data, offsets)
    raw = data[offsets[0]:offsets[-1]]
    tail = np.zeros(len(hashes), dtype=U)
    for k in (1, 2, 3):
        at = ends - k
        byte = raw[np.maximum(at, 0)].astype(U)
        byte += ((byte >= 65) & (byte <= 90)) * U(32)
        tail = tail * U(257) + np.where(at >= starts, byte + U(1), U(0))
    return hashes, bounds, (mix64(tail) % U(REST)).astype(np.int16)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    word, cls, train, every = (np.concatenate(v) for v in zip(*parts, strict=True))
    unique, first, inverse = np.unique(word, return_index=True, return_inverse=True)
    return (unique, cls[first], np.bincount(inverse, train, len(unique)).astype(np.int64),
            np.bincount(inverse, every, len(unique)).astype(np.int64))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per word, added up within the task and given out in parts."""
    parts: list[tuple[np.ndarray, ...]] = []
    size = 0

    def out(parts: list) -> Iterator[pa.RecordBatch]:
        word, cls, train, every = _merged(parts)
        for a in range(0, len(word), 100_000):
            s = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(word[s].view(np.int64)), pa.array(cls[s]), pa.array(train[s]), pa.array(every[s])],
                                             names=["word", "cls", "train", "every"])

    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        learn = np.array(batch.column(1).fill_null(False).to_pylist(), dtype=np.int64)
        for a, b in chunks(offsets):
            hashes, bounds, cls = _words(data, offsets[a:b + 1])
            if len(hashes):
                mine = np.repeat(learn[a:b], np.diff(bounds))
                parts.append(_merged([(hashes, cls, mine, np.ones(len(hashes), np.int64))]))
                size += len(parts[-1][0])
            if size > FLUSH:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                if size > FLUSH // 2:
                    yield from out(parts)
                    parts, size = [], 0
    if parts:
        yield from out(parts)


@dataclass(frozen=True)
class Corpus:
    """What the whole corpus gives: totals and the frequent words."""

    tokens: int  # N, ends included
    vocabulary: int  # V, the end included
    texts: int  # training texts, that is the count of the end
    head: np.ndarray  # sorted hashes
    head_count: np.ndarray
    head_class: np.ndarray  # class number, or -1: by its last bytes
    class_count: np.ndarray  # [CLASSES] training tokens
    class_mass: np.ndarray  # [CLASSES] sum of c + 0.1 of the words in rest classes, plus 0.1

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10(c + ADD) - np.log10(self.tokens + ADD * (self.vocabulary + 1))


def corpus_statistics(counts: DataFrame, texts: int) -> Corpus:
    total, words = counts.agg(F.sum("train"), F.sum((F.col("train") > 0).cast("long"))).first()
    total, words = int(total or 0), int(words or 0)
    # the frequent words: those at or above the least power of 2^(1/4) that keeps them few enough
    level = F.floor(F.log2(F.col("every").cast("double")) * 4).cast("int")
    hist = sorted(((r["l"], r["count"]) for r in counts.groupBy(level.alias("l")).count().collect()), reverse=True)
    least, n = None, 0
    for at, size in hist:
        if n + size > HEAD_WORDS:
            break
        least, n = at, n + size
    rows = collected(counts.where(level >= least) if least is not None else counts.limit(0))
    rows = rows.assign(word=rows["word"].to_numpy(np.int64).view(U)).sort_values("word")
    head, head_count = rows["word"].to_numpy(U), rows["train"].to_numpy(np.int64)
    rank = np.lexsort((head, -head_count))
    top = rank[:TOP_WORDS][head_count[rank[:TOP_WORDS]] > 0]
    head_class = np.full(len(head), -1, dtype=np.int64)
    head_class[top] = 1 + np.arange(len(top))
    sums = collected(counts.groupBy("cls").agg(F.sum("train").alias("c"), F.sum((F.col("train") > 0).cast("long")).alias("v")))
    count, mass = np.zeros(CLASSES), np.zeros(CLASSES)
    count[1 + TOP_WORDS + sums["cls"].to_numpy(int)] = sums["c"].to_numpy(float)
    mass[1 + TOP_WORDS + sums["cls"].to_numpy(int)] = sums["c"].to_numpy(float) + ADD * sums["v"].to_numpy(float)
    cls = 1 + TOP_WORDS + rows["cls"].to_numpy(int)[top]
    np.subtract.at(count, cls, head_count[top].astype(float))
    np.subtract.at(mass, cls, head_count[top] + ADD)
    count[0] = texts
    count[1:1 + len(top)] = head_count[top]
    return Corpus(total + texts, words + (texts > 0), texts, head, head_count, head_class, np.maximum(count, 0),
                  np.maximum(mass, 0) + ADD)


def _classes(corpus: Corpus, hashes: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, index in the head, whether in the head) of every word."""
    if not len(corpus.head):
        return 1 + TOP_WORDS + rest.astype(np.int64), np.zeros(len(hashes), int), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(corpus.head, hashes), len(corpus.head) - 1)
    inside = corpus.head[at] == hashes
    own = np.where(inside, corpus.head_class[at], -1)
    return np.where(own >= 0, own, 1 + TOP_WORDS + rest), at, inside


def _sequences(corpus: Corpus, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in chunks(offsets):
            hashes, bounds, rest = _words(data, offsets[a:b + 1])
            cls = _classes(corpus, hashes, rest)[0].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(cls))],
                names=["id", "classes"])


@dataclass(frozen=True)
class LogBilinear:
    """Vectors of classes as context and as target, position matrices, biases."""

    context: np.ndarray
    position: np.ndarray  # [2, WIDTH, WIDTH]
    target: np.ndarray
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, second, log_z): the log probability of class w after
        classes c1, c2 is first[c1, w] + second[c2, w] - log_z[c1, c2]."""
        one = self.context @ self.position[0] @ self.target.T + self.bias
        two = self.context @ self.position[1] @ self.target.T
        m1, m2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        log_z = np.log(np.exp(one - m1) @ np.exp(two - m2).T + 1e-300) + m1 + m2.T
        return one.astype(np.float32), two.astype(np.float32), log_z.astype(np.float32)


def contexts(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with ends put in, the two classes before each, and the bounds:
    text i holds tokens bounds[i]:bounds[i + 1], its end being the last."""
    n = len(bounds) - 1
    out = np.zeros(len(classes) + n, dtype=np.int64)
    new = bounds + np.arange(n + 1)
    keep = np.ones(len(out), dtype=bool)
    keep[new[1:] - 1] = False
    out[keep] = classes
    one, two = np.zeros_like(out), np.zeros_like(out)
    one[1:], two[2:] = out[:-1], out[:-2]
    one[new[:-1]] = two[new[:-1]] = 0
    second = new[:-1] + 1
    two[second[second < new[1:]]] = 0
    return out, one, two, new


Parameters = list[np.ndarray]


def _pass(parts: Parameters, grown: Parameters, tokens: np.ndarray, one: np.ndarray, two: np.ndarray, noise: np.ndarray,
          rng: np.random.Generator, *, batch: int, shared: int, rate: float) -> None:
    """One pass of AdaGrad steps over the tokens, in place; the noise words are
    drawn anew and shared by the tokens of a batch."""
    n = len(noise)
    context, target, position, bias = parts
    log_kn = np.log(shared * noise).astype(bias.dtype)
    cumulative = np.cumsum(noise)

    def one_hot(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.r_[True, ids[order][1:] != ids[order][:-1]])
        out = np.zeros((n, rows.shape[1]), dtype=rows.dtype)
        out[ids[order][first]] = np.add.reduceat(rows[order], first, axis=0)
        return out

    shuffled = rng.permutation(len(tokens))
    for a in range(0, len(tokens), batch):
        i = shuffled[a:a + batch]
        w, c1, c2 = tokens[i], one[i], two[i]
        r1, r2 = context[c1], context[c2]
        h = r1 @ position[0] + r2 @ position[1]
        s = np.minimum(np.searchsorted(cumulative, rng.random(shared)), n - 1)
        yes = 1 / (1 + np.exp(-np.clip((h * target[w]).sum(axis=1) + bias[w] - log_kn[w], -30, 30))) - 1
        no = 1 / (1 + np.exp(-np.clip(h @ target[s].T + bias[s] - log_kn[s], -30, 30)))
        scale = 1 / len(i)
        gh = (yes[:, None] * target[w] + no @ target[s]) * scale
        g_target = one_hot(np.r_[w, s], np.vstack([yes[:, None] * h, no.T @ h]) * scale)
        g_bias = (np.bincount(w, yes, n) + np.bincount(s, no.sum(axis=0), n)) * scale
        g_context = one_hot(np.r_[c1, c2], np.vstack([gh @ position[0].T, gh @ position[1].T]))
        g_position = np.stack([r1.T @ gh, r2.T @ gh])
        for p, q, g in zip(parts, grown, (g_context, g_target, g_position, g_bias), strict=True):
            q += g * g
            p -= rate * g / np.sqrt(q)


def _smooth(noise: np.ndarray) -> np.ndarray:
    return (noise + 0.5) / (noise + 0.5).sum()


def train_nce(tokens: np.ndarray, one: np.ndarray, two: np.ndarray, noise: np.ndarray, *, width: int = WIDTH,
              epochs: int = EPOCHS, batch: int = 2048, shared: int = 256, rate: float = 0.15, seed: int = 9) -> LogBilinear:
    """Noise-contrastive estimation by AdaGrad."""
    return _model(_start(tokens, one, two, noise, width=width, epochs=epochs, batch=batch, shared=shared, rate=rate, seed=seed)[0])


def _model(parts: Parameters) -> LogBilinear:
    context, target, position, bias = parts
    return LogBilinear(context, position, target, bias)


def _start(tokens: np.ndarray, one: np.ndarray, two: np.ndarray, noise: np.ndarray, *, width: int = WIDTH,
           epochs: int = EPOCHS, batch: int = 2048, shared: int = 256, rate: float = 0.15, seed: int = 9) -> tuple[Parameters, Parameters]:
    """Parameters (context, target, position, bias) trained from random ones, and AdaGrad's sums."""
    rng = np.random.default_rng(seed)
    n = len(noise)
    noise = _smooth(noise)
    context = rng.normal(0, 0.1, (n, width))
    target = rng.normal(0, 0.1, (n, width))
    position = np.stack([np.eye(width), 0.5 * np.eye(width)])
    parts = [context, target, position, np.log(noise)]
    grown = [np.full_like(p, 1e-3) for p in parts]
    for _ in range(epochs):
        _pass(parts, grown, tokens, one, two, noise, rng, batch=batch, shared=shared, rate=rate)
    return parts, grown


def _trained(corpus: Corpus, start: tuple[Parameters, Parameters], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tokens, parameters times tokens) after a pass over all texts of the task."""
    parts, grown = ([p.astype(np.float32) for p in own] for own in start)
    noise, seen = _smooth(corpus.class_count), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for a, b in chunks(offsets):
            hashes, bounds, rest = _words(data, offsets[a:b + 1])
            tokens, one, two, _ = contexts(_classes(corpus, hashes, rest)[0], bounds)
            _pass(parts, grown, tokens, one, two, noise, np.random.default_rng([9, len(tokens)]),
                  batch=2048, shared=SHARED, rate=0.15)
            seen += len(tokens)
    if seen:
        yield _packed(seen, seen * np.concatenate([p.ravel() for p in parts]).astype(float))


def _packed(seen: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["tokens", "total"])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, total = 0, None
    for batch in batches:
        for n, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(v.as_buffer(), dtype=np.float64)
            seen, total = seen + n, own if total is None else total + own
    if total is not None:
        yield _packed(seen, total)


def train_over(texts: DataFrame, corpus: Corpus, start: tuple[Parameters, Parameters]) -> Parameters:
    """Parameters after a pass over all `texts` (one column): the average, by
    tokens, of what the tasks reach on their own texts from `start`."""
    schema = "tokens long, total binary"
    sums = texts.mapInArrow(lambda it: _trained(corpus, start, it), schema).repartition(SUMS).mapInArrow(_added, schema).collect()
    total = sum((np.frombuffer(r["total"], dtype=np.float64) for r in sums), np.zeros(sum(p.size for p in start[0])))
    mean = np.split(total / max(sum(r["tokens"] for r in sums), 1), np.cumsum([p.size for p in start[0]])[:-1])
    return [m.reshape(p.shape) for m, p in zip(mean, start[0], strict=True)]


@dataclass(frozen=True)
class LanguageModel:
    corpus: Corpus
    neural: LogBilinear


def _counts(docs: DataFrame, learn: Column, text_col: str) -> DataFrame:
    return written(docs.select(F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")).mapInArrow(
        _count, "word long, cls short, train long, every long").groupBy("word").agg(
        F.min("cls").alias("cls"), F.sum("train").alias("train"), F.sum("every").alias("every")), "lm-counts")


def fit(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text",
        sample_tokens: int = SAMPLE_TOKENS) -> tuple[LanguageModel, DataFrame]:
    """The model, and the table of word counts that scoring joins with."""
    texts = lean(docs).where(learn).count()
    counts = _counts(docs, learn, text_col)
    corpus = corpus_statistics(counts, texts)
    bound = texts if corpus.tokens <= sample_tokens else max(1, int(texts * sample_tokens / corpus.tokens))
    id_type = dict(docs.dtypes)[id_col]
    rows = collected(sampled(docs.where(learn), id_col, bound, texts).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        lambda it: _sequences(corpus, it), f"id {id_type}, classes array<int>"))
    rows = rows.assign(key=rows["id"].astype(str)).sort_values("key", kind="stable")
    seqs = [np.asarray(c, dtype=np.int64) for c in rows["classes"]]
    bounds = np.cumsum([0] + [len(s) for s in seqs])
    tokens, one, two, _ = contexts(np.concatenate(seqs) if seqs else np.zeros(0, np.int64), bounds)
    start = _start(tokens, one, two, corpus.class_count)
    parts = start[0]
    if bound < texts:  # the sample is not all
        parts = train_over(docs.where(learn).select(F.coalesce(F.col(text_col), F.lit("")).alias("text")), corpus, start)
    return LanguageModel(corpus, _model(parts)), counts


def _score(model: LanguageModel, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a row without a word: tokens, known tokens, base and model
    score as far as the head goes; then a row for each of its other words."""
    corpus = model.corpus
    first, second, log_z = model.neural.tables()
    head_base = corpus.base(corpus.head_count.astype(float))
    head_rest = np.where(corpus.head_class < 0, np.log10(corpus.head_count + ADD), 0.0)
    end_base = float(corpus.base(np.array([float(corpus.texts)]))[0])
    log_mass = np.where(np.arange(CLASSES) > TOP_WORDS, np.log10(corpus.class_mass), 0.0)
    unseen = float(corpus.base(np.zeros(1))[0]) - np.log10(ADD)  # to which log10(c + 0.1) is added
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for a, b in chunks(offsets):
            hashes, bounds, rest = _words(data, offsets[a:b + 1])
            cls, at, inside = _classes(corpus, hashes, rest)
            n = b - a
            doc = np.repeat(np.arange(n), np.diff(bounds))
            known = corpus.head_count[at] > 0 if len(corpus.head) else np.zeros(len(hashes), bool)
            base = np.where(inside, head_base[at], unseen) if len(corpus.head) else np.full(len(hashes), unseen)
            inner = np.where(inside, head_rest[at], 0.0) if len(corpus.head) else np.zeros(len(hashes))
            inner = inner - log_mass[cls]
            tokens, one, two, ends = contexts(cls, bounds)
            log_p = (first[one, tokens] + second[two, tokens] - log_z[one, two]).astype(float) / np.log(10)
            total = np.add.reduceat(log_p, ends[:-1]) if n else np.zeros(0)
            s = np.bincount(doc, base, n) + end_base
            m = np.bincount(doc, inner, n) + total
            k = np.bincount(doc, inside & known, n).astype(np.int64) + (corpus.texts > 0)
            far = np.flatnonzero(~inside)
            key, where = doc[far].astype(U), hashes[far]
            order = np.lexsort((where, key))
            key, where = key[order], where[order]
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (where[1:] != where[:-1])]) if len(key) else np.zeros(0, int)
            times = np.diff(np.append(new, len(key)))
            rows, ids = batch.column(0).slice(a, n), batch.column(1).slice(a, n)
            yield pa.RecordBatch.from_arrays([
                rows, ids, pa.nulls(n, pa.int64()), pa.array(np.diff(bounds) + 1, pa.int64()), pa.array(k),
                pa.array(s), pa.array(m)], names=["row", "id", "word", "n", "known", "base", "model"])
            if len(new):
                pick = pa.array(key[new].astype(np.int64))
                yield pa.RecordBatch.from_arrays([
                    rows.take(pick), pa.nulls(len(new), ids.type), pa.array(where[new].view(np.int64)),
                    pa.array(times, pa.int64()), pa.array(np.zeros(len(new), np.int64)), pa.array(np.zeros(len(new))),
                    pa.array(np.zeros(len(new)))], names=["row", "id", "word", "n", "known", "base", "model"])


def score(docs: DataFrame, model: LanguageModel, counts: DataFrame, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    id_type = dict(docs.dtypes)[id_col]
    parts = written(lean(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                                F.col(text_col).alias("text")).mapInArrow(
        lambda it: _score(model, it),
        f"row long, id {id_type}, word long, n long, known long, base double, model double"), "lm-parts")
    rare = parts.where("word IS NOT NULL").select("row", "word", "n").join(
        counts.select("word", F.col("train").alias("c")), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    return parts.where("word IS NULL").join(rare, "row", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
