"""Target-distribution importance resampling on hashed word n-grams.

Texts stay bytes: a table of 256 bytes lower-cases A-Z and turns every ASCII
byte that is neither letter nor digit into a blank (bytes of other scripts stay),
`bytes.split` gives the words, and `zlib.crc32`, each call seeded with the last,
extends a run of words by one word at a time. A feature is a run of 1 to `WIDTH`
words joined by blanks; its bucket is its crc32 modulo `buckets`. Counters in
the tasks reduce the features of all documents and of all target texts to bucket
counts, which Spark sums. A bucket's gain is its smoothed log ratio of target to
documents in thousandths; a document weighs the sum of its features' gains, and
the Gumbel noise of its id turns the highest scores into a draw without
replacement in proportion to exp(weight / 1000).

Nothing but the bucket counts (`buckets` rows) reaches the driver. Texts are read
where they lie, twice (counts, weights), and never shuffled; ranks come from a
range sort of narrow rows with per-partition counts, never from one task.

Defined cases: null texts have no words, no features and weight 0, as texts
without words; a text of any length is taken whole, in pieces of `PIECE` bytes;
equal scores go to the smaller id; repeated rows are rows of their own, each
weighed and ranked; rows without an id are weighed but have no score and are
neither counted nor drawn; empty documents give an empty result, an empty target
smooths to gains from the documents alone; further columns of any name are
ignored (`weigh`) or kept (`resample`).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import with_sequential_id
from ..functions.sizing import maybe_broadcast
from .common import collected, written
from .shingles import text_bytes

WIDTH = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIECE = 1 << 20


def _byte_table() -> bytes:
    word = {*range(48, 58), *range(97, 123), *range(128, 256)}
    return bytes(b + 32 if 65 <= b <= 90 else b if b in word else 32 for b in range(256))


_TABLE = _byte_table()


def _pieces(text: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """(words, whether the text ends here) of about PIECE bytes of a text at a time."""
    at, n = 0, len(text)
    while n - at > PIECE:
        cut = text.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield text[at:cut].split(), False
        at = cut
    yield text[at:].split(), True


def feature_hashes(text: bytes, width: int = WIDTH) -> Iterator[tuple[int, list[list[int]]]]:
    """(words, crc32 of the runs of 1, 2, ... `width` words that start at them),
    a piece of a translated text at a time."""
    open_words: list[bytes] = []
    for words, last in _pieces(text):
        words = open_words + words
        # runs that may reach into the next piece start there
        n = len(words) if last else max(0, len(words) - width + 1)
        open_words = words[n:]
        spaced = [b" " + w for w in words]
        levels = [list(map(crc32, words[:n]))]
        for k in range(1, width):
            levels.append(list(map(crc32, spaced[k:n + k], levels[-1])))
        yield n, levels


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_bytes(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:b].tobytes().translate(_TABLE)


def bucket_counts(texts: DataFrame, *, text_col: str = "text", width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch.column(0)):
                for _, levels in feature_hashes(text, width):
                    counts.update([c % buckets for c in chain.from_iterable(levels)])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.int64()),
                                          pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"])

    own = texts.select(F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Gains:
    """Gain of each bucket in thousandths, and the features counted."""

    gains: list[int]
    width: int
    features: int
    target_features: int


def fit(docs: DataFrame, target: DataFrame, *, text_col: str = "text", target_text_col: str = "text",
        width: int = WIDTH, buckets: int = BUCKETS) -> Gains:
    """The gains of all buckets, from every document and every target text."""

    def counted(texts: DataFrame, col: str) -> list[int]:
        out = [0] * buckets
        rows = collected(bucket_counts(texts, text_col=col, width=width, buckets=buckets))
        for b, n in zip(rows["bucket"].tolist(), rows["n"].tolist(), strict=True):
            out[b] = n
        return out

    own, wanted = counted(docs, text_col), counted(target, target_text_col)
    s_all, t_all = sum(own), sum(wanted)
    gains = [math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
             for s, t in zip(own, wanted, strict=True)]
    return Gains(gains, width, s_all, t_all)


def weigh(docs: DataFrame, model: Gains, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row; `score` adds the
    Gumbel noise of the id, floor(-1000 ln(-ln u)), to the weight."""
    gains, width, buckets = model.gains, model.width, len(model.gains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in _texts(batch.column(1)):
                words = features = weight = 0
                for n, levels in feature_hashes(text, width):
                    words += n
                    for level in levels:
                        features += len(level)
                        weight += sum([gains[c % buckets] for c in level])
                out.append((words, features, weight))
            cols = list(zip(*out, strict=True)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {dict(docs.dtypes)[id_col]}, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return rows.withColumn("score", F.col("weight") + noise).withColumnRenamed("id", id_col)


def draw(weighed: DataFrame, *, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """`weighed` and `rank`: 1, 2, ... for the floor(percent * N / 100) highest
    scores of the N rows with an id and at least `least_words` words, null for the others."""
    rows = written(weighed.withColumn("_i_row", F.monotonically_increasing_id()), "importance")
    may = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    n = rows.where(may).count() * percent // 100
    # the row number parts rows that are equal in all else, so no one task holds a repeated id
    ranked = with_sequential_id(rows.where(may), [F.desc("score"), F.asc(id_col), F.asc("n_features"), F.asc("weight"),
                                                  F.asc("_i_row")], "rank", start=1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return ranked.unionByName(rows.where(~may).withColumn("rank", F.lit(None).cast("long"))).drop("_i_row")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of `docs` whose id is drawn, with all their columns."""
    model = fit(docs, target, text_col=text_col, target_text_col=target_text_col)
    drawn = draw(weigh(docs, model, id_col=id_col, text_col=text_col), id_col=id_col, percent=percent, least_words=least_words)
    ids, _ = maybe_broadcast(drawn.where("rank IS NOT NULL").select(id_col).distinct())
    return docs.join(ids, id_col, "left_semi").select(*docs.columns)

