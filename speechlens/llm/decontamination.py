"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, A-Z lower-cased; seeds are all word
3-grams of the items, whether rare or common in the documents, so what a
document is found to leak does not depend on other documents. The item is
aligned with the text around each of its seeds (match +2, other word or gap -1)
and taken as leaked where the local alignment reaches `threshold` of a perfect
one, which paraphrased or edited copies do and chance does not. One seed is
enough; the text around it is aligned as far as an alignment of that score can
span, and a stretch, or a whole text, is left unaligned only if the item's words in
it, each as often as it stands in both, could not reach the threshold in any order. A copy
edited so that no three consecutive words of the item are left is not found.

This is one scan without a shuffle of texts. Items are dealt into blocks of
at most `BLOCK_SEEDS` seeds, whose tables go to the tasks; a larger benchmark
takes more blocks, never fewer items.

Defined cases: null or empty texts and items hold no words and match nothing;
items of fewer than three words give their whole sequence as one seed and are
found only in texts as short; texts of any length are scanned whole; of
alignments that score alike the first in the text is reported; repeated items or rows are reported each; further columns are ignored (`leaks`) or kept
(`decontaminate`); empty tables give an empty result (or all documents).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import lean
from .shingles import U, chunks, mix64, text_bytes, word_hashes

WIDTH = 3
MATCH, MISMATCH, GAP = 2, -1, 1
THRESHOLD = 0.4
BLOCK_SEEDS = 2_000_000
_MUL = U(0x9E3779B97F4A7C15)

_BREAKS = np.ones(256, dtype=bool)
_BREAKS[48:58] = _BREAKS[65:91] = _BREAKS[97:123] = False
_BREAKS[128:] = False


@dataclass(frozen=True)
class Items:
    """Items of one block: their ids, words (hashes), and seeds; the items with
    seed k are owners[starts[k]:starts[k + 1]]."""

    ids: list
    words: list
    counts: list  # (different words, how often) of each item
    own_seeds: list  # of each item, sorted
    flat: np.ndarray  # the different words of all items; item j has bounds[j]:bounds[j + 1]
    often: np.ndarray
    bounds: np.ndarray
    lens: np.ndarray
    seeds: np.ndarray  # sorted
    starts: np.ndarray
    owners: np.ndarray


def _grams(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3-gram hashes at every word and whether one starts there; texts shorter
    than three words have one over all their words."""
    n = len(words)
    pad = np.concatenate([words, np.zeros(WIDTH, dtype=U)])
    gram = mix64((pad[:n] * _MUL + pad[1:n + 1]) * _MUL + pad[2:n + 2])
    ok = np.zeros(n, dtype=bool)
    lens = np.diff(bounds)
    room = np.repeat(bounds[1:], lens) - np.arange(n)
    ok[room >= WIDTH] = True
    for i in np.flatnonzero((lens > 0) & (lens < WIDTH)):
        short = U(lens[i])
        for w in words[bounds[i]:bounds[i + 1]]:
            short = U((int(short) * int(_MUL) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        gram[bounds[i]], ok[bounds[i]] = mix64(np.array([short], dtype=U))[0], True
    return gram, ok


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(data, offsets, _BREAKS)


def _read_items(rows: list[tuple]) -> list[tuple]:
    """(id, word hashes, seeds) of items with words."""
    data, offsets = text_bytes(pa.array([t for _, t in rows], pa.string()))
    words, bounds = _hashed(data, offsets)
    gram, ok = _grams(words, bounds)
    out = []
    for (item, _), a, b in zip(rows, bounds[:-1], bounds[1:], strict=True):
        if b > a:
            out.append((item, words[a:b], np.unique(gram[a:b][ok[a:b]])))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks that hold at most BLOCK_SEEDS words."""
    sized = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    size = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-size // (2 * BLOCK_SEEDS)))  # a word takes two characters or more
    part = F.pmod(F.xxhash64(F.col("i").cast("string")), F.lit(n))
    for k in range(n):
        own = sized if n == 1 else sized.where(part == k)
        yield _read_items(sorted(((r["i"], r["t"]) for r in own.collect()), key=lambda r: (str(r[0]), r[1] or "")))


_LOW = (1 << 20) - 1


def _found(gram: np.ndarray, ok: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the seed, position) of every seed among the 3-grams."""
    where = np.flatnonzero(ok)
    if not len(where) or not len(seeds):
        return where[:0], where[:0]
    # a table of low bits turns most 3-grams away before the search
    maybe = np.zeros(_LOW + 1, dtype=bool)
    maybe[(seeds & U(_LOW)).astype(np.int64)] = True
    where = where[maybe[(gram[where] & U(_LOW)).astype(np.int64)]]
    at = np.minimum(np.searchsorted(seeds, gram[where]), len(seeds) - 1)
    hit = seeds[at] == gram[where]
    return at[hit], where[hit]


def _seeded(items: list[tuple]) -> Items:
    lens = [len(s) for _, _, s in items]
    every = np.concatenate([np.zeros(0, dtype=U), *(s for _, _, s in items)])
    order = np.argsort(every, kind="stable")
    seeds, first = np.unique(every[order], return_index=True)
    counts = [np.unique(w, return_counts=True) for _, w, _ in items]
    none = np.zeros(0, dtype=np.int64)
    return Items([i for i, _, _ in items], [w for _, w, _ in items], counts, [s for _, _, s in items],
                 np.concatenate([none.astype(U), *(c[0] for c in counts)]), np.concatenate([none, *(c[1] for c in counts)]),
                 np.concatenate([[0], np.cumsum([len(c[0]) for c in counts], dtype=np.int64)]),
                 np.array([len(w) for _, w, _ in items], dtype=np.int64), seeds, np.append(first, len(every)), np.repeat(np.arange(len(items)), lens)[order])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman of two word sequences: (score, matches, start, end in text)."""
    n, m = len(item), len(text)
    step = np.arange(m + 1) * GAP
    h = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(1, n + 1):
        best = np.maximum(h[i - 1] - GAP, 0)
        best[1:] = np.maximum(best[1:], h[i - 1, :-1] + np.where(text == item[i - 1], MATCH, MISMATCH))
        # gaps in the text: best over k <= j of best[k] - (j - k)
        h[i] = np.maximum.accumulate(best + step) - step
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    score, end, matches = int(h[i, j]), int(j), 0
    while h[i, j] > 0:
        if i and j and h[i, j] == h[i - 1, j - 1] + (MATCH if text[j - 1] == item[i - 1] else MISMATCH):
            matches += int(text[j - 1] == item[i - 1])
            i, j = i - 1, j - 1
        elif i and h[i, j] == h[i - 1, j] - GAP:
            i -= 1
        else:
            j -= 1
    return score, matches, int(j), end


def _ranges(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i + 1]] of all `which` i, one after another."""
    n = starts[which + 1] - starts[which]
    return values[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _possible(some: np.ndarray, text: np.ndarray, items: Items, threshold: float) -> np.ndarray:
    """Those of `some` items whose words in the whole text could reach the threshold in
    any order; for all of them at once, since very many may share a seed."""
    if not len(some):
        return some
    have, often = np.unique(text, return_counts=True)
    own, times = _ranges(items.flat, items.bounds, some), _ranges(items.often, items.bounds, some)
    at = np.minimum(np.searchsorted(have, own), len(have) - 1)
    shared = np.where(have[at] == own, np.minimum(often[at], times), 0)
    ends = np.cumsum(items.bounds[some + 1] - items.bounds[some])
    total = np.diff(np.concatenate([[0], np.cumsum(shared)[ends - 1]]))
    return some[total >= threshold * items.lens[some]]


def _most(counts: tuple[np.ndarray, np.ndarray], text: np.ndarray) -> int:
    """No alignment of the item with `text` scores more: its words that `text` holds, all matched."""
    own, times = counts
    at = np.minimum(np.searchsorted(own, text), len(own) - 1)
    return MATCH * int(np.minimum(np.bincount(at[own[at] == text], minlength=len(own)), times).sum())


def _leaks_of(words: np.ndarray, at: np.ndarray, where: np.ndarray, items: Items, threshold: float) -> list[tuple]:
    """(item number, score, matches, start, end) of the best alignment of each
    leaked item with a text that holds the seeds `at` at the places `where`."""
    owners = _ranges(items.owners, items.starts, np.unique(at))
    out = []
    for j in _possible(np.unique(owners), words, items, threshold).tolist():
        places = where[np.isin(items.seeds[at], items.own_seeds[j])]
        item, best = items.words[j], None
        # a match scores 2 and a word left out or put in costs 1, so an alignment that
        # reaches the threshold spans at most so many words of the text
        reach, least = WIDTH + int(np.ceil(len(item) * (1 + MATCH * (1 - threshold) / GAP))), threshold * MATCH * len(item)
        for group in np.split(places, np.flatnonzero(np.diff(places) > reach) + 1):
            lo, hi = max(0, int(group[0]) - reach), min(len(words), int(group[-1]) + WIDTH + reach)
            # a long stretch of hits is aligned in overlapping pieces
            size = 8 * reach
            for a in range(lo, max(lo + 1, hi - 2 * reach), size - 2 * reach):
                text = words[a:min(hi, a + size)]
                if _most(items.counts[j], text) < least:
                    continue
                score, matches, start, end = align(item, text)
                if best is None or score > best[0]:
                    best = (score, matches, a + start, a + end)
        if best is not None and best[0] >= least:
            out.append((j, best[0] / (MATCH * len(item)), *best[1:]))
    return out


def _texts(batch: pa.RecordBatch, column: int, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, words, seeds, their places) of the rows that hold a seed."""
    data, offsets = text_bytes(batch.column(column))
    for a, b in chunks(offsets):
        words, bounds = _hashed(data, offsets[a:b + 1])
        gram, ok = _grams(words, bounds)
        at, where = _found(gram, ok, items.seeds)
        row = np.searchsorted(bounds, where, side="right") - 1
        rows, first = np.unique(row, return_index=True)
        for i, f, e in zip(rows.tolist(), first.tolist(), np.append(first, len(row))[1:].tolist(), strict=True):
            yield a + i, words[bounds[i]:bounds[i + 1]], at[f:e], where[f:e] - bounds[i]


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, item, score, matches, start, end) for every document and item it
    leaks: the best alignment's share of a perfect score, its equal words, and
    its place in the document in words."""
    id_type, item_type = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    schema = f"id {id_type}, item {item_type}, score double, matches long, start long, end long"
    item_arrow = to_arrow_type(benchmark.schema[item_col].dataType)
    found = None
    for rows in _blocks(benchmark, item_col, item_text_col):
        items = _seeded(rows)

        def run(batches: Iterable[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place, out = [], []
                for i, words, at, where in _texts(batch, 1, items):
                    for leak in _leaks_of(words, at, where, items, threshold):
                        place.append(i)
                        out.append(leak)
                cols = list(zip(*out, strict=True)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(place, pa.int64())),
                    pa.array([items.ids[j] for j in cols[0]], item_arrow), pa.array(cols[1], pa.float64()),
                    *(pa.array(c, pa.int64()) for c in cols[2:])],
                    names=["id", "item", "score", "matches", "start", "end"])

        part = lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that leak no item."""
    place = docs.columns.index(text_col)
    out = lean(docs)
    for rows in _blocks(benchmark, item_col, item_text_col):
        items = _seeded(rows)

        def run(batches: Iterable[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for i, words, at, where in _texts(batch, place, items):
                    clean[i] = not _leaks_of(words, at, where, items, threshold)
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
