"""Bursts of keywords: a two-state automaton over time, solved exactly.

In the low state a speech has the word with the series' overall probability p0, in
the high state with `scale` times that. A step (a date) with d speeches, r of them
with the word, costs the negative log likelihood of its state; going up costs
`gamma` times the log of the number of steps, going down nothing. The bursts are
the high stretches of the cheapest path.

Only steps where the word occurs are rows: between two of them the cheapest path
keeps to one state, so the speeches between, summed by a running total of the
series, make one term of the transition. A step is then a 2 x 2 matrix in (min, +)
arithmetic, and these multiply: a series of any length is cut into chunks of
`CHUNK` steps, a task multiplies each chunk's matrices, the products of a series
give the costs before and after each chunk, and the chunks are solved with these
carried in. A step lies in a burst if going through the high state is cheaper by
more than `EPS`, so the result does not hang on the order of summation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import parse_date
from ..schema import PARTY, SCORE_DIGITS

SCALE, GAMMA = 2.0, 1.0
MOST_P0, MOST_P1 = 0.9998, 0.9999
CHUNK = 256
EPS = 1e-9
_CELLS = ["a00", "a01", "a10", "a11"]


def keyword_series(per_doc: DataFrame, docs: DataFrame, group_col: str = PARTY) -> tuple[DataFrame, DataFrame]:
    """(series, word, t, r) and (series, t, d): on how many of a group's d speeches of
    a day a word is among the top keywords. Speeches without a group or date are left out."""
    dated = docs.select("doc_id", F.col(group_col).alias("series"), parse_date(F.col("sitting_date")).alias("t")).where(
        "series IS NOT NULL AND t IS NOT NULL")
    totals = dated.groupBy("series", "t").agg(F.count(F.lit(1)).alias("d"))
    own = per_doc.select(F.col(group_col).alias("series"), "word", parse_date(F.col("date")).alias("t")).where(
        "series IS NOT NULL AND t IS NOT NULL")
    return own.groupBy("series", "word", "t").agg(F.count(F.lit(1)).alias("r")), totals


def _cost(p: Column, r, d) -> Column:
    return -(r * F.log(p) + (d - r) * F.log(F.lit(1.0) - p))


def burst_steps(occurrences: DataFrame, totals: DataFrame, scale: float = SCALE, gamma: float = GAMMA) -> DataFrame:
    """(series, word, k, t, r, d, gap, gain, bridge, gap_gain, a00..a11): the steps of each series
    from 1 on. `gain` is what the high state saves at the step, `bridge` what staying
    high since the step before saves (negative: it does not pay)."""
    if scale <= 1 or gamma < 0:
        raise ValueError("scale must be above 1 and gamma at least 0")
    whole, running = Window.partitionBy("series"), Window.partitionBy("series").orderBy("t")
    told = totals.select(
        "series", "t", F.col("d").cast("double").alias("d"), F.sum("d").over(running).cast("double").alias("until"),
        F.sum("d").over(whole).cast("double").alias("speeches"), F.count(F.lit(1)).over(whole).alias("steps"))
    line = Window.partitionBy("series", "word").orderBy("t")
    own = occurrences.withColumn("r", F.col("r").cast("double")).join(told, ["series", "t"]).withColumn(
        "p0", F.least(F.sum("r").over(Window.partitionBy("series", "word")) / F.col("speeches"), F.lit(MOST_P0))).withColumn(
        "p1", F.least(F.lit(float(scale)) * F.col("p0"), F.lit(MOST_P1))).withColumn("up", F.lit(float(gamma)) * F.log("steps"))
    gap = F.col("until") - F.col("d") - F.coalesce(F.lag("until").over(line), F.lit(0.0))
    own = own.withColumn("k", F.row_number().over(line)).withColumn("gap", gap)
    low, high = _cost(F.col("p0"), F.col("r"), F.col("d")), _cost(F.col("p1"), F.col("r"), F.col("d"))
    gap0, gap1 = _cost(F.col("p0"), F.lit(0.0), F.col("gap")), _cost(F.col("p1"), F.lit(0.0), F.col("gap"))
    return own.select(
        "series", "word", "k", "t", "r", "d", "gap", (low - high).alias("gain"),
        # the dearer way over the gap, low and up again, against staying high
        (gap0 - gap1 + F.col("up")).alias("bridge"), (gap0 - gap1).alias("gap_gain"),
        (gap0 + low).alias("a00"), (gap0 + F.col("up") + high).alias("a01"),
        (gap0 + low).alias("a10"), (F.least(gap1, gap0 + F.col("up")) + high).alias("a11"))


def _runs(keys: int):
    """Consecutive rows of equal first `keys` columns, across batches."""

    def run(batches: Iterable) -> Iterator:
        key, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:keys] != key:
                    if rows:
                        yield key, rows
                    key, rows = row[:keys], []
                rows.append(row)
        if rows:
            yield key, rows

    return run


def _emitted(schema_of, solve, keys: int, size: int = 5_000):
    """A task over rows sorted by their keys: `solve(key, rows)` gives output rows."""
    runs = _runs(keys)

    def task(batches: Iterable) -> Iterator:
        import pyarrow as pa

        schema, out = schema_of(pa), []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                              schema=schema)

        for key, rows in runs(batches):
            out += solve(key, rows)
            if len(out) >= size:
                yield batch()
                out = []
        if out:
            yield batch()

    return task


def _chunk_products(steps: DataFrame) -> DataFrame:
    """(series, word, chunk, a00..a11): the (min, +) product of each chunk's steps."""

    def solve(key, rows):
        a = None
        for *_, c00, c01, c10, c11 in rows:
            a = (c00, c01, c10, c11) if a is None else (
                min(a[0] + c00, a[1] + c10), min(a[0] + c01, a[1] + c11),
                min(a[2] + c00, a[3] + c10), min(a[2] + c01, a[3] + c11))
        return [(*key, *a)]

    def schema(pa):
        return pa.schema([("series", pa.string()), ("word", pa.string()), ("chunk", pa.int32()), *((c, pa.float64()) for c in _CELLS)])

    return steps.select("series", "word", "chunk", "k", *_CELLS).mapInArrow(
        _emitted(schema, solve, 3), "series string, word string, chunk int, a00 double, a01 double, a10 double, a11 double")


def _carried(products: DataFrame) -> DataFrame:
    """(series, word, chunk, f0, f1, b0, b1): the least costs of reaching each chunk
    in either state, and of all that follows it from either state."""

    def solve(key, rows):
        f, before = (0.0, float("inf")), []     # a series starts low
        for *_, c00, c01, c10, c11 in rows:
            before.append(f)
            f = (min(f[0] + c00, f[1] + c10), min(f[0] + c01, f[1] + c11))
        b, after = (0.0, 0.0), []
        for *_, c00, c01, c10, c11 in reversed(rows):
            after.append(b)
            b = (min(c00 + b[0], c01 + b[1]), min(c10 + b[0], c11 + b[1]))
        return [(*row[:3], *x, *y) for row, x, y in zip(rows, before, reversed(after), strict=True)]

    def schema(pa):
        return pa.schema([("series", pa.string()), ("word", pa.string()), ("chunk", pa.int32()),
                          *((c, pa.float64()) for c in ("f0", "f1", "b0", "b1"))])

    dealt = products.repartition("series", "word").sortWithinPartitions("series", "word", "chunk")
    return dealt.select("series", "word", "chunk", *_CELLS).mapInArrow(
        _emitted(schema, solve, 2), "series string, word string, chunk int, f0 double, f1 double, b0 double, b1 double")


def _high_steps(steps: DataFrame, carried: DataFrame) -> DataFrame:
    """(series, word, k) of the steps in the high state."""

    def solve(key, rows):
        f, b = rows[0][8:10], rows[0][10:12]
        fs, bs = [], []
        for row in rows:
            c = row[4:8]
            f = (min(f[0] + c[0], f[1] + c[2]), min(f[0] + c[1], f[1] + c[3]))
            fs.append(f)
        for row in reversed(rows):
            bs.append(b)
            c = row[4:8]
            b = (min(c[0] + b[0], c[1] + b[1]), min(c[2] + b[0], c[3] + b[1]))
        return [(key[0], key[1], row[3]) for row, x, y in zip(rows, fs, reversed(bs), strict=True) if x[1] + y[1] < x[0] + y[0] - EPS]

    def schema(pa):
        return pa.schema([("series", pa.string()), ("word", pa.string()), ("k", pa.int32())])

    sided = steps.join(carried, ["series", "word", "chunk"]).repartition("series", "word", "chunk").sortWithinPartitions(
        "series", "word", "chunk", "k")
    return sided.select("series", "word", "chunk", "k", *_CELLS, "f0", "f1", "b0", "b1").mapInArrow(
        _emitted(schema, solve, 3), "series string, word string, k int")


def bursts(occurrences: DataFrame, totals: DataFrame, scale: float = SCALE, gamma: float = GAMMA) -> DataFrame:
    """(series, word, burst, first_t, last_t, steps, speeches, weight): the bursts of
    each series in time order; `steps` have the word, on `speeches` speeches, and
    `weight` is what the high state saves over the burst."""
    steps = burst_steps(occurrences, totals, scale, gamma).withColumn(
        "chunk", F.floor((F.col("k") - 1) / F.lit(CHUNK)).cast("int"))
    dealt = steps.repartition("series", "word", "chunk").sortWithinPartitions("series", "word", "chunk", "k")
    high = _high_steps(steps, _carried(_chunk_products(dealt)))
    inside = steps.join(high, ["series", "word", "k"])
    line = Window.partitionBy("series", "word").orderBy("k")
    # a burst goes on if the step before is in it too and staying high over what lies between pays
    follows = (F.lag("k").over(line) == F.col("k") - 1) & ((F.col("gap") == 0) | (F.col("bridge") > EPS))
    parted = inside.withColumn("goes_on", F.coalesce(follows, F.lit(False))).withColumn(
        "burst", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(line))
    return parted.groupBy("series", "word", "burst").agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count(F.lit(1)).alias("steps"),
        F.sum("r").cast("long").alias("speeches"),
        F.round(F.sum(F.col("gain") + F.when(F.col("goes_on"), F.col("gap_gain")).otherwise(F.lit(0.0))), SCORE_DIGITS).alias(
            "weight")).select("series", "word", F.col("burst").cast("int").alias("burst"), "first_t", "last_t", "steps", "speeches", "weight")


def keyword_bursts(per_doc: DataFrame, docs: DataFrame, group_col: str = PARTY, scale: float = SCALE,
                   gamma: float = GAMMA) -> DataFrame:
    """Bursts of the top keywords of each group's speeches."""
    return bursts(*keyword_series(per_doc, docs, group_col), scale, gamma)
