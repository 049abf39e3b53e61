"""Filter interaction audit: which of several filters removes what, in every order.

Each document has a mask of the filters it fails. Documents are counted by part
and mask (at most 32 rows a part), and from these counts the removals of all 32
coalitions of filters are tabulated: v(S) documents fail a filter of S. A step
of an order removes v(S with its filter) - v(S), so coalition differences supply
the counts of all steps of all 120 orders.

A filter's Shapley value solves the kernel-weighted least squares

    minimise  sum over S of k(S) (v(S) - sum of phi_i in S)^2
    subject to  sum of phi = v(all),   k(S) = (m - 1) / (C(m, |S|) |S| (m - |S|))

whose normal equations with their constraint are solved once in rationals: the
solution is linear in v, so it is kept as exact coefficients (times m! they are
integers) and applied to each part's table in Spark.

Whether a text repeats that of a smaller id is decided over the whole table:
the smallest id of each text's SHA-256 digest is a partially aggregated
minimum, and the rows that hold it are found by digest and id together, so
thousands of copies of a text never meet in one task. Everything is DataFrame
functions; nothing is collected.

Defined cases: a null text is an empty one, a null part the empty string; rows
without an id are not copies and are nobody's original; rows that repeat an id
with its text are both first; a document has a label if any row of `labels` with
its id says 1; further columns are ignored, whatever their names; texts of any
length are taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import maybe_broadcast
from .common import written

FILTERS = "ABCDE"
_SPACES = r"[\x20\x09-\x0D]+"


def shapley_coefficients(m: int) -> list[list[int]]:
    """[i][S]: m! times the coefficient of v(S) in filter i's Shapley value, by
    the constrained normal equations in rationals."""
    size = 1 << m
    kernel = {s: Fraction(m - 1, math.comb(m, k) * k * (m - k)) for s in range(1, size - 1) for k in [s.bit_count()]}
    # [A 1; 1' 0] [phi; multiplier] = [b(v); v(all)], every right side a row of coefficients of v
    rows = []
    for i in range(m):
        left = [sum((w for s, w in kernel.items() if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(m)]
        right = [kernel[s] if s in kernel and s >> i & 1 else Fraction(0) for s in range(size)]
        rows.append([*left, Fraction(1), *right])
    rows.append([Fraction(1)] * m + [Fraction(0)] + [Fraction(int(s == size - 1)) for s in range(size)])
    for i in range(m + 1):
        pivot = next(r for r in range(i, m + 1) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(m + 1):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i], strict=True)]
    scaled = [[x * math.factorial(m) for x in row[m + 1:]] for row in rows[:m]]
    assert all(x.denominator == 1 for row in scaled for x in row)
    return [[int(x) for x in row] for row in scaled]


def text_failures(text: Column) -> Column:
    """Bit mask of the filters that a text fails by itself: A (1) too short,
    B (2) too repetitive, C (4) too many capitals, D (8) holds odd marks."""
    words = F.array_remove(F.split(text, _SPACES), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
             text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def failure_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask): the filters each document fails, E (16) included."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = written(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_failures(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "filter-masks")
    first = own.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first_id"))
    both = own.alias("o").join(first.alias("f"), F.expr("o.digest = f.digest AND o.id = f.first_id"), "left")
    copy = F.col("o.id").isNotNull() & F.col("f.first_id").isNull()
    return both.select("o.id", "o.part", (F.col("o.mask") + F.when(copy, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def coalition_table(masks: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(part, n, v, good, toxic): a part's documents, and arrays over all
    coalitions S of how many (of quality 1, toxic) documents fail a filter of S."""
    one = {c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)) for c in ("quality", "toxic")}
    marked = labels.where(f"{id_col} IS NOT NULL").groupBy(F.col(id_col).alias("label_id")).agg(
        one["quality"].alias("is_good"), one["toxic"].alias("is_toxic")).where("is_good + is_toxic > 0")
    marked, _ = maybe_broadcast(marked)
    by_mask = masks.join(marked, F.col("id") == F.col("label_id"), "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("is_good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("is_toxic"), F.lit(0)).alias("toxic"))

    def table(count: str) -> Column:
        return F.array(*(F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(count))), F.lit(0)).cast("long")
                         for s in range(1 << len(FILTERS))))

    return by_mask.groupBy("part").agg(F.sum("n").alias("n"), table("n").alias("v"), table("good").alias("good"),
                                       table("toxic").alias("toxic"))


def audit(table: DataFrame) -> DataFrame:
    """A row for every part, order of the filters and step of a coalition table."""
    m, full = len(FILTERS), (1 << len(FILTERS)) - 1
    shapley = F.array(*(sum((F.lit(c) * F.col("v")[s] for s, c in enumerate(row) if c), F.lit(0))
                        for row in shapley_coefficients(m)))
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = table.withColumn("all_shapley", shapley).withColumn("filter_order", F.explode(F.lit(orders))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(m))))

    def bit(place) -> Column:
        return F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, {place}, 1)) - 1)")

    before = sum((F.when(F.col("step") > j, bit(j)).otherwise(F.lit(0)) for j in range(1, m)), F.lit(0))
    steps = steps.withColumn("before", before).withColumn("own", bit("step")).withColumn(
        "after", F.col("before") + F.col("own"))

    def at(values: str, place) -> Column:
        return F.get(F.col(values), place)

    def gone(values: str) -> Column:
        return at(values, F.col("after")) - at(values, F.col("before"))

    filter_no = F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1")
    return steps.select(
        "part", "filter_order", "step", (F.col("n") - at("v", F.col("after"))).alias("kept"), gone("v").alias("removed"),
        (at("v", F.col("own")) - gone("v")).alias("redundant"),
        (at("v", F.lit(full)) - at("v", F.lit(full) - F.col("own"))).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.get("all_shapley", filter_no).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) of the five filters over all documents."""
    masks = failure_masks(docs, id_col=id_col, text_col=text_col, part_col=part_col)
    return audit(coalition_table(masks, labels, id_col=id_col))
