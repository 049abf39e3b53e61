"""The filter audit against its definition, its coefficients, and the defined cases."""

import itertools
import math

import pytest

from speechlens.llm import filter_audit

LONG = "Word " * 60_000 + "#"
SCHEMA = "doc_id long, text string, source string, mask int, part string, n long, digest string"


def definition(rows, quality, toxic):
    """The result rows by applying the filters one after another."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = []
    for i, t, s in rows:
        t = t or ""
        w = t.encode().split()
        mask = {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > first[t]), strict=True) if bad}
        fails.append((s or "", mask, i in quality, i in toxic))
    out = {}
    for part in {s for s, *_ in fails}:
        own = [f for f in fails if f[0] == part]
        removed = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed[f] = removed.get(f, 0) + len(gone)
                out[part, order, k] = [len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                                       sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order, 1):
                out[part, order, k].append(removed[f])
    return out


def test_coefficients_are_shapley_values():
    for m in (2, 3, 5):
        got = filter_audit.shapley_coefficients(m)
        for i in range(m):
            for s in range(1 << m):
                k = s.bit_count()
                sign, before = (1, k - 1) if s >> i & 1 else (-1, k)
                want = sign * math.factorial(before) * math.factorial(m - 1 - before)
                # the empty coalition removes nothing, so its coefficient does not count
                assert s == 0 or got[i][s] == want


def messy():
    plain = " ".join(f"w{k}" for k in range(250))
    rows = [(5, plain, "a"), (3, plain, "b"), (9, plain, "a"), (None, plain, "a"), (11, None, None), (12, "", ""),
            (13, LONG, "a"), (13, LONG, "a"), (14, LONG, None), (15, "A B C | d", "b"), (16, "ÀÉ " * 300, "c"),
            (17, plain + " #", "c"), (18, plain.upper(), "c"), (None, None, "c")]
    return rows + [(100 + i, plain + f" {i % 7}", "hot") for i in range(60)]


def test_messy_rows(spark):
    rows = messy()
    docs = spark.createDataFrame([(i, t, s, 1, "p", 2, "d") for i, t, s in rows], SCHEMA).repartition(4)
    labels = spark.createDataFrame([(5, 1, 0, "x"), (9, 1, 1, "x"), (9, 0, 1, "x"), (13, 1, 1, "x"), (None, 1, 1, "x"), (15, None, 1, "x"),
                                    (100, 0, 0, "x"), (107, 1, 0, "x")], "doc_id long, quality int, toxic int, mask string")
    got = {(r[0], r[1], r[2]): list(r)[3:] for r in filter_audit.audit_filters(docs, labels).collect()}
    assert got == definition(rows, {5, 9, 13, 107}, {9, 13, 15})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    out = filter_audit.audit_filters(one, labels).collect()
    assert len(out) == 600 and sum(r["removed"] for r in out) == 120


@pytest.mark.parametrize("n", [2000])
def test_a_large_group_of_copies(spark, n):
    rows = [(i, "same text", "s") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    row = filter_audit.audit_filters(docs, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (row["kept"], row["removed"]) == (1, n - 1)
