"""Bursts against the cheapest of all paths over every step, zeros included."""

import datetime
import itertools
import math
import random

import pytest

from speechlens.operators import bursts as B

DAY = datetime.date(2000, 1, 1)


def all_paths(counts, scale, gamma):
    """The high dates of the cheapest path over (r, d) of all steps, by trying all."""
    n, r_all, d_all = len(counts), sum(r for r, _ in counts), sum(d for _, d in counts)
    p0 = min(r_all / d_all, B.MOST_P0)
    p = (p0, min(scale * p0, B.MOST_P1))
    cost = [[-(r * math.log(q) + (d - r) * math.log(1 - q)) for q in p] for r, d in counts]
    best = []
    for path in itertools.product((0, 1), repeat=n):
        c = sum(cost[i][s] for i, s in enumerate(path)) + gamma * math.log(n) * sum(b > a for a, b in zip((0, *path), path))
        best.append((c, path))
    low = min(best)[0]
    found = [path for c, path in best if c < low + 1e-7]
    return found, cost


def islands(path, cost, counts):
    out, i = [], 0
    while i < len(path):
        j = i
        while j < len(path) and path[j]:
            j += 1
        if j > i:
            out.append((DAY + datetime.timedelta(i), DAY + datetime.timedelta(j - 1), sum(r > 0 for r, _ in counts[i:j]),
                        sum(r for r, _ in counts[i:j]), round(sum(cost[k][0] - cost[k][1] for k in range(i, j)), 6)))
        i = max(j, i + 1)
    return out


@pytest.mark.parametrize("chunk, scale, gamma", [(1, 2.0, 1.0), (3, 2.0, 0.3), (256, 3.0, 1.0), (4, 1.5, 0.0)])
def test_equal_to_all_paths(spark, monkeypatch, chunk, scale, gamma):
    monkeypatch.setattr(B, "CHUNK", chunk)
    rng = random.Random(chunk)
    occurrences, totals, want = [], [], set()
    for s in range(30):
        n = rng.randrange(1, 12)
        hot = (rng.randrange(n), rng.randrange(n))
        counts = []
        for i in range(n):
            d = rng.randrange(1, 9)
            rate = 0.8 if min(hot) <= i <= max(hot) else 0.05
            counts.append((sum(rng.random() < rate for _ in range(d)), d))
        totals += [(f"s{s}", DAY + datetime.timedelta(i), d) for i, (_, d) in enumerate(counts)]
        occurrences += [(f"s{s}", "w", DAY + datetime.timedelta(i), r) for i, (r, _) in enumerate(counts) if r]
        if any(r for r, _ in counts):
            paths, cost = all_paths(counts, scale, gamma)
            if len(paths) == 1:
                want |= {(f"s{s}", *b) for b in islands(paths[0], cost, counts)}
            else:
                # several cheapest paths: leave the series out on both sides
                occurrences = [o for o in occurrences if o[0] != f"s{s}"]
    got = B.bursts(spark.createDataFrame(occurrences, "series string, word string, t date, r long").repartition(3),
                   spark.createDataFrame(totals, "series string, t date, d long"), scale, gamma).collect()
    assert {(r["series"], r["first_t"], r["last_t"], r["steps"], r["speeches"], r["weight"]) for r in got} == want
    assert want


def test_chunks_do_not_change_a_long_series(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("s", f"w{w}", DAY + datetime.timedelta(i), rng.randrange(1, 9 if (i // 40 + w) % 5 == 0 else 3))
            for w in range(3) for i in range(600) if rng.random() < 0.7]
    occurrences = spark.createDataFrame(rows, "series string, word string, t date, r long")
    totals = spark.createDataFrame([("s", DAY + datetime.timedelta(i), 12) for i in range(600)], "series string, t date, d long")
    out = []
    for chunk in (7, 1000):
        monkeypatch.setattr(B, "CHUNK", chunk)
        out.append(sorted(map(tuple, B.bursts(occurrences, totals).collect())))
    assert out[0] == out[1] and len(out[0]) > 5


def test_no_series_and_bad_parameters(spark):
    occurrences = spark.createDataFrame([], "series string, word string, t date, r long")
    totals = spark.createDataFrame([], "series string, t date, d long")
    assert B.bursts(occurrences, totals).count() == 0
    for bad in ({"scale": 1.0}, {"gamma": -1.0}):
        with pytest.raises(ValueError):
            B.bursts(occurrences, totals, **bad)
