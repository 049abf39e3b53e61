"""Member pairs by the prefix index against the block product."""

import numpy as np
import pytest

from speechlens.operators import prefix_pairs as PP
from speechlens.operators import similarity as M


def vectors(spark, n, seed, terms=40, density=0.3, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.exponential(size=(n, terms)) * (rng.random((n, terms)) < density * np.linspace(0.1, 2, terms))
    if copies:
        x[n // 2:] = x[:n - n // 2] * rng.uniform(0.5, 2, (n - n // 2, 1))   # equal directions: ties at 1
        x[-3:] += rng.exponential(size=(3, terms)) * 0.2
    rows = [(f"m{i:03d}", f"t{j}", j, float(x[i, j])) for i in range(n) for j in range(terms) if x[i, j] or j == 0 and i % 9 == 0]
    return spark.createDataFrame(rows, "member_name string, term string, term_id int, weight double")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("k, threshold", [(10, 0.6), (1, 0.6), (100, 0.3), (None, 0.6), (None, 0.95), (5000, 0.5)])
def test_equal_to_the_block_product(spark, k, threshold):
    v = vectors(spark, 60, 3)
    want = rows(M.similar_pairs(v, k, threshold))
    assert rows(PP.similar_pairs_prefix(v, k, threshold)) == want and want


def test_fewer_candidates_for_a_higher_threshold(spark):
    unit = M._unit_vectors(vectors(spark, 120, 5, copies=False))
    sizes = [(PP.indexed_terms(unit, t).count(), PP.candidate_pairs(PP.indexed_terms(unit, t), t).count()) for t in (0.3, 0.6, 0.9)]
    assert sizes == sorted(sizes, reverse=True) and sizes[2][1] < sizes[0][1] / 2
    assert sizes[0][0] <= unit.count()


def test_no_pairs(spark):
    none = spark.createDataFrame([], "member_name string, term string, term_id int, weight double")
    assert PP.similar_pairs_prefix(none).count() == 0
    one = spark.createDataFrame([("a", "t", 0, 1.0), ("z", "t", 0, 0.0)], none.schema)
    assert PP.similar_pairs_prefix(one).count() == 0
    for bad in ({"k": 0}, {"threshold": 0.0}):
        with pytest.raises(ValueError):
            PP.similar_pairs_prefix(one, **bad)
